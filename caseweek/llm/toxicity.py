"""Toxicity by a weighted finite-state pattern grammar (operator 10).

A lexical transducer turns words into classes: insult (with a weight), harm, intent, target, negation,
reporting, filler, quote marks and the ends of clauses (pauses and line breaks among them). Small transducers
read the classes of a clause, one each for negation, reported speech, target and threat; composed they are one
machine whose states are tuples of theirs. An insult or a threat is scored by what the machine has read before
it: a negated or reported one counts little, one aimed at somebody more. The score of a text is the logistic
function of the prior log-odds and the weights of all matched clauses, so single words count only as parts of
a clause.

The insult lexicon is a short list and what the labelled rows add: stems (first letters of words) and
whole words far more frequent among toxic documents than chance allows.

Defined results: null, empty and letterless texts have no clauses and get the prior; rows without a
label teach nothing; without labels of both kinds only the list counts and the prior is that of one toxic
document in ten; repeated rows and null ids are scored like any other; extra columns are ignored.
"""

from __future__ import annotations

import itertools
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Memo, smallest_hashes, stored

#: Words of each class (lower case).
WORDS = {
    "insult": "idiot idiots moron morons imbecile loser losers scum trash stupid worthless pathetic disgusting clown "
              "vermin dumbass bastard dummkopf idiotin abschaum imbécile ordure estúpido estúpida escoria",
    "harm": "kill hurt murder destroy beat stab shoot hang töten umbringen tuer frapper matar golpear",
    "intent": "will gonna must should werde soll vais dois voy debo deserve deserves",
    "target": "you your you're u they he she him her them du dich dein ihr tu toi vous ton tú te usted ustedes",
    "negation": "not no never isn't aren't wasn't don't nicht kein keine nie pas jamais nunca",
    "report": "said says wrote called claims claimed quoted reported sagte schrieb nannte disait écrit appelé dijo "
              "escribió llamó",
    "filler": "a an the such so very really ein eine der die das so sehr un une le la les très una el muy",
}
#: Lengths of learned stems.
STEMS = (4, 5, 6, 7)
#: Labelled rows of each kind that are learned from, at most, and learned entries, the strongest first.
SAMPLE = 20_000
LEXICON = 5_000
#: Share of toxic documents among all labelled ones with an entry, at least; and sampled documents with it, at least.
PRECISION = 0.9
SUPPORT = 4
#: Weight of a listed insult and of a threat, the largest learned weight, and most that clauses add up to.
LISTED, THREAT, HEAVIEST, MOST = 5.0, 5.0, 6.0, 12.0
#: What negation, reported speech and a target make of a weight.
NEGATED, REPORTED, AIMED = 0.1, 0.3, 1.2
#: Counts held by one task before it passes them on.
HELD_COUNTS = 300_000

#: Classes of the marks that end a clause; all others are quote marks.
ENDS = {".": "end", "!": "end", "?": "end", ";": "end", ":": "pause", ",": "pause", "\n": "break"}

_TOKEN = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)?|[.!?;:,\n\"“”„«»]")
_WORD = re.compile(r"[^\W\d_]+")


@dataclass
class Transducer:
    """Arcs (state, class) -> (next state, factor); a class without an arc goes to ``rest`` of the state."""

    start: object
    arcs: dict = field(default_factory=dict)
    rest: dict = field(default_factory=dict)

    def step(self, state, kind: str) -> tuple[object, float]:
        return self.arcs.get((state, kind)) or (self.rest.get(state, state), 1.0)


def compose(*parts: Transducer) -> dict[tuple, tuple[tuple, float]]:
    """Arcs of the machine that runs all parts at once; factors multiply."""
    kinds = [*WORDS, "other", *dict.fromkeys(ENDS.values()), "quote"]
    arcs, start = {}, tuple(p.start for p in parts)
    todo, seen = [start], {start}
    while todo:
        state = todo.pop()
        for kind in kinds:
            steps = [p.step(s, kind) for p, s in zip(parts, state, strict=True)]
            after = tuple(s for s, _ in steps)
            arcs[state, kind] = after, math.prod(f for _, f in steps)
            if after not in seen:
                seen.add(after)
                todo.append(after)
    return arcs


def grammar() -> tuple[dict, tuple]:
    """The composed clause machine and its start state."""
    def over(*states: str) -> dict:
        """Arcs that leave the states at any end of a clause."""
        return {(state, end): ("no", 1.0) for state in states for end in ENDS.values()}

    # Negation reaches over fillers and at most one other word.
    negation = Transducer("no", {("no", "negation"): ("next", 1.0), ("next", "insult"): ("no", NEGATED),
                                 ("last", "insult"): ("no", NEGATED), ("next", "harm"): ("no", NEGATED),
                                 ("last", "harm"): ("no", NEGATED), ("next", "filler"): ("next", 1.0),
                                 ("last", "filler"): ("last", 1.0), ("next", "negation"): ("next", 1.0),
                                 ("last", "negation"): ("next", 1.0), **over("next", "last")}, {"next": "last", "last": "no"})
    # Reported speech lasts to the end of the clause, and through a quote that follows it, at once or after
    # a comma or colon. A quote ends at its mark or with the line.
    report = Transducer("no", {**over("said"), ("no", "report"): ("said", 1.0), ("said", "pause"): ("introduced", 1.0),
                               ("introduced", "quote"): ("quoted", 1.0), ("introduced", "report"): ("said", 1.0),
                               ("introduced", "break"): ("introduced", 1.0), ("quoted", "break"): ("no", 1.0),
                               ("said", "insult"): ("said", REPORTED), ("said", "harm"): ("said", REPORTED),
                               ("said", "quote"): ("quoted", 1.0), ("quoted", "insult"): ("quoted", REPORTED),
                               ("quoted", "harm"): ("quoted", REPORTED), ("quoted", "quote"): ("no", 1.0)},
                        {"introduced": "no"})
    target = Transducer("no", {("no", "target"): ("seen", 1.0), ("seen", "insult"): ("seen", AIMED),
                               **over("seen")})
    # Harm is a threat only where an intent stands before it in the clause.
    threat = Transducer("no", {("no", "intent"): ("meant", 1.0), ("no", "harm"): ("no", 0.0),
                               ("meant", "harm"): ("meant", 1.0), **over("meant")})
    parts = (negation, report, target, threat)
    return compose(*parts), tuple(p.start for p in parts)


def stems_of(text: str) -> set[str]:
    """Stems of a text's words, and the words whole (marked by a blank)."""
    found = set()
    for word in set(_WORD.findall(text.lower())):
        for k in STEMS:
            if len(word) >= k:
                found.add(word[:k])
        found.add(word + " ")
    return found


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", sample: int = SAMPLE) -> tuple[dict[str, float], float]:
    """(weight by stem, prior log-odds) from the rows of ``labels``.

    The prior counts every label. Stems are counted on at most ``sample`` rows of each kind, those with
    the smallest hash of their id, so only that many ids are sent to the tasks. Their precision is that
    at the mix of all labels, whatever the sample's.
    """
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).dropna()
    n = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not n.get(0) or not n.get(1):
        return {}, math.log(1 / 9)
    prior = math.log(n[1] / n[0])
    picked = [smallest_hashes(known.filter(F.col("label") == k), "id", sample, n[k]) for k in (0, 1)]
    picked = stored(picked[0].unionAll(picked[1]), "toxicity-sample")

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: tuple[Counter, Counter] = (Counter(), Counter())

        def flushed():
            rows = [(s, int(label), k) for label in (0, 1) for s, k in counts[label].items()]
            for c in counts:
                c.clear()
            return pd.DataFrame(rows, columns=["stem", "label", "n"])

        for batch in batches:
            for text, label in zip(batch["text"], batch["label"], strict=True):
                counts[int(label == 1)].update(stems_of(text or ""))
                if len(counts[0]) + len(counts[1]) > HELD_COUNTS:
                    yield flushed()
        yield flushed()

    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = texts.join(F.broadcast(picked), "id").select("text", "label")
    counts = rows.mapInPandas(partial, "stem string, label int, n long").groupBy("stem").agg(
        F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("bad"), F.sum("n").alias("n"))
    counts = stored(counts.filter(F.col("n") >= SUPPORT), "toxicity-stems")
    kinds = {r["label"]: r["n"] for r in picked.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = kinds[1] / (kinds[0] + kinds[1])
    # Documents with the stem among all labels, as the sample has them: its mix of kinds is not theirs.
    toxic, clean = F.col("bad") * (n[1] / kinds[1]), (F.col("n") - F.col("bad")) * (n[0] / kinds[0])
    # Chance gives a stem this many toxic documents with a probability under exp(-evidence).
    q = F.col("bad") / F.col("n")
    part = lambda x, y: F.when(x > 0, x * F.log(x / y)).otherwise(0.0)
    evidence = F.col("n") * (part(q, F.lit(share)) + part(1 - q, F.lit(1 - share)))
    enough = math.log(max(1, counts.count())) + 3
    strong = (counts.withColumn("evidence", evidence).filter((toxic / (toxic + clean) >= PRECISION) & (F.col("evidence") >= enough))
              .orderBy(F.desc("evidence"), "stem").limit(LEXICON).collect())
    weights = {r["stem"]: min(HEAVIEST, math.log((r["bad"] + 0.5) / (kinds[1] + 1))
                              - math.log((r["n"] - r["bad"] + 0.5) / (kinds[0] + 1))) for r in strong}
    return weights, prior


class Scorer:
    """Scores texts; one per task."""

    def __init__(self, weights: dict[str, float], prior: float):
        self.weights, self.prior = weights, prior
        self.arcs, self.start = grammar()
        self.listed = {w: kind for kind, words in WORDS.items() for w in words.split()}
        self.classes = Memo(self.classify, 100_000)

    def classify(self, token: str) -> tuple[str, float]:
        """Class and weight of a token."""
        if not token[0].isalpha():
            return ENDS.get(token, "quote"), 0.0
        word = token.lower().replace("’", "'")
        kind = self.listed.get(word)
        if kind:
            return kind, LISTED if kind == "insult" else THREAT if kind == "harm" else 0.0
        learned = [self.weights[s] for s in itertools.chain((word[:k] for k in STEMS if len(word) >= k), (word + " ",))
                   if s in self.weights]
        return ("insult", max(learned)) if learned else ("other", 0.0)

    def clauses(self, text: str | None) -> list[tuple[float, str]]:
        """(weight, words) of each clause with an insult or a threat."""
        tokens = _TOKEN.findall(text or "")
        classes = list(map(self.classes.__getitem__, tokens))
        if not any(weight for _, weight in classes):
            return []
        found, state, total, first = [], self.start, 0.0, 0
        ends = frozenset(ENDS.values())
        for i, (kind, weight) in enumerate([*classes, ("end", 0.0)]):
            state, factor = self.arcs[state, kind]
            total += weight * factor
            if kind in ends:
                if total:
                    found.append((total, " ".join(tokens[first:i])))
                total, first = 0.0, i + 1
        return found

    def score(self, text: str | None) -> float:
        odds = self.prior + min(MOST, sum(weight for weight, _ in self.clauses(text)))
        return 1.0 / (1.0 + math.exp(-odds))


def toxicity_column(text: Column, weights: dict[str, float], prior: float) -> Column:
    """Score (0 to 1) of a text column."""

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(weights, prior)
        for texts in batches:
            yield pd.Series([scorer.score(t) for t in texts], dtype="float64")

    return scored(text)
