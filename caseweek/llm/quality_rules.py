"""Quality rules as weak supervision (operator 1), with DataFrame functions only.

Each rule looks at a few figures of a text and votes that the document is good (1), bad (-1), or
abstains (0). Expectation-maximisation on the counts of vote patterns over all documents estimates how
often good and bad documents are and how each rule votes on either, without any labels; a document is
kept if the posterior probability that it is good is high enough, instead of passing every rule.

There are at most 3^rules patterns, so each round works on a small table however large the corpus; one
row of sums a round comes to the driver. Posteriors are then plain column arithmetic.

Defined results: a null text has no words and no lines; empty and blank texts have no words; every row
has its own figures (repeated rows and null ids too); an empty table gives no rows and leaves the
starting estimates as they are; other columns are kept apart and may have any names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

#: Signs counted as symbols, and ASCII white space (fixed values).
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\f\r"
#: Words of a window; window repeats that fail a document, in percent of its words; least words.
WINDOW = 5
REPEAT_PERCENT = 20
LEAST_WORDS = 10
#: Posterior from which a document is kept, and rounds of estimation.
THRESHOLD = 0.5
ROUNDS = 25
#: Documents that the starting estimates count for: they tell good from bad where the corpus is too small
#: to, and are nothing against a large one.
PRIOR_DOCUMENTS = 20.0


@dataclass(frozen=True)
class Rule:
    """Votes good where ``good`` holds, else bad where ``bad`` holds, else abstains."""

    name: str
    good: str
    bad: str


#: The rules, over the figures of ``with_figures``. Most only know a defect and abstain without it, so that
#: a text with one defect isn't outvoted by rules that look for others.
RULES = (
    Rule("length", "n_words >= 10", "n_words < 10"),
    Rule("letters", "4 * n_letters >= 3 * word_chars", "2 * n_letters < word_chars"),
    Rule("symbols", "false", "20 * n_symbols > n_words"),
    Rule("symbol_runs", "false", "20 * n_symbol_runs > n_words"),
    Rule("repeated_words", "false", "10 * n_repeat_words > n_words"),
    Rule("few_distinct_words", "false", "4 * n_distinct_words < n_words"),
    Rule("repeated_lines", "false", "3 * n_dup_lines > n_lines"),
    Rule("capitals", "false", "3 * n_capitals > word_chars"),
    Rule("exclamation", "false", "4 * n_exclaimed > n_words"),
)


#: The figures that ``judge`` returns, and those that only rules use.
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FOR_RULES = ("n_lines", "n_letters", "n_symbol_runs", "n_capitals", "n_exclaimed", "n_distinct_words")


def with_figures(rows: DataFrame, keep: str) -> DataFrame:
    """Column ``keep`` of ``rows`` and the figures of their column ``text``.

    The parts of a text are columns of a projection of their own, so none is worked out twice.
    """
    text = F.coalesce("text", F.lit(""))
    # One blank each between words; then the words are the parts between blanks, none of them empty.
    plain = F.btrim(F.translate(text, BLANKS, " " * len(BLANKS)), F.lit(" "))
    parts = rows.select(
        keep, F.filter(F.split(plain, " +"), lambda w: w != "").alias("words"),
        F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "").alias("lines"),
        F.length(text).cast("long").alias("chars"),
        F.length(F.translate(text, BLANKS, "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(text, r"\p{Lu}+", "")).cast("long").alias("uncapital"),
        F.regexp_replace(text, r"\p{L}+", "").alias("signs"))
    n_words, n_signs = F.size("words"), F.length("signs").cast("long")
    shifted = [F.slice("words", k + 1, F.greatest(n_words - WINDOW + 1, F.lit(0))).alias(f"w{k}") for k in range(WINDOW)]
    hashes = F.transform(F.arrays_zip(*shifted), lambda w: F.xxhash64(w))
    counted = parts.select(
        keep, n_words.cast("long").alias("n_words"), "word_chars",
        (n_signs - F.length(F.translate("signs", SYMBOLS, ""))).alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.col("chars") - n_signs).alias("n_letters"),
        F.regexp_count("signs", F.lit(f"[{SYMBOLS}]+")).cast("long").alias("n_symbol_runs"),
        (F.col("chars") - F.col("uncapital")).alias("n_capitals"),
        (n_signs - F.length(F.translate("signs", "!", ""))).alias("n_exclaimed"),
        F.size(F.array_distinct("words")).cast("long").alias("n_distinct_words"),
        hashes.alias("hashes"))
    figures = [c for c in (*BASE, *FOR_RULES) if c != "n_repeat_words"]
    # Windows sorted by hash stand beside their equals; a text whose windows all differ has none to sort.
    placed = F.sort_array(F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    sorted_ = counted.select(keep, *figures, F.when(F.size(F.array_distinct("hashes")) < F.size("hashes"), placed)
                             .alias("placed"))
    paired = sorted_.select(keep, *figures, F.filter(
        F.arrays_zip(F.col("placed").alias("x"), F.slice("placed", 2, F.size("placed")).alias("y")),
        lambda p: p["x"]["h"] == p["y"]["h"]).alias("pairs"))
    # The places of windows that occur again, in order; each covers its words up to the next place.
    covering = paired.select(keep, *figures, F.array_sort(F.array_distinct(F.concat(
        F.col("pairs.x.i"), F.col("pairs.y.i")))).alias("places"))
    words = F.aggregate(
        F.arrays_zip(F.col("places").alias("a"), F.slice("places", 2, F.size("places")).alias("b")),
        F.lit(0).cast("long"),
        lambda total, s: total + F.coalesce(F.least(s["b"] - s["a"], F.lit(WINDOW)), F.lit(WINDOW)))
    return covering.select(keep, *figures, F.coalesce(words, F.lit(0).cast("long")).alias("n_repeat_words"))


def votes(rules: tuple[Rule, ...] = RULES) -> Column:
    """Array of the rules' votes on the figures."""
    return F.array(*[F.expr(f"CASE WHEN {r.good} THEN 1 WHEN {r.bad} THEN -1 ELSE 0 END") for r in rules])


class VoteModel:
    """Share of good documents, and each rule's chances of voting 1 or -1 on good and on bad ones."""

    #: Starting estimates: a bad vote is taken to be much likelier on a bad document.
    GOOD_SHARE, ON_GOOD, ON_BAD = 0.8, (0.6, 0.02), (0.3, 0.3)

    def __init__(self, rules: tuple[Rule, ...] = RULES):
        self.good_share = self.GOOD_SHARE
        #: By rule: ((vote 1, vote -1) on good documents, the same on bad ones).
        self.chances = [(self.ON_GOOD, self.ON_BAD) for _ in rules]

    def posterior(self, votes_col: Column) -> Column:
        """Probability that a document with these votes is good."""
        odds = F.log(F.lit(self.good_share / (1 - self.good_share)))
        for k, ((up, down), (bad_up, bad_down)) in enumerate(self.chances):
            vote = F.element_at(votes_col, k + 1)
            odds = odds + (F.when(vote == 1, F.log(F.lit(up / bad_up))).when(vote == -1, F.log(F.lit(down / bad_down)))
                           .otherwise(F.log(F.lit((1 - up - down) / (1 - bad_up - bad_down)))))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-odds))

    def improve(self, patterns: DataFrame) -> float:
        """One round on (votes, n); the largest change of an estimate."""
        weighed = patterns.withColumn("good", self.posterior(F.col("votes")) * F.col("n"))
        sums = [F.sum("n").alias("n"), F.sum("good").alias("good")]
        for k in range(len(self.chances)):
            vote = F.element_at("votes", k + 1)
            for label, value in (("up", 1), ("down", -1)):
                sums += [F.sum(F.when(vote == value, F.col("good")).otherwise(0.0)).alias(f"good_{label}_{k}"),
                         F.sum(F.when(vote == value, F.col("n")).otherwise(0)).alias(f"all_{label}_{k}")]
        row = weighed.agg(*sums).first()
        if not row["n"]:
            return 0.0
        good, bad, w = row["good"], row["n"] - row["good"], PRIOR_DOCUMENTS
        share, chances = (good + w * self.GOOD_SHARE) / (row["n"] + w), []
        for k in range(len(self.chances)):
            on_good = [row[f"good_{x}_{k}"] for x in ("up", "down")]
            on_bad = [row[f"all_{x}_{k}"] - g for x, g in zip(("up", "down"), on_good, strict=True)]
            chances.append((tuple((v + w * p) / (good + w) for v, p in zip(on_good, self.ON_GOOD, strict=True)),
                            tuple((v + w * p) / (bad + w) for v, p in zip(on_bad, self.ON_BAD, strict=True))))
        change = max(abs(share - self.good_share), *(abs(a - b) for old, new in zip(self.chances, chances, strict=True)
                                                     for x, y in zip(old, new, strict=True)
                                                     for a, b in zip(x, y, strict=True)))
        self.good_share, self.chances = share, chances
        return change


def estimate(voted: DataFrame, rounds: int = ROUNDS, rules: tuple[Rule, ...] = RULES) -> VoteModel:
    """The model of a table with a ``votes`` column, from the counts of its patterns."""
    patterns = stored(voted.groupBy("votes").agg(F.count(F.lit(1)).alias("n")), "rules-patterns").coalesce(1).cache()
    model = VoteModel(rules)
    for _ in range(rounds):
        if model.improve(patterns) < 1e-4:
            break
    patterns.unpersist()
    return model


def base_failed() -> Column:
    """Too few words, or too many of them in repeated windows."""
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, good_probability)."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    voted = stored(with_figures(rows, "id").select("id", *BASE, votes().alias("votes")), "rules-votes")
    good = estimate(voted).posterior(F.col("votes"))
    return voted.select(F.col("id").alias(id_col), *BASE, base_failed().alias("base_failed"),
                        (~base_failed() & (good >= threshold)).alias("kept"), good.alias("good_probability"))


def keep_good(docs: DataFrame, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, whole."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.col(f"`{text_col}`").alias("text"))
    voted = stored(with_figures(rows, "row").select("row", *BASE, votes().alias("votes")), "rules-votes")
    good = estimate(voted).posterior(F.col("votes"))
    return voted.filter(~base_failed() & (good >= threshold)).select("row.*")
