"""Quality classifier by positive-unlabelled learning (operator 4).

Trusted positives are the rows labelled good; everything else is unlabelled web text, good or bad. A text
is described by shares of its characters, words and lines; each figure is cut into bins at quantiles, and
the score is the logistic function of a weight for each bin.

Training is in three steps on a bounded sample. A plain classifier tells positives from unlabelled text.
On rows it hasn't seen, the least ratio of unlabelled to positive rows above a threshold of its score
bounds the class prior, the share of good documents in unlabelled text. The weights then minimise the
non-negative unbiased risk: prior * R_p(+) + max(0, R_u(-) - prior * R_p(-)); where the part in the
maximum turns negative, the step goes against it.

Defined results: null counts as empty; empty and blank texts get figures of zero and a score like any
other; rows without a label are unlabelled; without positives or without unlabelled text every score is
0.5; repeated rows and null ids are scored like any other; extra columns are ignored.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import smallest_hashes, stored

#: Rows of each kind that are learned from, at most: those with the smallest hash of their id.
SAMPLE = 20_000
#: Bins of a figure, steps of training, step size and pull of weights towards zero.
BINS = 12
STEPS = 600
RATE = 0.05
DECAY = 1e-4
#: Share of the positives that a threshold must leave for its ratio to count, and its margin of chance.
LEAST_ABOVE = 0.1

FIGURES = ("words", "chars_a_word", "letters", "capitals", "digits", "symbols", "punctuation", "symbol_runs",
           "exclamation", "distinct_words", "stutters", "distinct_triples", "distinct_lines", "words_a_line",
           "short_words", "sentence_ends")

_RUN = re.compile(r"[#*$%&|<>]+")
_classes: np.ndarray | None = None


def _char_classes() -> np.ndarray:
    """0 white space, 1 small letter, 2 capital, 3 digit, 4 symbol, 5 exclamation, 6 other punctuation, 7 rest."""
    global _classes
    if _classes is None:
        table = np.full(0x110000, 7, np.uint8)
        for i in range(0x30000):  # letters beyond are few; they count as the rest
            kind = unicodedata.category(chr(i))
            if kind[0] == "L":
                table[i] = 2 if kind == "Lu" else 1
            elif kind == "Nd":
                table[i] = 3
            elif kind[0] == "P":
                table[i] = 6
            elif kind[0] == "Z" or 9 <= i <= 13:
                table[i] = 0
        table[[ord(c) for c in "#*$%&|<>"]] = 4
        table[ord("!")] = 5
        _classes = table
    return _classes


def describe(text: str | None) -> list[float]:
    """The figures of a text."""
    text = text or ""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(FIGURES)
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    counts = np.bincount(_char_classes()[codes], minlength=8)
    chars = max(1, int(counts[1:].sum()))
    lines = [x for x in text.split("\n") if x.strip()]
    stutters = sum(map(str.__eq__, words, words[1:]))
    triples = len(set(zip(words, words[1:], words[2:], strict=False)))
    return [np.log1p(n), chars / n, (counts[1] + counts[2]) / chars, counts[2] / chars, counts[3] / chars,
            counts[4] / chars, counts[6] / chars, len(_RUN.findall(text)) / n, counts[5] / n, len(set(words)) / n,
            stutters / n, triples / max(1, n - 2), len(set(lines)) / len(lines), np.log1p(n / len(lines)),
            sum(1 for w in words if len(w) <= 3) / n, text.count(".") / n]


@dataclass
class Model:
    """Bin edges of each figure, the weight of each bin, and the estimated class prior."""

    edges: np.ndarray  # figures x (BINS - 1)
    weights: np.ndarray  # figures x BINS
    bias: float
    prior: float

    def bins(self, figures: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x, side="right") for e, x in zip(self.edges, figures.T, strict=True)], axis=1)

    def odds(self, figures: np.ndarray) -> np.ndarray:
        return self.bias + self.weights[np.arange(self.weights.shape[0]), self.bins(figures)].sum(axis=1)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def _softplus(x: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, x)


def _train(p: np.ndarray, u: np.ndarray, gradient, steps: int = STEPS) -> tuple[np.ndarray, float]:
    """(weights, bias) by Adam; ``gradient`` gives derivatives by the odds of positives and unlabelled rows."""
    k = p.shape[1]
    offsets = np.arange(k) * BINS
    flat_p, flat_u = (p + offsets).ravel(), (u + offsets).ravel()
    theta, m, v = np.zeros(k * BINS + 1), np.zeros(k * BINS + 1), np.zeros(k * BINS + 1)
    for t in range(1, steps + 1):
        odds_p, odds_u = (theta[:-1][x + offsets].sum(axis=1) + theta[-1] for x in (p, u))
        gp, gu = gradient(odds_p, odds_u)
        g = np.append(np.bincount(flat_p, np.repeat(gp, k), minlength=k * BINS)
                      + np.bincount(flat_u, np.repeat(gu, k), minlength=k * BINS), gp.sum() + gu.sum())
        g[:-1] += DECAY * theta[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta -= RATE * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
    return theta[:-1].reshape(k, BINS), float(theta[-1])


def estimate_prior(scores_p: np.ndarray, scores_u: np.ndarray) -> float:
    """Share of positives in unlabelled rows: the least ratio of both kinds' shares above a threshold."""
    sorted_p, sorted_u = np.sort(scores_p), np.sort(scores_u)
    above_p = 1 - np.searchsorted(sorted_p, sorted_p) / len(sorted_p)
    above_u = 1 - np.searchsorted(sorted_u, sorted_p) / len(sorted_u)
    margin = np.sqrt(np.log(4 / 0.1) / 2 / len(sorted_u)) + np.sqrt(np.log(4 / 0.1) / 2 / len(sorted_p))
    usable = above_p >= LEAST_ABOVE
    at = int(np.argmin(np.where(usable, (above_u + margin) / np.maximum(above_p, 1e-9), np.inf)))
    return float(np.clip(above_u[at] / above_p[at], 0.01, 0.99))


def fit(positive: np.ndarray, unlabelled: np.ndarray) -> Model | None:
    """A model from the figures of positive and unlabelled rows; None where either kind has fewer than two."""
    if len(positive) < 2 or len(unlabelled) < 2:
        return None
    both = np.concatenate([positive, unlabelled])
    edges = np.quantile(both, np.linspace(0, 1, BINS + 1)[1:-1], axis=0).T
    model = Model(edges, np.zeros((both.shape[1], BINS)), 0.0, 0.5)
    p, u = model.bins(positive), model.bins(unlabelled)
    seen_p, seen_u = np.arange(len(p)) % 2 == 0, np.arange(len(u)) % 2 == 0

    def apart(odds_p, odds_u):
        return -_sigmoid(-odds_p) / len(odds_p), _sigmoid(odds_u) / len(odds_u)

    model.weights, model.bias = _train(p[seen_p], u[seen_u], apart, STEPS // 2)
    model.prior = prior = estimate_prior(model.odds(positive[~seen_p]), model.odds(unlabelled[~seen_u]))

    def non_negative(odds_p, odds_u):
        n_p, n_u = len(odds_p), len(odds_u)
        negative = _softplus(odds_u).mean() - prior * _softplus(odds_p).mean()
        plus = -prior * _sigmoid(-odds_p) / n_p
        minus_p, minus_u = -prior * _sigmoid(odds_p) / n_p, _sigmoid(odds_u) / n_u
        return (plus + minus_p, minus_u) if negative >= 0 else (-minus_p, -minus_u)

    model.weights, model.bias = _train(p, u, non_negative)
    return model


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", sample: int = SAMPLE) -> Model | None:
    """A model of ``docs`` (only rows to learn from), positive where their label is 1.

    At most ``sample`` rows of each kind are used; the driver gets their figures, no texts.
    """
    ids = docs.select(F.col(id_col).alias("id")).dropna()
    good = labels.filter(F.col(label_col) == 1).select(F.col(id_col).alias("id")).dropna().distinct()
    kinds = [ids.join(good, "id", how) for how in ("left_semi", "left_anti")]
    sizes = ids.join(good.withColumn("good", F.lit(1)), "id", "left").agg(F.count("good"), F.count(F.lit(1))).first()
    positive, unlabelled = (stored(smallest_hashes(rows, "id", sample, n), f"quality-{name}") for rows, n, name in
                            zip(kinds, (sizes[0], sizes[1] - sizes[0]), ("positive", "unlabelled"), strict=True))
    picked = positive.withColumn("positive", F.lit(True)).unionAll(unlabelled.withColumn("positive", F.lit(False)))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = texts.join(F.broadcast(picked.distinct()), "id").select("id", "positive", _figures(F.col("text")).alias("x"))
    found = rows.toPandas().sort_values(["positive", "id"], kind="stable").drop_duplicates(["positive", "id"])
    kinds = [found.loc[found["positive"] == k, "x"].to_list() for k in (True, False)]
    return fit(*[np.array(x, float).reshape(-1, len(FIGURES)) for x in kinds])


def _figures(text: Column) -> Column:
    @F.pandas_udf("array<double>")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([np.array(describe(t), float) for t in texts], dtype=object)

    return of(text)


def quality_column(text: Column, model: Model | None) -> Column:
    """Score (0 to 1) of a text column."""

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            if model is None or not len(texts):
                yield pd.Series(np.full(len(texts), 0.5))
            else:
                yield pd.Series(_sigmoid(model.odds(np.array([describe(t) for t in texts], float))))

    return scored(text)
