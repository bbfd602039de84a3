"""Language identification by rank-order n-gram profiles (operator 7).

A language's profile is the rank order of its most frequent character n-grams (one to three characters
of a word with a blank at both ends), counted over all its training documents. A document's own profile
is compared with each by the out-of-place distance: the sum of rank differences, a missing n-gram
counting as the profile size. The nearest language wins; equal distances go to the first name.

Defined results: null, empty or letterless text gives ``und`` and score 0; rows without a language teach
nothing; without any training row every document is ``und``; repeated rows and null ids are scored like
any other; equal n-gram counts rank shorter n-grams first, then by code points; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: N-grams in a profile.
PROFILE_SIZE = 300
#: Characters of one language counted together while training, and n-grams counted by a table at a time.
TRAIN_CHARS = 500_000
SLICE = 1_000_000
#: Alphabets up to this size are counted in a dense table.
DENSE = 128

_BITS = 21  # of a code point; an n-gram's key holds its code points, so shorter n-grams have smaller keys
_index_of = np.zeros(0x110000, np.int32)


def ngram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Keys (ascending) and counts of the one- to three-character n-grams of a text's words."""
    low = text.lower()
    letters = sorted(c for c in set(low) if c.isalpha())
    if not letters:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    points = np.array([32, *map(ord, letters)], np.int64)
    _index_of[points[1:]] = np.arange(1, len(points))
    at = _index_of[np.frombuffer(low.encode("utf-32-le", "surrogatepass"), np.uint32)]
    _index_of[points[1:]] = 0
    after_letter = np.zeros(len(at), bool)
    after_letter[1:] = at[:-1] > 0
    s = np.concatenate([[0], at[(at > 0) | after_letter], [0]]).astype(np.int64)
    if s[-2] == 0:
        s = s[:-1]
    base = len(points)
    singles = np.bincount(s, minlength=base)
    singles[0] = 0
    found = [_keys(singles, points, base, 1)]
    for n in (2, 3):
        if base <= DENSE:
            table = np.zeros(base ** n, np.int64)
            for part in _ngrams(s, base, n):
                table += np.bincount(part, minlength=len(table))
            found.append(_keys(table, points, base, n))
        else:
            parts = [np.unique(p, return_counts=True) for p in _ngrams(s, base, n)]
            keys, inverse = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
            counts = np.bincount(inverse, np.concatenate([c for _, c in parts])).astype(np.int64)
            found.append((_points(keys, points, base, n), counts))
    return np.concatenate([k for k, _ in found]), np.concatenate([c for _, c in found])


def _ngrams(s: np.ndarray, base: int, n: int) -> Iterator[np.ndarray]:
    """Numbers of the n-grams of ``s`` that stay within one word and its blanks, a slice at a time."""
    for i in range(0, len(s) - n + 1, SLICE):
        part = s[i:i + SLICE + n - 1]
        if n == 2:
            yield part[:-1] * base + part[1:]
        else:
            yield ((part[:-2] * base + part[1:-1]) * base + part[2:])[part[1:-1] > 0]


def _points(numbers: np.ndarray, points: np.ndarray, base: int, n: int) -> np.ndarray:
    key = np.zeros(len(numbers), np.int64)
    for k in range(n):
        key |= points[numbers // base ** k % base] << (_BITS * k)
    return key


def _keys(table: np.ndarray, points: np.ndarray, base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    there = np.flatnonzero(table)
    return _points(there, points, base, n), table[there]


def most_frequent(keys: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """The ``size`` keys of highest count in rank order; ``keys`` ascend."""
    if len(keys) > size:
        least = np.partition(counts, len(counts) - size)[len(counts) - size]
        keys, counts = keys[counts >= least], counts[counts >= least]
    return keys[np.argsort(-counts, kind="stable")][:size]


def learn_profiles(docs: DataFrame, lang_col: str = "lang", text_col: str = "text",
                   size: int = PROFILE_SIZE) -> dict[str, list[int]]:
    """Keys of each language's profile in rank order, counted over every row with a language.

    Only the profiles come to the driver: ``size`` keys a language.
    """

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, list[str]] = {}
        chars: dict[str, int] = {}

        def counted(lang):
            keys, counts = ngram_counts("\n".join(held.pop(lang)))
            chars.pop(lang)
            return pd.DataFrame({"lang": lang, "ngram": keys, "n": counts})

        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"], strict=True):
                held.setdefault(lang, []).append(text)
                chars[lang] = chars.get(lang, 0) + len(text)
                if chars[lang] >= TRAIN_CHARS:
                    yield counted(lang)
        for lang in list(held):
            yield counted(lang)

    taught = docs.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).dropna()
    counts = (taught.mapInPandas(partial, "lang string, ngram long, n long")
              .groupBy("lang", "ngram").agg(F.sum("n").alias("n")))
    ranked = counts.withColumn("rank", F.row_number().over(
        Window.partitionBy("lang").orderBy(F.desc("n"), "ngram"))).filter(F.col("rank") <= size)
    profiles: dict[str, list[tuple[int, int]]] = {}
    for row in ranked.collect():
        profiles.setdefault(row["lang"], []).append((row["rank"], row["ngram"]))
    return {lang: [g for _, g in sorted(p)] for lang, p in sorted(profiles.items())}


class Identifier:
    """Scores texts against profiles."""

    def __init__(self, profiles: dict[str, list[int]], size: int = PROFILE_SIZE):
        self.langs, self.size = list(profiles), size
        self.known = np.unique(np.array([g for p in profiles.values() for g in p], np.int64))
        self.ranks = np.full((len(profiles), len(self.known)), -1, np.int64)
        for row, p in zip(self.ranks, profiles.values(), strict=True):
            row[np.searchsorted(self.known, p)] = np.arange(len(p))

    def identify(self, text: str | None) -> tuple[str, float, float]:
        """Language, lead over the second language, and closeness to the winner's profile (0 to 1)."""
        mine = most_frequent(*ngram_counts(text or ""), self.size)
        if not len(mine) or not self.langs:
            return "und", 0.0, 0.0
        at = np.minimum(np.searchsorted(self.known, mine), len(self.known) - 1)
        theirs = self.ranks[:, at]
        there = (self.known[at] == mine) & (theirs >= 0)
        distances = np.where(there, np.abs(theirs - np.arange(len(mine))), self.size).sum(axis=1)
        worst = self.size * len(mine)
        first = int(np.argmin(distances))
        best = int(distances[first])
        second = int(np.delete(distances, first).min()) if len(distances) > 1 else worst
        return self.langs[first], (second - best) / second if second else 0.0, 1.0 - best / worst


def language_column(text: Column, profiles: dict[str, list[int]], size: int = PROFILE_SIZE) -> Column:
    """struct<lang_pred, score, fit> of a text column."""

    @F.pandas_udf("lang_pred string, score double, fit double")
    def identified(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        identifier = Identifier(profiles, size)
        for texts in batches:
            yield pd.DataFrame([identifier.identify(t) for t in texts], columns=["lang_pred", "score", "fit"])

    return identified(text)


#: Letters from which a text's fit is judged in full; of a shorter text in proportion less is asked.
FULL = 400
#: Quantile of the fits of the rows that teach, and the share of it that is asked of a text.
QUANTILE, SHARE = 0.01, 0.8
#: Asked where a language has no rows of that many letters.
LEAST_FIT = 0.02


def letters(text: Column) -> Column:
    """Letters of a text."""
    return F.coalesce(F.length(F.regexp_replace(text, r"\P{L}+", "")), F.lit(0))


def fit_bounds(found: DataFrame) -> dict[str, float]:
    """Least fit of each language, from all rows ``(lang, n_letters, found)`` whose language is known and found
    right: a low quantile of their fits, less a margin. One figure a language comes to the driver."""
    right = found.filter((F.col("lang") == F.col("found.lang_pred")) & (F.col("n_letters") >= FULL))
    rows = right.groupBy("lang").agg(F.percentile_approx("found.fit", QUANTILE, F.lit(100_000)).alias("fit")).collect()
    return {r["lang"]: SHARE * r["fit"] for r in rows}


def is_language(found: Column, n_letters: Column, bounds: dict[str, float]) -> Column:
    """Whether a text is in the language found: it has letters and fits about as well as the rows that teach."""
    bound = F.lit(LEAST_FIT)
    for lang, fit in bounds.items():
        bound = F.when(found["lang_pred"] == lang, fit).otherwise(bound)
    return (found["lang_pred"] != "und") & (found["fit"] >= bound * F.least(F.lit(1.0), n_letters / F.lit(FULL)))
