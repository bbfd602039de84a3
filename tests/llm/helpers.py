"""Small document tables with every awkward case."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = ["the", "cat", "sat", "on", "a", "mat", "and", "then", "ran", "home", "again", "while", "rain", "fell", "it"]
DEUTSCH = ["der", "hund", "läuft", "über", "die", "straße", "und", "bellt", "weil", "es", "schön", "ist"]


def prose(seed: int, n: int, words=WORDS) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(words) + ("." if r.random() < 0.1 else "") for _ in range(n))


def documents(spark, extra: bool = True):
    """Nulls in every column, empty and long texts, copies, near copies, repeated rows and ids, clashing columns."""
    base = prose(1, 120)
    texts = [base, base, base.replace("cat", "CAT", 1), prose(2, 80), prose(3, 90, DEUTSCH), prose(4, 60, DEUTSCH), None, "", "",
             " \n\t ", "word", "12 34 !!", prose(5, 20_000), "\n".join([base[:60]] * 9), prose(6, 30) + "\n" + base[:60],
             "x\n  " + base[:60].upper() + " \ny", "### $$$ %%% " * 20, "é" * 3000, "idiot " + prose(7, 40)]
    rows = [(i, t, "de" if t and "hund" in t else "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    rows += [(3, texts[3], None, None, None), (3, texts[3], None, None, None), (None, base, None, None, None),
             (None, None, None, None, None), (3, "another text under a used id", "en", "s", 28)]
    df = spark.createDataFrame(rows, DOCS)
    if extra:
        from pyspark.sql import functions as F
        clash = ("id", "fp", "kept", "score", "row", "words", "votes", "file", "hash", "n_words", "length", "batch")
        df = df.select("*", *[F.lit("clash").alias(c) for c in clash])
    return df


def empty(spark):
    return spark.createDataFrame([], DOCS)
