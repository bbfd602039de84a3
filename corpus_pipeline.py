"""The corpus pipeline: documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir), works on every row its predecessor kept and returns the columns of
documents; the last returns the packed pieces. ``run`` writes each stage's rows to the shared folder and
reads them again as the next stage's documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseweek.llm import exact_dedup, language_id, packing, quality_rules, simhash
from caseweek.llm.common import on_workers, stored


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages that the rows with a language teach. Texts without letters go, and texts
    that fit their language worse than nearly all that teach it (gibberish, other languages, code); of short texts
    less is asked. Null and empty texts go, repeated rows go or stay together, an empty table gives no rows."""
    profiles = language_id.learn_profiles(docs)
    found = stored(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("lang"),
                               language_id.letters(F.col("text")).alias("n_letters"),
                               language_id.language_column(F.col("text"), profiles).alias("found")), "pipeline-found")
    keep = language_id.is_language(F.col("found"), F.col("n_letters"), language_id.fit_bounds(found))
    return found.filter(keep).select("row.*")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules' votes find good. Null, empty and very short texts go; rows are judged each
    for itself, ties of the posterior with the threshold stay, an empty table gives no rows."""
    return quality_rules.keep_good(docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the one with the largest id (of rows that share it, any one; null
    ids are smallest). Null counts as empty, an empty table gives no rows."""
    _, kept = exact_dedup.deduplicate(docs)
    return kept


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints: the one with the smallest id. Texts without words are
    alike, an empty table gives no rows."""
    return simhash.keep_one(docs, shingle_words=3, max_bits=3)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' tokens and their places in sequences of 1024. A null or empty text is an end token,
    every row is packed, an empty table gives no rows."""
    packed = packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=2, capacity=1024)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [(name, on_workers(stage)) for name, stage in (
    ("language", identify_language),
    ("quality", keep_quality),
    ("exact", drop_exact_copies),
    ("near", drop_near_copies),
    ("pack", pack_sequences),
)]

#: The stages take learned models, bit counts and tokenizers; tests hold them against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, applied to documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
