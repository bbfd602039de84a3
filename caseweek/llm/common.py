"""Helpers shared by the operators: shared-folder tables, folds and row wrapping."""

from __future__ import annotations

import functools
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import work_path

#: Code points that Unicode calls White_Space (fixed values).
WHITE_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def ship_package(spark: SparkSession) -> None:
    """Send this package's files with the application, once, so that Python workers can import it wherever
    they run. The archive is made on the driver; Spark serves it to the executors."""
    context, package = spark.sparkContext, Path(__file__).resolve().parents[1]
    if package.is_dir() and not getattr(context, "_caseweek_shipped", False):
        folder = tempfile.mkdtemp(prefix="caseweek-package-")
        context.addPyFile(shutil.make_archive(f"{folder}/caseweek", "zip", package.parent, package.name))
        context._caseweek_shipped = True


def on_workers(query):
    """``query`` (its first argument a session) with the package shipped before."""

    @functools.wraps(query)
    def shipped(spark, *args, **kwargs):
        ship_package(spark)
        return query(spark, *args, **kwargs)

    return shipped


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole documents table."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole labels table."""
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Evaluated once, the lineage ends there, and a lost executor costs nothing
    that was already written.
    """
    path = work_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def in_fold(id_col: Column, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id's text leaves ``remainder`` (a null id counts as empty text)."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % modulus == remainder


#: How many times the rows wanted a hash bound lets through, and at how many rows more is room for chance.
ROOM, CHANCE = 2.0, 1000


def smallest_hashes(rows: DataFrame, id_col: str, most: int, n: int) -> DataFrame:
    """The ``most`` rows of ``rows`` whose ids have the smallest hashes (ties by id); ``n`` is how many there are.

    Hashes are spread evenly, so a bound on them lets about ``ROOM * most`` rows through, wherever they lie, and
    only those are put in order: what meets in one task is bounded by the sample, not by the number of tasks. Of
    few rows, all are let through. Should so many rows share their ids that too few pass, all are put in order.
    """
    h = F.xxhash64(id_col)
    order = (h, F.col(id_col))
    share = (ROOM * most + CHANCE) / max(n, 1)
    if share >= 1:
        return rows.orderBy(*order).limit(most)
    bound = int(-(1 << 63) + share * (1 << 64))
    within = rows.filter(h <= F.lit(bound))
    if within.count() < most:
        return rows.orderBy(*order).limit(most)
    return within.orderBy(*order).limit(most)


class Memo(dict):
    """Computed values by text. When it is full, values not used since it was last full are forgotten,
    so its size is bounded; long texts are computed each time."""

    def __init__(self, compute, entries: int, longest: int = 64):
        super().__init__()
        self.compute, self.entries, self.longest, self.old = compute, entries, longest, {}

    def __missing__(self, text):
        value = self.old.get(text)
        if value is None:
            value = self.compute(text)
        if len(text) <= self.longest:
            if len(self) >= self.entries:
                self.old = dict(self)
                self.clear()
            self[text] = value
        return value
