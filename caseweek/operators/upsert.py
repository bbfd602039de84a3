"""Partition-scoped upsert of fact rows keyed by case number."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import FACT_COLUMNS, PARTITION_COLUMNS
from ..session import fits_broadcast


def touched_partitions(facts: DataFrame) -> DataFrame:
    """Distinct ``(year, week)`` of a batch."""
    return facts.select(*PARTITION_COLUMNS).distinct()


def last_drops(coded: DataFrame, drop: str, mode: str) -> DataFrame:
    """The rows that remain of several drops loaded one after another, as one batch.

    ``upsert``: a case's rows of the last drop that has it in that week. ``overwrite``: a week's rows of the
    last drop that has the week. ``append``: all rows. Keys that only one drop has need no comparison, so what
    meets the rows is the list of the others; it is broadcast if its size allows.
    """
    if mode == "append":
        return coded
    keys = [*PARTITION_COLUMNS, "caseNum"] if mode == "upsert" else list(PARTITION_COLUMNS)
    several = coded.groupBy(*keys).agg(F.min(drop).alias("_lo"), F.max(drop).alias("_hi")).where("_lo < _hi")
    several = several.select(*[F.col(k).alias(f"_of_{k}") for k in keys], "_hi")
    if fits_broadcast(several):
        several = F.broadcast(several)
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_of_{k}"))
    rows = coded.join(several, same, "left")
    return rows.where(F.col("_hi").isNull() | (F.col(drop) == F.col("_hi"))).select(*coded.columns)


def merge_partitions(current: DataFrame, batch: DataFrame, scoped: bool = False,
                     broadcast_check: bool = True) -> DataFrame:
    """New contents of every partition the batch touches.

    ``current`` is the existing fact table (any superset of the touched
    partitions). Within a touched partition an old row survives unless the
    batch carries its case number for that partition; all batch rows are
    added (batch duplicates kept). Untouched partitions are not in the
    result, so a dynamic-partition overwrite leaves them as they are.
    ``scoped=True`` says ``current`` already holds only touched partitions
    (e.g. from ``read_partitions``), which skips a second semi join.

    The batch's (year, week, caseNum) keys grow with the weekly batch, not
    with the fact table; after a count shows they fit the broadcast bound
    they are broadcast, so the existing rows are filtered where they are
    read instead of being shuffled (AQE could only switch to a broadcast
    after that shuffle was written).
    """
    if not scoped:
        current = current.join(touched_partitions(batch), PARTITION_COLUMNS, "left_semi")
    replaced = batch.select(*PARTITION_COLUMNS, "caseNum").distinct()
    if broadcast_check and fits_broadcast(replaced):
        replaced = F.broadcast(replaced)
    # null-safe: a row without a case number is replaced by one without, not added to it
    old, new = current.alias("old"), replaced.alias("new")
    same = [F.col(f"old.{c}") == F.col(f"new.{c}") for c in PARTITION_COLUMNS]
    survivors = old.join(new, same[0] & same[1] & F.col("old.caseNum").eqNullSafe(F.col("new.caseNum")), "left_anti")
    cols = [*FACT_COLUMNS, *PARTITION_COLUMNS]
    return survivors.select(*cols).unionByName(batch.select(*cols))
