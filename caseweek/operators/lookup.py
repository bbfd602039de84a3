"""Fact rows from coded rows: surrogate-id lookups with a -1 default."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import FACT_COLUMNS, PARTITION_COLUMNS
from ..session import fits_broadcast
from ..specs import LOOKUP_MISS_ID, SURROGATE_DIMENSIONS, DimensionSpec
from .coding import key_column


def _member_key(dimension: Column, member: Column) -> Column:
    """One text for a dimension's member; null is a member of its own."""
    return F.concat(dimension, F.coalesce(F.concat(F.lit("="), member), F.lit("")))


def lookup_ids(coded: DataFrame, dims_long: DataFrame,
               specs: list[DimensionSpec] = SURROGATE_DIMENSIONS,
               broadcast_check: bool = True) -> DataFrame:
    """Replace each natural key with its dimension id; absent keys get -1.

    All dimensions are one table of members and ids, joined once for each key
    column, so that one broadcast serves all of them. It is broadcast only
    after its rows and bytes have been counted; a larger one is left to
    shuffle joins (AQE splits skewed keys).
    """
    # one id per member, the smallest: a member stored twice must not multiply fact rows
    members = dims_long.groupBy(_member_key(F.col("dimension"), F.col("member")).alias("_member")).agg(F.min("id").alias("_id"))
    if broadcast_check and fits_broadcast(dims_long):
        members = F.broadcast(members)
    out = coded
    for spec in specs:
        ids = members.select(F.col("_member").alias(f"_m_{spec.name}"), F.col("_id").alias(f"_id_{spec.name}"))
        key = _member_key(F.lit(spec.name), F.col(key_column(spec)))
        out = out.join(ids, key == F.col(f"_m_{spec.name}"), "left").drop(f"_m_{spec.name}", key_column(spec))
    found = [F.coalesce(F.col(f"_id_{spec.name}"), F.lit(LOOKUP_MISS_ID)).cast("int").alias(spec.fact_column) for spec in specs]
    return out.select(*[c for c in out.columns if not c.startswith("_id_")], *found)


def to_facts(looked_up: DataFrame) -> DataFrame:
    """Fact columns in table order plus the partition columns."""
    return looked_up.select(*FACT_COLUMNS, *PARTITION_COLUMNS)
