"""Key audits and batch profiles (the unenforced table constraints as checks)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F



def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values held by more than one row, with their row count ``n``.

    A map-side partial count runs before the shuffle, so even a key holding
    a third of the table costs one row per map task.
    """
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > F.lit(1)))


def orphan_rows(child: DataFrame, parent: DataFrame, child_key: str,
                parent_key: str) -> DataFrame:
    """Child rows whose key has no parent row (a foreign-key audit)."""
    keys = parent.select(F.col(parent_key).alias("_pk")).distinct()
    return child.join(keys, child[child_key] == keys["_pk"], "left_anti")


def batch_profile(members: DataFrame, batch_accounts: DataFrame, dims_long: DataFrame,
                  accounts: DataFrame) -> DataFrame:
    """Member counts per dimension, for the batch and for the stored tables.

    ``members`` is ``batch_members(extract)`` (null counts as a member),
    ``batch_accounts`` one row per account id of the batch. Output rows:
    ``(kind in {batch, table}, dimension, n)`` - one union and one grouped
    count, no driver round trips.
    """
    rows = (members.select(F.lit("batch").alias("kind"), "dimension")
            .unionByName(batch_accounts.select(F.lit("batch").alias("kind"),
                                               F.lit("account").alias("dimension")))
            .unionByName(dims_long.select(F.lit("table").alias("kind"), "dimension"))
            .unionByName(accounts.select(F.lit("table").alias("kind"),
                                         F.lit("account").alias("dimension"))))
    return rows.groupBy("kind", "dimension").agg(F.count(F.lit(1)).alias("n"))
