"""Sinks: fact, dimension, staging, findings and side-table writers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import (AUTOMATION_SCHEMA, FACT_COLUMNS, PARTITION_COLUMNS,
                       SMARTSENSE_SCHEMA)
from ..session import fits_broadcast
from ..sources.tables import WEEK_FOLDERS, fact_versions
from ..versions import ATTEMPTS, Conflict, Folder, Version, VersionedTable


def write_facts(facts: DataFrame, path: str, mode: str = "append", fmt: str = "orc",
                based_on: Version | None = None) -> Version:
    """Append, or overwrite only the ``(year, week)`` partitions present in ``facts``, all weeks at once.

    The weeks are written into a folder of their own beside the old ones; publishing the table's next version
    then puts them in place, so readers see all of them or none, and a failure before leaves the old rows.
    A REBALANCE on the partition columns groups each week into few files while AQE splits an oversized week
    over several tasks instead of one.

    Where another writer publishes first, this one follows it. ``based_on`` is the version that ``facts`` was
    made from (an upsert); if one of its weeks has changed since, nothing is put in place (``Conflict``).
    """
    if mode not in ("append", "overwrite"):
        raise ValueError(f"unknown fact write mode {mode!r}")
    table = fact_versions(facts.sparkSession, path)
    now = table.current()
    folder = table.new_folder(now)
    out = facts.select(*FACT_COLUMNS, *PARTITION_COLUMNS).hint("rebalance", *PARTITION_COLUMNS)
    out.write.format(fmt).partitionBy(*PARTITION_COLUMNS).save(f"{path}/{folder}")
    new = table.folders_below(folder, WEEK_FOLDERS)
    weeks = {f.part for f in new}
    for _ in range(ATTEMPTS):
        if based_on is not None and now.among(weeks) != based_on.among(weeks):
            table.drop_folder(folder)
            raise Conflict(f"weeks of {path} have changed since version {based_on.number}")
        kept = [f for f in now.folders if mode == "append" or f.part not in weeks]
        try:
            return table.publish(now, [*kept, *new])
        except Conflict:
            now = table.current()
    raise Conflict(f"{path} kept changing")


def replace_table(df: DataFrame, path: str, fmt: str = "orc") -> Version:
    """Replace the contents of a whole (unpartitioned) table, e.g. a dimension; ``df`` may read the table itself.

    The new rows are written beside the old ones, and the next version lists only them.
    """
    table = VersionedTable(df.sparkSession, path)
    for _ in range(ATTEMPTS):
        now = table.current()
        folder = table.new_folder(now)
        df.write.format(fmt).save(f"{path}/{folder}")
        try:
            return table.publish(now, [Folder(folder, ("base",))])
        except Conflict:
            table.drop_folder(folder)
    raise Conflict(f"{path} kept changing")


def write_staging(df: DataFrame, path: str, sep: str) -> None:
    """Delimited staging text ``(name, ID)`` with a header line."""
    (df.select(F.col("name").cast("string"), F.col("ID").cast("string"))
     .write.mode("overwrite").option("header", True).option("sep", sep)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(path))


def write_batch(rows: DataFrame, path: str, fmt: str = "orc") -> None:
    """Rows of one load, partitioned by its ``batch`` label; a rerun under the
    same label replaces its partition instead of adding rows twice."""
    (rows.write.format(fmt).partitionBy("batch").mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").save(path))


def write_findings(findings: DataFrame, path: str, fmt: str = "orc") -> None:
    """Findings of one batch (see ``write_batch``)."""
    write_batch(findings, path, fmt)


def _conform(df: DataFrame, schema) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


#: Rows of a bucket that one task sorts and writes, about.
ROWS_PER_FILE = 1_000_000


def deal_buckets(df: DataFrame, buckets: int, key: str, partition: list[str], rows_per_file: int) -> DataFrame:
    """``df`` dealt out so that a task has rows of one bucket only, and a bucket has as many tasks as its rows
    ask for.

    A count by partition and bucket (a few rows) says over how many tasks a bucket is spread; a row's place
    among them comes from a hash of the row. Equal rows fall together; what is still too large for a task,
    such as one row repeated over and over, is split by the rebalancing, and small buckets share a task.
    """
    bucket = F.pmod(F.hash(key), F.lit(buckets))            # the bucket that the writer puts a row in
    rows = df.withColumn("_bucket", bucket)
    ways = rows.groupBy(*partition, "_bucket").agg(
        F.ceil(F.count(F.lit(1)) / F.lit(rows_per_file)).alias("_ways"))
    own = [F.col(c).alias(f"_of_{c}") for c in partition]
    ways = ways.select(*own, F.col("_bucket").alias("_of_bucket"), "_ways")
    same = F.col("_bucket") == F.col("_of_bucket")
    for c in partition:
        same = same & F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    if fits_broadcast(ways):
        ways = F.broadcast(ways)
    salted = rows.join(ways, same, "left").withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.col("_ways")))
    return salted.hint("rebalance", *partition, "_bucket", "_salt").select(*df.columns)


def write_bucketed(df: DataFrame, table: str, path: str, buckets: int, key: str, partition: tuple[str, ...] = (),
                   fmt: str = "orc", rows_per_file: int = ROWS_PER_FILE) -> None:
    """Catalog table ``table`` at ``path``, bucketed and sorted by ``key``; a bucket is one or more sorted
    files, written by as many tasks."""
    writer = deal_buckets(df, buckets, key, list(partition), rows_per_file).write.mode("overwrite").format(fmt)
    if partition:
        writer = writer.partitionBy(*partition)
    writer.bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(table)


def write_automation(df: DataFrame, table: str, path: str, fmt: str = "orc",
                     rows_per_file: int = ROWS_PER_FILE) -> None:
    """Automation side table: 3 buckets on CaseNum."""
    write_bucketed(_conform(df, AUTOMATION_SCHEMA), table, path, 3, "CaseNum", (), fmt, rows_per_file)


def write_smartsense(df: DataFrame, table: str, path: str, fmt: str = "orc",
                     rows_per_file: int = ROWS_PER_FILE) -> None:
    """SmartSense side table: partitioned by Priority, 2 buckets on CaseNum; a priority that holds most rows is
    written by many tasks."""
    write_bucketed(_conform(df, SMARTSENSE_SCHEMA), table, path, 2, "CaseNum", ("Priority",), fmt, rows_per_file)


__all__ = ["write_facts", "replace_table", "write_staging", "write_findings", "write_batch", "deal_buckets",
           "write_bucketed", "write_automation", "write_smartsense"]
