"""Scans of the warehouse tables: facts (whole, one partition, a partition set),
dimensions and the delimited staging files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..schemas import ACCOUNT_DIM_SCHEMA, FACT_SCHEMA, STAGING_SCHEMA
from ..session import within_bounds
from ..versions import Folder, Version, VersionedTable


#: Partition folders of a week inside a folder of facts.
WEEK_FOLDERS = "year=*/week=*"
#: Partition column of the folder that rows were written into; names of later ones sort after earlier ones.
LOAD = "load"


def _by_path(spark: SparkSession, table: VersionedTable, folders: list[Folder], schema: StructType,
             fmt: str) -> DataFrame:
    """Rows of some of a table's folders, with the columns of ``schema`` and ``LOAD``."""
    out = None
    loaded = [table.location(f) for f in folders if f.path.startswith(f"{LOAD}=")]
    others = [table.location(f) for f in folders if not f.path.startswith(f"{LOAD}=")]
    for paths in (others, loaded):
        if paths:
            reader = spark.read.schema(schema).format(fmt).option("basePath", table.root)
            rows = reader.load(paths)
            own = F.col(LOAD).cast("string") if paths is loaded else F.lit("")
            rows = rows.select(*[f.name for f in schema.fields], own.alias(LOAD))
            out = rows if out is None else out.unionByName(rows)
    if out is None:
        out = spark.createDataFrame([], StructType([*schema.fields, StructField(LOAD, StringType())]))
    return out


def fact_versions(spark: SparkSession, path: str) -> VersionedTable:
    """The versions of a fact table."""
    return VersionedTable(spark, path, plain=WEEK_FOLDERS)


def read_facts(spark: SparkSession, path: str, fmt: str = "orc", version: Version | None = None,
               weeks: set[tuple[str, str]] | None = None) -> DataFrame:
    """The partitioned fact table as of a version (the newest unless given); ``week`` stays a string.

    Only the folders that the version lists are looked at, and with ``weeks`` (year and label as texts) only
    those of these weeks.
    """
    table = fact_versions(spark, path)
    folders = (version or table.current()).folders
    if weeks is not None:
        folders = [f for f in folders if f.part in weeks]
    return _by_path(spark, table, list(folders), FACT_SCHEMA, fmt).drop(LOAD)


def read_partition(spark: SparkSession, path: str, year: int, week: str,
                   fmt: str = "orc") -> DataFrame:
    """One ``(year, week)`` partition; no other folder is listed."""
    facts = read_facts(spark, path, fmt, weeks={(str(year), week)})
    return facts.where((F.col("year") == F.lit(year)) & (F.col("week") == F.lit(week)))


# Largest touched-partition list turned into a static folder filter; a batch
# spanning more weeks than this keeps a filter on its years and a semi join.
MAX_PARTITION_LIST = 20_000


def listed_weeks(partitions: DataFrame, max_list: int = MAX_PARTITION_LIST) -> set[tuple[str, str]] | None:
    """The distinct (year, week) of a batch as texts, or None beyond ``max_list``. They are bounded by the
    calendar, not by the batch's row count."""
    listed = partitions.select("year", "week").distinct().limit(max_list + 1).collect()
    return None if len(listed) > max_list else {(str(r["year"]), r["week"]) for r in listed}


def _in_weeks(weeks: set[tuple[str, str]]) -> Column:
    """``(year = y AND week IN (...)) OR ...``, a form that a file index and a catalog can both answer."""
    by_year: dict[str, list[str]] = {}
    for year, week in sorted(weeks):
        by_year.setdefault(year, []).append(week)
    touched = F.lit(False)
    for year, own in by_year.items():
        touched = touched | ((F.col("year") == int(year)) & F.col("week").isin(own))
    return touched


def read_partitions(spark: SparkSession, path: str, partitions: DataFrame, fmt: str = "orc",
                    max_list: int = MAX_PARTITION_LIST, version: Version | None = None) -> DataFrame:
    """Fact rows (path-based table) of the partitions in ``partitions(year, week)``: only the folders of those
    weeks are listed and read. Over the bound, those of the batch's years, and a semi join keeps the weeks."""
    weeks = listed_weeks(partitions, max_list)
    if weeks is None:
        return scope_partitions(read_facts(spark, path, fmt, version), partitions, max_list)
    return read_facts(spark, path, fmt, version, weeks).where(_in_weeks(weeks))


def scope_partitions(facts: DataFrame, partitions: DataFrame,
                     max_list: int = MAX_PARTITION_LIST) -> DataFrame:
    """Rows of ``facts`` (a path-based read or a catalog table) in the partitions listed in
    ``partitions(year, week)``.

    The listed weeks become a static filter on the partition columns. Over the bound the filter is on the
    batch's years (at most as many as the calendar has), and a semi join keeps the listed weeks.
    """
    weeks = listed_weeks(partitions, max_list)
    if weeks is None:
        keys = partitions.select("year", "week").distinct()
        years = [r["year"] for r in keys.select("year").distinct().collect()]
        return facts.where(F.col("year").isin(years)).join(keys, ["year", "week"], "left_semi").select(*facts.columns)
    return facts.where(_in_weeks(weeks))


def read_dimension(spark: SparkSession, path: str, schema: StructType, fmt: str = "orc",
                   version: Version | None = None) -> DataFrame:
    """A dimension table as of a version (the newest unless given); an absent one reads as empty."""
    table = VersionedTable(spark, path)
    folders = [table.location(f) for f in (version or table.current()).folders]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).format(fmt).load(folders).select(*[f.name for f in schema.fields])


def read_accounts(spark: SparkSession, path: str, fmt: str = "orc", version: Version | None = None) -> DataFrame:
    """The account dimension ``(id, name)``: its base, with the names that later changes gave.

    Changes are small files of the accounts that a load added or renamed; of an account that several changed,
    the last counts. Their rows and bytes stand in the version, so whether they may be broadcast to the base
    takes no job.
    """
    table = VersionedTable(spark, path)
    folders = (version or table.current()).folders
    base = [f for f in folders if f.part[0] == "base"]
    changes = [f for f in folders if f.part[0] == "change"]
    rows = _by_path(spark, table, base, ACCOUNT_DIM_SCHEMA, fmt).select("id", "name")
    if not changes:
        return rows
    changed = _by_path(spark, table, changes, ACCOUNT_DIM_SCHEMA, fmt)
    latest = changed.groupBy("id").agg(F.max(F.struct(LOAD, "name")).alias("l")).select("id", F.col("l.name").alias("name"))
    ids = changed.select("id").distinct()
    if within_bounds(sum(f.part[1] for f in changes), sum(f.part[2] for f in changes)):
        ids = F.broadcast(ids)
    return rows.join(ids, "id", "left_anti").unionByName(latest)


def read_staging(spark: SparkSession, path: str, sep: str) -> DataFrame:
    """Delimited staging text ``(name, ID)`` with one header line."""
    return (spark.read.schema(STAGING_SCHEMA).option("header", True)
            .option("sep", sep).csv(path))
