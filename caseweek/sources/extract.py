"""Weekly extract scan: delimited text, fixed positional schema, header skipped."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pyspark.sql.types import StringType, StructField, StructType

from ..schemas import EXTRACT_FIELDS, EXTRACT_LAYOUT, EXTRACT_SCHEMA
from ..session import fits_broadcast, spread
from ..specs import MISFIT_RULE

# Column of a scan that keeps the raw line of a row that doesn't fit the layout: too few or too many
# fields, or a case number that is no number.
RAW_LINE = "rawLine"
# Column with the time and name of the file that a row came from. Where an extract has it, each file is a
# drop of its own and later ones come after earlier ones.
DROP = "_drop"
# Column with the place of a row's drop among the extract's drops, 1 for the first.
DROP_NUMBER = "_drop_number"

# Why a line is refused.
MISFIT, NO_KEY = "fields", "case number"
SCAN_SCHEMA = StructType([*EXTRACT_SCHEMA.fields, StructField(RAW_LINE, StringType(), True)])

_FIELD_OF = {field: header for header, _, field in EXTRACT_LAYOUT}


def extract_fields(raw: DataFrame) -> DataFrame:
    """Rename the positional header columns to extract fields, in field order."""
    return raw.select(*[F.col(f"`{_FIELD_OF[f]}`").alias(f) for f in EXTRACT_FIELDS])


def extract_reader(spark: SparkSession, sep: str = ",", check_header: bool = False):
    """Reader options shared by the batch scan and the file-stream source."""
    return scan_options(spark.read, sep, check_header)


def scan_options(reader, sep: str = ",", check_header: bool = False):
    """The extract layout on a batch or stream reader; misfit lines are kept in ``rawLine``."""
    # lines are always parsed whole, so that their fields are counted whatever columns a query reads
    reader = (reader.schema(SCAN_SCHEMA).option("header", True).option("sep", sep).option("columnPruning", False)
              .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", RAW_LINE))
    return reader.option("enforceSchema", False) if check_header else reader


def drop_column(by: str = "file") -> Column:
    """The drop that a row of a scan came from: its file, ordered by time, then name; or the folder of its file,
    ordered by name (a drop that a cluster wrote as many part files)."""
    path, time = F.col("_metadata.file_path"), F.col("_metadata.file_modification_time")
    if by == "folder":
        path, time = F.regexp_extract(path, "^(.*)/", 1), F.lit("1970-01-01").cast("timestamp")
    elif by != "file":
        raise ValueError(f"drops are files or folders, not {by!r}")
    return F.struct(time.alias("time"), path.alias("file")).alias(DROP)


def number_drops(extract: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(the extract with ``DROP_NUMBER``, the kept list of its drops, which the caller releases).

    Numbers stand for drops wherever the first or the last one is looked for: Spark aggregates a number in a
    hash table that has one entry a key, while for time and name it would sort all rows, each with its file's
    path. The list has a row for each file.
    """
    own = F.col(DROP).alias("_of_drop")
    listed = extract.select(own).where("_of_drop IS NOT NULL").distinct().select(
        "_of_drop", F.row_number().over(Window.orderBy("_of_drop")).alias(DROP_NUMBER)).persist(StorageLevel.MEMORY_AND_DISK)
    numbers = F.broadcast(listed) if fits_broadcast(listed.select("_of_drop.*")) else listed
    return extract.join(numbers, F.col(DROP) == F.col("_of_drop"), "left").select(*extract.columns, DROP_NUMBER), listed


def with_raw_line(raw: DataFrame) -> DataFrame:
    """Extract fields plus ``rawLine`` (and the drop, where the scan has it)."""
    own = [c for c in (RAW_LINE, DROP) if c in raw.columns]
    return raw.select(*[F.col(f"`{_FIELD_OF[f]}`").alias(f) for f in EXTRACT_FIELDS], *own)


def refused_rows(extract: DataFrame) -> Column:
    """Whether a row of an extract is refused."""
    keyless = F.col("caseNum").isNull()
    return keyless | F.col(RAW_LINE).isNotNull() if RAW_LINE in extract.columns else keyless


def split_refused(extract: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(cases, refused): a line with too few or too many fields may hold its values in the wrong columns, and a
    row without a readable case number has no key; both are refused.

    Refused rows are ``(line, reason, case_num)``: the raw line as it was read, or the fields as JSON where the
    line fits the layout or the extract isn't a scan; why; and the case number if one was read. Both results
    keep the drop, where the extract has it.
    """
    fields = F.to_json(F.struct(*EXTRACT_FIELDS))
    line, refused = fields, refused_rows(extract)
    if RAW_LINE in extract.columns:
        line = F.coalesce(F.col(RAW_LINE), fields)
    own = [c for c in (DROP, DROP_NUMBER) if c in extract.columns]
    return extract.where(~refused).select(*EXTRACT_FIELDS, *own), extract.where(refused).select(
        line.alias("line"), F.when(F.col("caseNum").isNull(), NO_KEY).otherwise(MISFIT).alias("reason"),
        F.col("caseNum").alias("case_num"), *own)


def refused_findings(refused: DataFrame) -> DataFrame:
    """A finding ``(case_num, code, message)`` for each line that doesn't fit the layout."""
    own = [c for c in (DROP,) if c in refused.columns]
    return refused.where(F.col("reason") == MISFIT).select(
        "case_num", F.lit(MISFIT_RULE.code).alias("code"), F.lit(MISFIT_RULE.message).alias("message"), *own)


def read_extract(spark: SparkSession, path: str, sep: str = ",",
                 check_header: bool = False, raw_line: bool = False, drops: bool = False) -> DataFrame:
    """Scan one or more extract files; columns bind by position. ``raw_line`` keeps that column too, ``drops``
    the file that each row came from.

    ``check_header=True`` makes Spark compare the header line with the
    layout's names (for the columns a query reads) instead of only skipping
    it; a mismatch fails the scan.
    """
    raw = extract_reader(spark, sep, check_header).csv(path)
    raw = spread(raw.select("*", drop_column()) if drops else raw)
    return with_raw_line(raw) if raw_line or drops else extract_fields(raw)


def write_extract(raw: DataFrame, path: str, sep: str = ",") -> None:
    """Write header-named extract rows as delimited text with a header line."""
    (raw.select(*[F.col(f"`{h}`") for h, _, _ in EXTRACT_LAYOUT])
     .write.mode("overwrite").option("header", True).option("sep", sep)
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .csv(path))
