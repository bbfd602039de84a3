"""Weekly partition keys: the Friday of a Sunday-first week, and its week-year."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..specs import WEEK_LABEL_FORMAT


def week_friday(day: Column) -> Column:
    """Friday of the Sunday..Saturday week holding ``day`` (a date)."""
    return F.date_add(day, F.lit(6) - F.dayofweek(day))


def week_year(friday: Column) -> Column:
    """Week-year: the year of the Saturday closing the week, i.e. the year whose
    first week (the one holding 1 January) contains this Friday's week."""
    return F.year(F.date_add(friday, 1)).cast("int")


def week_label(friday: Column) -> Column:
    return F.date_format(friday, WEEK_LABEL_FORMAT)


def partition_day(opened: Column, as_of: _dt.date) -> Column:
    """Open date, or ``as_of`` when the open time is missing (fact keeps the null)."""
    return F.coalesce(F.to_date(opened), F.lit(as_of))


def week_partition_columns(opened: Column, as_of: _dt.date) -> dict[str, Column]:
    fri = week_friday(partition_day(opened, as_of))
    return {"year": week_year(fri), "week": week_label(fri)}


def run_stamp(day: Column) -> Column:
    """Run date as ``yyyyMMdd`` (the processed-file ledger stamp)."""
    return F.date_format(day, "yyyyMMdd")
