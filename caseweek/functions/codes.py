"""Severity, status, account and environment codes (Column -> Column)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..specs import ACCOUNT_MISS_ID, CLOSED_STATUS, SEVERITY_CODES, SEVERITY_OTHER


def severity_code(text: Column) -> Column:
    """Exact, case-sensitive severity text -> 1..4; anything else or null -> -1."""
    out = None
    for label, code in SEVERITY_CODES:
        cond = text == F.lit(label)
        out = F.when(cond, F.lit(code)) if out is None else out.when(cond, F.lit(code))
    return out.otherwise(F.lit(SEVERITY_OTHER)).cast("int")


def status_code(text: Column) -> Column:
    """"Closed" in any letter case -> 0, anything else (null too) -> 1."""
    return F.when(F.lower(text) == F.lit(CLOSED_STATUS), F.lit(0)).otherwise(F.lit(1)).cast("int")


def trailing_int(text: Column) -> Column:
    """Integer after the last ``-`` (the whole text if none); null if blank or not an int.

    Only digits with an optional sign count; a cast alone would also take blanks around them.
    """
    tail = F.substring_index(text, "-", -1)
    return F.when(tail.rlike(r"^[+-]?[0-9]+\z"), tail.try_cast("int"))


def account_id(text: Column) -> Column:
    """Account id from the customer record id; blank, null or malformed -> -1."""
    return F.coalesce(trailing_int(text), F.lit(ACCOUNT_MISS_ID)).cast("int")


def environment_id(text: Column) -> Column:
    """Environment id after the last ``-``; blank, null or malformed -> null."""
    return trailing_int(text)
