"""Row coding: one projection turns extract rows into typed, coded case rows
plus their record-quality findings (no UDF, one pass, no shuffle)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import (account_id, environment_id, link_digits, link_parts, link_tail, with_case_timestamps,
                         render, resolution_minutes, severity_code, status_code,
                         week_partition_columns)
from ..specs import LINKS, RULES, SURROGATE_DIMENSIONS, DimensionSpec, RuleSpec


def natural_key(spec: DimensionSpec) -> Column:
    c = F.col(spec.column)
    return F.coalesce(c, F.lit(spec.null_member)) if spec.null_member is not None else c


def tail_column(link: str) -> str:
    return f"_tail_{link}"


def digits_column(link: str) -> str:
    return f"_digits_{link}"


def key_column(spec: DimensionSpec) -> str:
    return f"_nk_{spec.name}"


def rule_finding(rootcause: Column, severity: Column, status: Column,
                 present: dict[str, Column], rules: list[RuleSpec] = RULES) -> Column:
    """First matching record-quality rule as struct(code, message), else null."""
    rc = F.lower(rootcause)
    closed = status == F.lit(0)
    hits = []
    for rule in rules:
        cond = closed & rc.isin(*[r.lower() for r in rule.root_causes])
        if rule.severity is not None:
            cond = cond & (severity == F.lit(rule.severity))
        for name in rule.missing:
            cond = cond & ~present[name]
        hits.append(F.when(cond, F.struct(F.lit(rule.code).alias("code"),
                                          render(rule.message, rootcause=rootcause).alias("message"))))
    return F.coalesce(*hits)


def code_cases(extract: DataFrame, as_of: _dt.date, keep: tuple[str, ...] = ()) -> DataFrame:
    """Extract rows -> coded rows, which keep the columns ``keep`` too.

    Output: the fact measures (severity ... ResolutionTime, without dimension
    ids), one natural-key column per surrogate dimension, the partition
    columns ``year``/``week`` and ``findings`` (array<struct<code, message>>,
    null where a finding doesn't apply).
    """
    # Stages 1-3: the costly texts (link tails, their digits, timestamp digit
    # groups) once per row; the optimizer keeps these projections apart because
    # their outputs are used several times.
    tails = extract.select("*", *[link_tail(F.col(s.column)).alias(tail_column(s.column)) for s in LINKS])
    numbers = tails.select("*", *[link_digits(F.col(tail_column(s.column)), s).alias(digits_column(s.column))
                                  for s in LINKS])
    staged = with_case_timestamps(numbers, {"_opened": "dateOpen", "_closed": "dateClose"}, as_of)
    severity = severity_code(F.col("severity"))
    status = status_code(F.col("status"))
    opened = F.col("_opened")
    links = {s.column: link_parts(F.col(s.column), s, F.col("component"), F.col(tail_column(s.column)),
                                  F.col(digits_column(s.column))) for s in LINKS}
    rule = rule_finding(F.col("rootcause"), severity, status,
                        {k: v["present"] for k, v in links.items()})
    findings = F.concat(F.array(rule), *[links[s.column]["entries"] for s in LINKS])
    part = week_partition_columns(opened, as_of)
    return staged.select(
        severity.alias("severity"),
        F.col("caseNum"),
        status.alias("status"),
        opened.alias("dateOpen"),
        F.col("_closed").alias("dateClose"),
        account_id(F.col("accountID")).alias("accountID"),
        *[links[s.column]["id"].alias(s.column) for s in LINKS],
        environment_id(F.col("Env")).alias("Env"),
        resolution_minutes(F.col("ResolutionTime")).alias("ResolutionTime"),
        *[natural_key(s).alias(key_column(s)) for s in SURROGATE_DIMENSIONS],
        part["year"].alias("year"),
        part["week"].alias("week"),
        findings.alias("findings"),
        *keep,
    )


def explode_findings(coded: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Findings rows ``(case_num, code, message)`` and the columns ``keep``; rows without findings vanish."""
    return (coded.select(F.col("caseNum").alias("case_num"), *keep,
                         F.explode("findings").alias("f"))
            .where(F.col("f").isNotNull())
            .select("case_num", F.col("f.code").alias("code"), F.col("f.message").alias("message"), *keep))
