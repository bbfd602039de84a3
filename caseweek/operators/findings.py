"""Findings report: the set of messages per case, and the case count."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REPORT_SEPARATOR = " | "


def findings_report(findings: DataFrame) -> DataFrame:
    """One row per case: distinct messages (sorted) and their number.

    ``collect_set`` merges partial sets map-side, so a case repeated across
    the batch ships its distinct messages only once per map task.
    """
    return (findings.groupBy("case_num")
            .agg(F.array_sort(F.collect_set("message")).alias("_m"))
            .select("case_num", F.size("_m").alias("n_messages"),
                    F.array_join("_m", REPORT_SEPARATOR).alias("messages")))


def findings_case_count(findings: DataFrame) -> DataFrame:
    """Number of cases with at least one finding, and of findings rows."""
    return findings.agg(F.count_distinct("case_num").alias("cases"),
                        F.count(F.lit(1)).alias("findings"))
