"""Scalar column functions: each takes and returns ``Column`` expressions."""

from .codes import account_id, environment_id, severity_code, status_code, trailing_int
from .durations import resolution_minutes
from .links import link_digits, link_parts, link_tail, link_tail_backtrack
from .messages import render
from .timestamps import (parse_case_timestamp, timestamp_from_parts, timestamp_parts,
                         with_case_timestamps)
from .weeks import (partition_day, run_stamp, week_friday, week_label,
                    week_partition_columns, week_year)

__all__ = [
    "account_id", "environment_id", "severity_code", "status_code", "trailing_int",
    "resolution_minutes", "link_digits", "link_parts", "link_tail", "link_tail_backtrack", "render",
    "parse_case_timestamp", "timestamp_from_parts", "timestamp_parts", "with_case_timestamps", "partition_day", "run_stamp", "week_friday", "week_label",
    "week_partition_columns", "week_year",
]
