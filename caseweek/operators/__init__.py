"""Operators: DataFrame -> DataFrame building blocks of the weekly jobs."""

from .audits import batch_profile, duplicate_keys, orphan_rows
from .coding import code_cases, explode_findings, rule_finding
from .dimensions import (account_changes, account_merge, batch_accounts, batch_members, changed_accounts, dense_ids,
                         from_long, max_ids, merge_surrogates, new_members, range_ids, to_long, upsert_accounts)
from .findings import findings_case_count, findings_report
from .lookup import lookup_ids, to_facts
from .upsert import last_drops, merge_partitions, touched_partitions

__all__ = [
    "batch_profile", "duplicate_keys", "orphan_rows", "code_cases", "explode_findings",
    "rule_finding", "account_changes", "account_merge", "batch_accounts", "batch_members",
    "changed_accounts", "dense_ids", "from_long", "max_ids", "merge_surrogates", "new_members", "range_ids", "to_long",
    "upsert_accounts",
    "findings_case_count", "findings_report", "lookup_ids", "to_facts",
    "last_drops", "merge_partitions", "touched_partitions",
]
