"""Sources: the weekly extract scan and the warehouse table scans."""

from .extract import (DROP, DROP_NUMBER, drop_column, extract_fields, extract_reader, number_drops, read_extract,
                      refused_findings, refused_rows, scan_options, split_refused, with_raw_line, write_extract)
from .tables import (fact_versions, read_accounts, read_dimension, read_facts, read_partition, read_partitions,
                     read_staging, scope_partitions)

__all__ = [
    "DROP", "DROP_NUMBER", "drop_column", "extract_fields", "extract_reader", "number_drops", "read_extract",
    "refused_findings", "refused_rows", "scan_options", "split_refused", "with_raw_line", "write_extract", "fact_versions", "read_accounts", "read_dimension",
    "read_facts", "read_partition", "read_partitions", "read_staging", "scope_partitions",
]
