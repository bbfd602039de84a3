"""Job plans: the weekly load and update flows."""

from .jobs import (DimensionUpdate, Warehouse, bootstrap_dimensions, compact_accounts, compact_dimensions, fact_rows,
                   grow_accounts, grow_surrogates, load_batch, load_frame, maintain_dimensions, read_accounts,
                   read_surrogates, register_tables, remove_unused, update_batch)

__all__ = ["DimensionUpdate", "Warehouse", "bootstrap_dimensions", "compact_accounts", "compact_dimensions", "fact_rows",
           "grow_accounts", "grow_surrogates", "load_batch", "load_frame", "maintain_dimensions", "read_accounts",
           "read_surrogates", "register_tables", "remove_unused", "update_batch"]
