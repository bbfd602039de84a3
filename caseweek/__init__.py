"""caseweek: weekly support-case extracts into a week-partitioned star schema, on Spark.

The jobs: ``load_batch`` (append, or overwrite the touched weeks),
``update_batch`` (upsert by case number inside each touched week),
``bootstrap_dimensions`` (staging text into dimensions), ``register_tables``
(catalog tables over the warehouse folders) and ``streaming.process_once``.
Building blocks live in ``functions`` (Column rules), ``operators``
(DataFrame steps), ``sources`` and ``sinks``.
"""

from .plans import (Warehouse, bootstrap_dimensions, load_batch, load_frame, register_tables,
                    update_batch)

__version__ = "0.1.0"

__all__ = ["Warehouse", "bootstrap_dimensions", "load_batch", "load_frame", "register_tables",
           "update_batch", "__version__"]
