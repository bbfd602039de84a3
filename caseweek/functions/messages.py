"""Message text from a ``{name}`` template and row values (Column)."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_SLOT = re.compile(r"\{(\w+)\}")


def render(template: str, **values: Column) -> Column:
    """Concatenate the template's literal text with the named columns."""
    parts: list[Column] = []
    pos = 0
    for m in _SLOT.finditer(template):
        if m.start() > pos:
            parts.append(F.lit(template[pos:m.start()]))
        parts.append(values[m.group(1)].cast("string"))
        pos = m.end()
    if pos < len(template):
        parts.append(F.lit(template[pos:]))
    return F.concat(*parts) if len(parts) > 1 else parts[0]
