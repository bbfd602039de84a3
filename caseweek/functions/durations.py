"""Resolution time text -> minutes (Column -> int Column)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..specs import DURATION_UNITS


def resolution_minutes(text: Column) -> Column:
    """``"<d> days <h> hours<m> mn"`` -> 1440*d + 60*h + m.

    Each number is the trimmed text between the first occurrences of the unit
    words; a missing or out-of-order unit, a non-integer part or an int
    overflow gives null.
    """
    (w1, f1), (w2, f2), (w3, f3) = DURATION_UNITS
    p1, p2, p3 = F.instr(text, w1), F.instr(text, w2), F.instr(text, w3)
    s1, s2 = p1 + F.lit(len(w1)), p2 + F.lit(len(w2))
    n1 = F.substring(text, F.lit(1), p1 - F.lit(1)).try_cast("long")
    n2 = F.substring(text, s1, p2 - s1).try_cast("long")
    n3 = F.substring(text, s2, p3 - s2).try_cast("long")
    ordered = (p1 > 0) & (p2 >= s1) & (p3 >= s2)
    total = n1 * F.lit(f1) + n2 * F.lit(f2) + n3 * F.lit(f3)
    return F.when(ordered, total.try_cast("int"))
