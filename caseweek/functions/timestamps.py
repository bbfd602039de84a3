"""Multi-layout extract timestamps (Column -> timestamp_ntz Column).

Two layouts are tried in order, ``yyyyMMdd HHmmss`` then ``MM/dd/yy HH:mm``.
Each is a *prefix* match with the old lenient date parser's reading rules:
a field followed directly by another number field (yyyy, MM, HH, mm of the
compact layout) takes exactly its pattern width in digits - a blank before
it would eat into that width, which never yields a valid date - while any
other field skips leading blanks/tabs and takes all digits; trailing text
(``.000``, ``:00 AM``) is ignored. A two-digit year is placed in
the 100-year window that starts 80 years before ``as_of``; any other year is
taken literally. Out-of-range fields give null instead of rolling over.

For wide projections use the two-step form: ``timestamp_parts`` (one
projection holding the digit groups as columns) then
``timestamp_from_parts`` (cheap assembly), so every regex runs once per row.
``parse_case_timestamp`` is the one-expression form of the same rule.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..specs import TWO_DIGIT_YEAR_WINDOW_BACK

_WS = r"[ \t]*"
# yyyy MM (fixed widths, next field numeric) dd (free) ' ' HH mm (fixed) ss (free)
COMPACT_RE = rf"^(\d{{4}})(\d{{2}}){_WS}(\d+) (\d{{2}})(\d{{2}}){_WS}(\d+)"
# MM / dd / yy ' ' HH : mm, every field free width
SLASHED_RE = rf"^{_WS}(\d+)/{_WS}(\d+)/{_WS}(\d+) {_WS}(\d+):{_WS}(\d+)"

_LAYOUTS = {"c": (COMPACT_RE, 6), "s": (SLASHED_RE, 5)}


def window_start(as_of: _dt.date) -> _dt.date:
    try:
        return as_of.replace(year=as_of.year - TWO_DIGIT_YEAR_WINDOW_BACK)
    except ValueError:          # 29 February -> 28 February
        return as_of.replace(year=as_of.year - TWO_DIGIT_YEAR_WINDOW_BACK, day=28)


def century_window(as_of: _dt.date) -> tuple[int, int]:
    """(century base, start key yyyymmddHHMMSS) of the two-digit-year window."""
    start = window_start(as_of)
    return (start.year // 100) * 100, int(start.strftime("%Y%m%d")) * 1_000_000


def _groups(text: Column, layout: str) -> Column:
    """All digit groups of one layout as array<string>, null when it does not match.

    One guard and one rewrite per layout instead of one regex run per group:
    the matched prefix (and the rest of the text) is replaced by the groups
    joined with commas, then split on the comma.
    """
    pattern, n = _LAYOUTS[layout]
    joined = ",".join(f"${i}" for i in range(1, n + 1))
    return F.when(text.rlike(pattern),
                  F.split(F.regexp_replace(text, "(?s)" + pattern + ".*", joined), ","))


def _getter(arrays: Callable[[str], Column]) -> Callable[[str], Column]:
    def get(name: str) -> Column:
        if name == "yl":
            return F.length(arrays("s").getItem(2))
        # int first: an over-long digit run becomes null instead of overflowing later
        return arrays(name[0]).getItem(int(name[1:]) - 1).try_cast("int")
    return get


def _assemble(get: Callable[[str], Column], as_of: _dt.date) -> Column:
    def make(y, mo, d, h, mi, s):
        # the try_ form gives null for a bad month, day, hour or minute;
        # second 60 (which it would roll over) and year 0 are refused here
        return F.when((s < F.lit(60)) & (y >= F.lit(1)),
                      F.try_make_timestamp_ntz(y, mo, d, h, mi, s))

    compact = make(*(get(f"c{i}") for i in range(1, 7)))
    start = F.lit(window_start(as_of).isoformat() + " 00:00:00").cast("timestamp_ntz")
    base = century_window(as_of)[0]
    mo, d, yy, h, mi = (get(f"s{i}") for i in range(1, 6))
    zero = F.lit(0)
    low = make(F.lit(base) + yy, mo, d, h, mi, zero)
    high = make(F.lit(base + 100) + yy, mo, d, h, mi, zero)
    # Two-digit year: the window's century unless that falls before the start.
    two_digit = F.when(low >= start, low).otherwise(high)
    slashed = F.when(get("yl") == F.lit(2), two_digit).otherwise(make(yy, mo, d, h, mi, zero))
    return F.coalesce(compact, slashed)


def timestamp_parts(text: Column, prefix: str) -> list[Column]:
    """Digit groups of both layouts as array columns ``{prefix}_c`` / ``{prefix}_s``."""
    return [_groups(text, k).alias(f"{prefix}_{k}") for k in _LAYOUTS]


def timestamp_from_parts(prefix: str, as_of: _dt.date) -> Column:
    """Timestamp from the columns made by ``timestamp_parts(..., prefix)``."""
    return _assemble(_getter(lambda k: F.col(f"{prefix}_{k}")), as_of)


def parse_case_timestamp(text: Column, as_of: _dt.date) -> Column:
    """Parse an extract date/time text in one expression; null when no layout matches."""
    return _assemble(_getter(lambda k: _groups(text, k)), as_of)


def with_case_timestamps(df, columns: dict[str, str], as_of: _dt.date):
    """Add parsed timestamps ``{out: text column}`` in two projections."""
    parts = [c for i, text in enumerate(columns.values())
             for c in timestamp_parts(F.col(text), f"_tsp{i}")]
    staged = df.select("*", *parts)
    outs = [timestamp_from_parts(f"_tsp{i}", as_of).alias(out) for i, out in enumerate(columns)]
    return staged.select(*[F.col(f"`{c}`") for c in df.columns], *outs)
