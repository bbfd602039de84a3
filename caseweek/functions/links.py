"""Issue-link tails, ids and link findings (Column -> Column).

Tail rule: take the text after the last ``/`` that precedes the **last**
``-``, trim control characters and blanks at both ends, drop one trailing
``;`` and then one trailing ``/``, and upper-case it. A link without ``-`` has
no tail. Because the tail always holds a ``-``, an id pattern with an
"optional" prefix in effect needs the prefix.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..specs import NO_DASH_CODE, NO_DASH_MESSAGE, LinkSpec
from .messages import render

# Java's String.trim(): every char up to U+0020 at either end.
_EDGE_CHARS = "".join(chr(c) for c in range(0x21))
# One trailing ";" and then one trailing "/" (together: an optional "/" and
# an optional ";" right at the end).
_SUFFIX = r"/?;?\z"


def clean_tail(raw: Column) -> Column:
    return F.upper(F.regexp_replace(F.btrim(raw, F.lit(_EDGE_CHARS)), _SUFFIX, ""))


def has_dash(link: Column) -> Column:
    return F.instr(link, "-") > 0


def link_tail(link: Column) -> Column:
    """Tail of a link (null when the link is null or holds no ``-``).

    String functions only (linear in the text length, whatever its shape):
    the part after the last ``-``, and before it the segment after the last
    ``/`` of the text preceding that ``-``.
    """
    after = F.substring_index(link, "-", -1)
    before = link.substr(F.lit(1), F.length(link) - F.length(after) - F.lit(1))
    raw = F.concat(F.substring_index(before, "/", -1), F.lit("-"), after)
    return F.when(has_dash(link), clean_tail(raw))


def link_tail_backtrack(link: Column, n: int) -> Column:
    """Tail taken as the ``n`` characters before the last ``-`` onwards;
    null when fewer than ``n`` characters precede it."""
    dash0 = F.length(link) - F.length(F.substring_index(link, "-", -1)) - F.lit(1)  # 0-based
    raw = link.substr(dash0 - F.lit(n) + F.lit(1), F.length(link))
    return F.when(has_dash(link) & (dash0 >= F.lit(n)), clean_tail(raw))


def _full(pattern: str) -> str:
    return rf"^{pattern}\z"


def link_digits(tail: Column, spec: LinkSpec) -> Column:
    """Digits of a tail that fits the link's pattern, empty if it doesn't, null without a tail."""
    return F.regexp_extract(tail, _full(spec.pattern), spec.id_group)


def link_parts(link: Column, spec: LinkSpec, component: Column | None = None,
               tail: Column | None = None, digits: Column | None = None) -> dict[str, Column]:
    """Id, findings array and helper columns for one link column.

    ``tail`` and ``digits`` may be columns already holding
    ``link_tail(link)`` and ``link_digits(tail, spec)`` (computed once in
    earlier projections; everything else follows from them without a
    regex). Returns ``id`` (int), ``present`` (the id text exists, before
    the int cast), ``entries`` (array<struct<code, message>>, null where a
    finding doesn't apply) and ``findings`` (the same, nulls removed).
    """
    tail = link_tail(link) if tail is None else tail
    digits = link_digits(tail, spec) if digits is None else digits
    matched = digits != F.lit("")
    unusable = link.isNotNull() & ~has_dash(link)
    malformed = has_dash(link) & ~matched
    entries = [
        F.when(unusable, F.struct(F.lit(NO_DASH_CODE).alias("code"),
                                  render(NO_DASH_MESSAGE, link=link).alias("message"))),
        F.when(unusable, F.struct(F.lit(spec.code + "U").alias("code"),
                                  render(spec.unusable_message, link=link).alias("message"))),
        F.when(malformed, F.struct(F.lit(spec.code).alias("code"),
                                   render(spec.invalid_message, tail=tail).alias("message"))),
    ]
    ok = matched
    if spec.project_group is not None:
        project = tail.substr(F.lit(1), F.length(tail) - F.length(digits) - F.lit(1))
        same = F.coalesce(F.lower(project) == F.lower(component), F.lit(False))
        entries.append(F.when(matched & ~same, F.struct(
            F.lit(spec.mismatch_code).alias("code"),
            render(spec.mismatch_message, tail=tail,
                   component=F.coalesce(component, F.lit("null"))).alias("message"))))
        ok = matched & same
    text_id = F.when(ok, digits)
    every = F.array(*entries)
    return {"id": text_id.try_cast("int"), "present": text_id.isNotNull(), "entries": every,
            "findings": F.filter(every, lambda e: e.isNotNull())}
