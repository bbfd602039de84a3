"""Property tests: the column rules against small Python models of the same rules.

Each test draws one batch of examples with hypothesis and checks it in a
single Spark job (Spark per example would be too slow).
"""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from caseweek.functions import link_tail, parse_case_timestamp, resolution_minutes

AS_OF = dt.date(2017, 7, 1)
SETTINGS = settings(max_examples=3, deadline=None, derandomize=True,
                    suppress_health_check=list(HealthCheck))


def run(spark, values, fn):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return [r[0] for r in df.select(fn(F.col("v"))).collect()]


def model_tail(s):
    if s is None or "-" not in s:
        return None
    i = s.rfind("-")
    t = s[s[:i].rfind("/") + 1:].strip("".join(chr(c) for c in range(0x21)))
    t = t[:-1] if t.endswith(";") else t
    t = t[:-1] if t.endswith("/") else t
    return t.upper()


@SETTINGS
@given(st.lists(st.text(alphabet="ab-/;. \tZ9", max_size=25), min_size=200, max_size=200))
def test_link_tail_model(spark, links):
    assert run(spark, links, link_tail) == [model_tail(s) for s in links]


def model_ts(kind, y, mo, d, h, mi, s):
    try:
        if kind == "slashed-2":
            low = dt.datetime(1900 + y, mo, d, h, mi) if y != 0 else None
            if low is not None and low >= dt.datetime(1937, 7, 1):
                return low
            return dt.datetime(2000 + y, mo, d, h, mi)
        if kind == "slashed-4":
            return dt.datetime(y, mo, d, h, mi)
        return dt.datetime(y, mo, d, h, mi, s)
    except ValueError:
        return None


fields = st.tuples(st.sampled_from(["compact", "slashed-2", "slashed-4"]), st.integers(0, 99),
                   st.integers(0, 13), st.integers(0, 32), st.integers(0, 25),
                   st.integers(0, 61), st.integers(0, 61), st.sampled_from(["", ".000", " PM"]))


def text_of(kind, y, mo, d, h, mi, s, tail):
    if kind == "compact":
        return f"{1950 + y:04d}{mo:02d}{d:02d} {h:02d}{mi:02d}{s:02d}{tail}"
    if kind == "slashed-2":
        return f"{mo}/{d}/{y:02d} {h}:{mi:02d}{tail}"
    return f"{mo}/{d}/{1950 + y} {h}:{mi:02d}{tail}"


@SETTINGS
@given(st.lists(fields, min_size=300, max_size=300))
def test_timestamp_model(spark, cases):
    texts = [text_of(*c) for c in cases]
    expected = []
    for kind, y, mo, d, h, mi, s, _ in cases:
        year = 1950 + y if kind in ("compact", "slashed-4") else y
        expected.append(model_ts(kind, year, mo, d, h, mi, s))
    assert run(spark, texts, lambda c: parse_case_timestamp(c, AS_OF)) == expected


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 400), st.integers(0, 99), st.integers(0, 99)),
                min_size=100, max_size=100))
def test_resolution_model(spark, parts):
    texts = [f"{a} days {b} hours{c} mn" for a, b, c in parts]
    assert run(spark, texts, resolution_minutes) == [1440 * a + 60 * b + c for a, b, c in parts]


def model_week(d):
    since_sunday = (d.weekday() + 1) % 7          # Sunday-first weeks
    friday = d - dt.timedelta(days=since_sunday) + dt.timedelta(days=5)
    return (friday + dt.timedelta(days=1)).year, friday.strftime("%m-%d")


@SETTINGS
@given(st.lists(st.dates(min_value=dt.date(1900, 1, 1), max_value=dt.date(2100, 12, 31)),
                min_size=300, max_size=300))
def test_week_partition_model(spark, days):
    from caseweek.functions import week_partition_columns
    df = spark.createDataFrame([(dt.datetime(d.year, d.month, d.day, 12),) for d in days],
                               "t timestamp_ntz")
    w = week_partition_columns(F.col("t"), AS_OF)
    got = [tuple(r) for r in df.select(w["year"], w["week"]).collect()]
    assert got == [model_week(d) for d in days]


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c"]),
                          st.one_of(st.none(), st.text(alphabet="xyzXYZ019 ", max_size=6))),
                min_size=1, max_size=400, unique=True),
       st.fixed_dictionaries({"a": st.integers(0, 50), "b": st.integers(0, 50)}))
def test_dense_ids_model(spark, keys, bases):
    from caseweek.operators import dense_ids
    kdf = spark.createDataFrame(keys, "dimension string, member string").repartition(5)
    base = spark.createDataFrame(list(bases.items()), "dimension string, _base int")
    got = {(r.dimension, r.member): r.id for r in dense_ids(kdf, base).collect()}
    expected = {}
    for dim in "abc":
        members = sorted((m for d, m in keys if d == dim),
                         key=lambda m: (m is not None, (m or "").encode()))
        for i, m in enumerate(members, 1):
            expected[(dim, m)] = bases.get(dim, 0) + i
    assert got == expected


row = st.tuples(st.integers(0, 30), st.sampled_from(["01-06", "01-13", "01-20", "01-27"]))


@SETTINGS
@given(st.lists(row, max_size=60), st.lists(row, max_size=30))
def test_upsert_model(spark, current, batch):
    from caseweek.operators import merge_partitions
    from caseweek.schemas import FACT_COLUMNS, FACT_SCHEMA
    from caseweek.session import work_path
    from caseweek.sinks import write_facts
    from caseweek.sources import read_facts

    def frame(rows, tag):
        out = []
        for case, week in rows:
            v = {c: None for c in FACT_COLUMNS}
            v.update(caseNum=case, severity=tag)
            out.append(tuple(v[c] for c in FACT_COLUMNS) + (2017, week))
        return spark.createDataFrame(out, FACT_SCHEMA)

    path = work_path(spark, "p-upsert")
    write_facts(frame(current, 0), path)
    write_facts(merge_partitions(read_facts(spark, path), frame(batch, 1)), path, "overwrite")
    got = sorted((r.week, r.caseNum, r.severity) for r in read_facts(spark, path).collect())
    sent = {(w, c) for c, w in batch}
    expected = sorted([(w, c, 0) for c, w in current if (w, c) not in sent]
                      + [(w, c, 1) for c, w in batch])
    assert got == expected
