"""Golden rows for the column rules (FIXTURES section 7)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from caseweek.functions import (account_id, environment_id, link_parts, link_tail,
                                link_tail_backtrack, parse_case_timestamp, resolution_minutes,
                                severity_code, status_code, week_partition_columns,
                                with_case_timestamps)
from caseweek.specs import LINKS

AS_OF = dt.date(2017, 7, 1)
LINK = {s.column: s for s in LINKS}


def one(spark, values, expr, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {typ}")
    return [r[0] for r in df.select(expr(F.col("v"))).collect()]


TS_CASES = [
    ("20170306 064703.000", dt.datetime(2017, 3, 6, 6, 47, 3)),
    ("20170306 064703", dt.datetime(2017, 3, 6, 6, 47, 3)),
    ("6/9/17 13:09", dt.datetime(2017, 6, 9, 13, 9)),
    ("6/9/17 13:09 trailing", dt.datetime(2017, 6, 9, 13, 9)),
    ("06/09/2017 13:09", dt.datetime(2017, 6, 9, 13, 9)),
    ("1/20/2017  3:25:00 AM", dt.datetime(2017, 1, 20, 3, 25)),
    ("1/20/17 3:25 PM", dt.datetime(2017, 1, 20, 3, 25)),
    ("6/9/85 01:00", dt.datetime(1985, 6, 9, 1, 0)),
    ("2/29/00 10:00", dt.datetime(2000, 2, 29, 10, 0)),
    ("  6/ 9/17  13:09", dt.datetime(2017, 6, 9, 13, 9)),
    (" 20170306 064703", None),
    ("20170306  064703", None),
    ("2017030 064703", None),
    ("13/45/17 25:61", None),
    ("20171306 064703", None),
    ("2017-03-06 06:47:03", None),
    ("", None),
    (None, None),
    ("6/9/17", None),
    ("20170306", None),
    ("n/a", None),
]


@pytest.mark.parametrize("staged", [False, True])
def test_timestamps(spark, staged):
    values = [v for v, _ in TS_CASES]
    if staged:
        df = spark.createDataFrame([(v,) for v in values], "v string")
        got = [r[0] for r in with_case_timestamps(df, {"t": "v"}, AS_OF).select("t").collect()]
    else:
        got = one(spark, values, lambda c: parse_case_timestamp(c, AS_OF))
    assert got == [e for _, e in TS_CASES]


def test_week_partition(spark):
    df = spark.createDataFrame([(dt.datetime(2017, 6, 11),), (dt.datetime(2021, 12, 27),),
                                (dt.datetime(2022, 1, 1),), (None,)], "d timestamp_ntz")
    w = week_partition_columns(F.col("d"), AS_OF)
    got = [tuple(r) for r in df.select(w["year"], w["week"]).collect()]
    assert got == [(2017, "06-16"), (2022, "12-31"), (2022, "12-31"), (2017, "06-30")]


def test_link_tail_and_internal_bug(spark):
    rows = [
        ("https://h/browse/BUG-123", "BUG-123", 123, []),
        ("https://h/browse/BUG-1; https://h/browse/bug-2;", "BUG-2", 2, []),
        ("BUG-5/", "BUG-5", 5, []),
        ("BUG-5/;", "BUG-5", 5, []),
        ("BUG-5;/", "BUG-5;", None, ["L1"]),
        ("https://my-host/123", "MY-HOST/123", None, ["L1"]),
        ("-7", "-7", None, ["L1"]),
        ("123", None, None, ["L0", "L1U"]),
        (None, None, None, []),
    ]
    df = spark.createDataFrame([(r[0],) for r in rows], "v string")
    p = link_parts(F.col("v"), LINK["hBug"])
    got = df.select(link_tail(F.col("v")), p["id"], p["findings"].getField("code")).collect()
    for (link, tail, ident, codes), r in zip(rows, got):
        assert (r[0], r[1], list(r[2])) == (tail, ident, codes), link


def test_backtrack(spark):
    got = one(spark, ["https://h/browse/HOTFIX-9/", "ab-1", "x"], lambda c: link_tail_backtrack(c, 6))
    assert got == ["HOTFIX-9", None, None]


def test_upstream_issue(spark):
    rows = [("https://h/browse/HDFS-12", "hdfs", 12, []),
            ("https://h/browse/HIVE-12", "HDFS", None, ["L2M"]),
            ("https://h/browse/HIVE-12", None, None, ["L2M"]),
            ("https://h/browse/HDFS-x", "HDFS", None, ["L2"]),
            ("12", "HDFS", None, ["L0", "L2U"])]
    df = spark.createDataFrame([(a, b) for a, b, _, _ in rows], "v string, comp string")
    p = link_parts(F.col("v"), LINK["aBug"], F.col("comp"))
    got = df.select(p["id"], p["findings"]).collect()
    for (link, comp, ident, codes), r in zip(rows, got):
        assert r[0] == ident and [f["code"] for f in r[1]] == codes, (link, comp)
    mism = [f["message"] for f in got[2][1]][0]
    assert mism.endswith("component null.")


@pytest.mark.parametrize("col,rows", [
    ("hotfix", [("https://h/browse/hotfix-9/", 9, []), ("https://h/browse/HF-9", None, ["L3"]),
                ("none", None, ["L0", "L3U"])]),
    ("EAR", [("https://h/browse/EAR-4;", 4, []), ("a-b/c", None, ["L4"]), ("4", None, ["L0", "L4U"])]),
    ("RMP", [("RMP-31", 31, []), ("x-1", None, ["L5"]), ("31", None, ["L0", "L5U"])]),
])
def test_other_links(spark, col, rows):
    df = spark.createDataFrame([(r[0],) for r in rows], "v string")
    p = link_parts(F.col("v"), LINK[col])
    got = df.select(p["id"], p["findings"].getField("code")).collect()
    assert [(r[0], list(r[1])) for r in got] == [(i, c) for _, i, c in rows]


def test_scalars(spark):
    assert one(spark, ["S1 - Production Down", "s1 - production down", None, "other"],
               severity_code) == [1, -1, -1, -1]
    assert one(spark, ["closed", "Open", None, "CLOSED"], status_code) == [0, 1, 1, 0]
    assert one(spark, ["A-1-42", "42", "", None, "A-x"], account_id) == [42, 42, -1, -1, -1]
    assert one(spark, ["ENV-7", "", None, "ENV-"], environment_id) == [7, None, None, None]
    assert one(spark, ["0 days 8 hours48 mn", "2 days 0 hours5 mn", None, "8 hours",
                       "1 days 1 hours 99999999999 mn"], resolution_minutes) == [528, 2885, None, None, None]


def test_findings_set_union_per_case(spark):
    """A case sent twice with the same problems reports each message once."""
    from caseweek.operators import code_cases, explode_findings, findings_report
    from caseweek.sources import extract_fields
    from caseweek import testbed
    x = extract_fields(testbed.raw_extract(spark, "/root/testdata/sf0.001"))
    one = x.where(F.col("caseNum") == 1)
    doubled = one.unionByName(one)
    rep = findings_report(explode_findings(code_cases(doubled, AS_OF))).collect()
    single = findings_report(explode_findings(code_cases(one, AS_OF))).collect()
    assert len(rep) == 1 and rep[0]["messages"] == single[0]["messages"]
    assert rep[0]["n_messages"] == single[0]["n_messages"]


def test_lookup_misses_and_null_members(spark):
    from caseweek.operators import lookup_ids
    from caseweek.operators.coding import key_column
    from caseweek.specs import SURROGATE_DIMENSIONS
    dims = spark.createDataFrame([("ambariVersion", "Not used", 7), ("stackVersion", None, 3),
                                  ("product", "HDFS", 1), ("rootcause", "x", 2)],
                                 "dimension string, member string, id int")
    rows = [("Not used", None, "HDFS", "y"), ("2.5", "2.6.0", "HIVE", "x")]
    coded = spark.createDataFrame(rows, ", ".join(f"{key_column(s)} string" for s in SURROGATE_DIMENSIONS))
    got = [tuple(r) for r in lookup_ids(coded, dims).collect()]
    assert got == [(7, 3, 1, -1), (-1, -1, -1, 2)]


def test_tail_trims_like_java_and_stays_linear(spark):
    import time
    got = one(spark, ["\tBUG-5\n", "x/BUG-5 ;", "BUG-5\u2028", "BUG-5 ", None], link_tail)
    # U+2028 is above U+0020, so it is not trimmed
    assert got == ["BUG-5", "BUG-5 ", "BUG-5\u2028", "BUG-5", None]
    long = "a" * 200_000 + "/b-c" + " " * 100_000 + "x"
    t = time.time()
    assert one(spark, [long], link_tail) == ["B-C" + " " * 100_000 + "X"]
    assert time.time() - t < 20
