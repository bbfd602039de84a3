"""Surrogate ids, account upsert and their properties."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from caseweek.operators import (account_changes, batch_members, dense_ids, merge_surrogates,
                                upsert_accounts)
from caseweek.sources import extract_fields
from caseweek import testbed

from conftest import SF


def long_df(spark, rows):
    return spark.createDataFrame(rows, "dimension string, member string, id int")


def test_merge_golden(spark):
    dim = long_df(spark, [("v", "2.0", 1), ("v", "2.1", 2), ("v", "2.2", 3)])
    batch = spark.createDataFrame([("v", m) for m in ["2.0", "2.3", "2.4", "Not used"]],
                                  "dimension string, member string")
    merged, added = merge_surrogates(dim, batch)
    got = sorted((r.member, r.id) for r in merged.collect())
    assert got == [("2.0", 1), ("2.1", 2), ("2.2", 3), ("2.3", 4), ("2.4", 5), ("Not used", 6)]
    assert added.count() == 3


def test_from_empty(spark):
    empty = long_df(spark, [])
    batch = spark.createDataFrame([("p", "b"), ("p", "a"), ("q", None)], "dimension string, member string")
    merged, _ = merge_surrogates(empty, batch)
    assert sorted((r.dimension, r.member, r.id) for r in merged.collect()) == \
        [("p", "a", 1), ("p", "b", 2), ("q", None, 1)]


def test_dense_ids_equal_row_number_over_many_partitions(spark):
    keys = (spark.range(0, 5000).select(
        F.when(F.col("id") % 3 == 0, "x").otherwise("y").alias("dimension"),
        F.when(F.col("id") % 97 == 0, None).otherwise(F.format_string("k%07d", (F.col("id") * 7919) % 100003)).alias("member"))
        .distinct().repartition(13))
    got = dense_ids(keys).collect()
    ref = keys.select("dimension", "member", F.row_number().over(
        Window.partitionBy("dimension").orderBy(F.col("member").asc_nulls_first())).alias("id")).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, ref), key=str)


def test_existing_ids_never_change_and_stay_dense(spark):
    x_old = extract_fields(testbed.raw_extract(spark, SF, "old"))
    x_new = extract_fields(testbed.raw_extract(spark, SF, "new"))
    old = dense_ids(batch_members(x_old))
    merged, _ = merge_surrogates(old, batch_members(x_new))
    before = {(r.dimension, r.member): r.id for r in old.collect()}
    after = {(r.dimension, r.member): r.id for r in merged.collect()}
    assert all(after[k] == v for k, v in before.items())
    for dim in {d for d, _ in after}:
        ids = sorted(v for (d, _), v in after.items() if d == dim)
        assert ids == list(range(1, len(ids) + 1))


def test_account_upsert_golden(spark):
    cur = spark.createDataFrame([(1, "A"), (2, "B")], "id int, name string")
    batch = spark.createDataFrame([(2, "B2"), (3, "C")], "id int, name string")
    assert sorted(map(tuple, upsert_accounts(cur, batch).collect())) == [(1, "A"), (2, "B2"), (3, "C")]
    changes = sorted(map(tuple, account_changes(cur, batch).collect()))
    assert changes == [(2, "B2", "renamed"), (3, "C", "new")]


def test_batch_accounts_one_name_per_id(spark):
    from caseweek.operators import batch_accounts
    extract = spark.createDataFrame(
        [("CUST-7", "Beta"), ("CUST-7", "Alpha"), ("X-9", None), ("", "NoId"), (None, "NoId2")],
        "accountID string, account string")
    got = sorted(map(tuple, batch_accounts(extract).collect()), key=str)
    assert got == sorted([(7, "Beta"), (9, None), (-1, "NoId2")], key=str)
    cur = spark.createDataFrame([(9, "Old"), (5, "Keep")], "id int, name string")
    merged = sorted(map(tuple, upsert_accounts(cur, batch_accounts(extract)).collect()), key=str)
    assert merged == sorted([(5, "Keep"), (7, "Beta"), (9, None), (-1, "NoId2")], key=str)


def test_account_merge_same_with_and_without_broadcast(spark):
    from caseweek.operators import account_merge
    cur = spark.createDataFrame([(1, "A"), (2, "B"), (3, None), (4, "D")], "id int, name string")
    batch = spark.createDataFrame([(2, "B2"), (3, None), (4, None), (5, "E")], "id int, name string")
    a = sorted(map(tuple, account_merge(cur, batch).collect()), key=str)
    b = sorted(map(tuple, account_merge(cur, batch, broadcast_check=False).collect()), key=str)
    assert a == b == sorted([(1, "A", None), (2, "B2", "renamed"), (3, None, None),
                             (4, None, "renamed"), (5, "E", "new")], key=str)
