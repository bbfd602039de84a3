"""Versioned tables: weeks put in place at once, loads side by side, account changes, drops in one pass."""

import os
import sys

import pytest
from pyspark.sql import functions as F

from caseweek import testbed
from caseweek.operators import dense_ids, upsert_accounts
from caseweek.plans import (Warehouse, compact_accounts, grow_accounts, grow_surrogates, jobs, load_batch, read_accounts,
                            read_surrogates, remove_unused, update_batch)
from caseweek.schemas import EXTRACT_LAYOUT, FACT_COLUMNS, FACT_SCHEMA
from caseweek.session import fits_broadcast, work_path
from caseweek.sinks import write_automation, write_facts, write_smartsense
from caseweek.sources import (DROP_NUMBER, fact_versions, number_drops, read_extract, read_facts, split_refused,
                              write_extract)
from caseweek.streaming import ledger_path, process_once
from caseweek.versions import Conflict, Folder, VersionedTable

from conftest import SF

AS_OF = testbed.AS_OF


def fact(spark, rows):
    full = []
    for case, year, week, severity in rows:
        values = dict.fromkeys(FACT_COLUMNS) | {"caseNum": case, "severity": severity}
        full.append((*(values[c] for c in FACT_COLUMNS), year, week))
    return spark.createDataFrame(full, FACT_SCHEMA)


def snapshot(df):
    return sorted((r.year, r.week, r.caseNum, r.severity) for r in df.collect())


def extract(spark, rows, path):
    """Rows (number, opened, account, component, ambari) as extract lines in one file."""
    values = {"Case Number": 0, "Date/Time Opened": 1, "Customer Record ID": 2, "Account Name": 3, "Product Component": 4,
              "Ambari Version": 5}
    fixed = {"Severity": "S4 - x", "Status": "Closed", "Root Cause": "Undetermined at this time"}
    full = [tuple(str(r[values[h]]) if h in values and r[values[h]] is not None else fixed.get(h) for h, _, _ in EXTRACT_LAYOUT)
            for r in rows]
    raw = spark.createDataFrame(full, ", ".join(f"`{h}` string" for h, _, _ in EXTRACT_LAYOUT))
    write_extract(raw.coalesce(1), path)
    return path


# ---- K3, K4: all weeks at once -------------------------------------------------------------

def test_a_version_can_be_published_once(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    base = table.current()
    first = table.publish(base, [Folder("a", ("x", 1))])
    with pytest.raises(Conflict):
        table.publish(base, [Folder("b")])
    assert table.current() == first and first.folders == (Folder("a", ("x", 1)),)
    # two that have both seen the same state: the rename refuses the second
    again = VersionedTable(spark, str(tmp_path / "t"))
    again._numbers = lambda: [1]
    table.publish(first, [Folder("c")])
    with pytest.raises(Conflict):
        again.publish(first, [Folder("d")])
    assert table.current().folders == (Folder("c"),)
    assert [f for f in os.listdir(tmp_path / "t" / "_versions") if f.startswith(".draft")] == []


def test_a_failure_half_way_leaves_the_old_rows(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "facts")
    write_facts(fact(spark, [(1, 2017, "06-09", 0), (2, 2017, "06-16", 0)]), path)
    before = snapshot(read_facts(spark, path))
    rows = fact(spark, [(1, 2017, "06-09", 9), (2, 2017, "06-16", 9)])
    broken = rows.withColumn("severity", F.when(F.col("week") == "06-16", F.raise_error(F.lit("no")).cast("int")).otherwise(F.col("severity")))
    with pytest.raises(Exception):
        write_facts(broken, path, "overwrite")
    assert snapshot(read_facts(spark, path)) == before

    def stopped(*_):
        raise RuntimeError("stopped before the weeks are in place")
    with monkeypatch.context() as m:
        m.setattr(VersionedTable, "publish", stopped)
        with pytest.raises(RuntimeError):
            write_facts(rows, path, "overwrite")
    assert snapshot(read_facts(spark, path)) == before
    setting = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    write_facts(rows, path, "overwrite")
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == setting
    assert [s for *_, s in snapshot(read_facts(spark, path))] == [9, 9]


def test_readers_keep_their_version(spark, tmp_path):
    path = str(tmp_path / "facts")
    write_facts(fact(spark, [(1, 2017, "06-09", 0)]), path)
    version = fact_versions(spark, path).current()
    write_facts(fact(spark, [(5, 2017, "06-09", 5)]), path, "overwrite")
    assert snapshot(read_facts(spark, path, version=version)) == [(2017, "06-09", 1, 0)]
    assert snapshot(read_facts(spark, path)) == [(2017, "06-09", 5, 5)]


def test_plain_week_folders_are_taken_as_they_stand(spark, tmp_path):
    path = str(tmp_path / "facts")
    fact(spark, [(1, 2017, "06-09", 0), (2, 2017, "06-16", 0)]).write.partitionBy("year", "week").orc(path)
    assert len(snapshot(read_facts(spark, path))) == 2
    write_facts(fact(spark, [(3, 2017, "06-16", 3)]), path, "overwrite")
    write_facts(fact(spark, [(4, 2017, "06-16", 4)]), path)
    assert snapshot(read_facts(spark, path)) == [(2017, "06-09", 1, 0), (2017, "06-16", 3, 3), (2017, "06-16", 4, 4)]


def test_unused_folders_are_removed(spark, tmp_path):
    wh = Warehouse(str(tmp_path / "wh"))
    for severity in (1, 2, 3):
        write_facts(fact(spark, [(1, 2017, "06-09", severity)]), wh.facts, "overwrite")
    assert remove_unused(spark, wh, keep_versions=1) == 0                     # too young
    assert remove_unused(spark, wh, older_than_hours=-1) == 2
    assert snapshot(read_facts(spark, wh.facts)) == [(2017, "06-09", 1, 3)]


def test_unused_members_are_removed_and_used_ones_stay(spark, tmp_path):
    wh = Warehouse(str(tmp_path / "wh"))
    for names in ("ab", "cd"):
        grow_surrogates(spark, wh, spark.createDataFrame([("product", n) for n in names], "dimension string, member string"))
    os.makedirs(tmp_path / "wh/members/load=left-behind")
    before = sorted(map(str, read_surrogates(spark, wh).collect()))
    assert remove_unused(spark, wh, older_than_hours=1) == 0 and remove_unused(spark, wh, older_than_hours=-1) == 1
    assert sorted(map(str, read_surrogates(spark, wh).collect())) == before and len(before) == 4


def test_working_tables_are_cleared(spark, monkeypatch, tmp_path):
    from caseweek import session
    monkeypatch.setattr(session, "_work_root", lambda _: str(tmp_path / "work"))
    mine = work_path(spark, "own")
    spark.range(3).write.parquet(mine)
    os.makedirs(tmp_path / "work/other-application/table")
    assert session.clear_work(spark) == 1 and not os.path.exists(mine)
    assert os.path.exists(tmp_path / "work/other-application")
    assert session.clear_work(spark, others_older_than_hours=1) == 0 and session.clear_work(spark, others_older_than_hours=-1) == 1


# ---- loads at once ---------------------------------------------------------------------------

def test_two_loads_at_once_give_dense_unique_ids(spark, tmp_path, monkeypatch):
    wh = Warehouse(str(tmp_path / "wh"))

    def members(*names):
        return spark.createDataFrame([("product", n) for n in names] + [("rootcause", "r" + n) for n in names],
                                     "dimension string, member string")
    grow_surrogates(spark, wh, members("a", "b"))
    real, calls = jobs.dense_ids, []

    def between(*args):
        out = real(*args)
        if not calls:                       # the other load comes in after this one has read the dimension
            calls.append(1)
            grow_surrogates(spark, wh, members("c", "d"))
        return out
    monkeypatch.setattr(jobs, "dense_ids", between)
    added = grow_surrogates(spark, wh, members("b", "c", "e", "f"))
    assert calls and added == {"product": 2, "rootcause": 2}
    for name in ("product", "rootcause"):
        rows = read_surrogates(spark, wh).where(F.col("dimension") == name).collect()
        assert sorted(r["id"] for r in rows) == [1, 2, 3, 4, 5, 6] and len({r["member"] for r in rows}) == 6


def test_an_upsert_whose_weeks_change_meanwhile_is_made_again(spark, tmp_path, monkeypatch):
    wh = Warehouse(str(tmp_path / "wh"))
    write_facts(fact(spark, [(1, 2017, "06-09", 0), (2, 2017, "06-16", 0)]), wh.facts)
    real, calls = jobs.merge_partitions, []

    def between(current, batch, **kw):
        if not calls:
            calls.append(1)
            write_facts(fact(spark, [(7, 2017, "06-09", 7)]), wh.facts)        # the same week
        elif len(calls) == 1:
            calls.append(2)
            write_facts(fact(spark, [(8, 2017, "06-16", 8)]), wh.facts)        # another week
        return real(current, batch, **kw)
    monkeypatch.setattr(jobs, "merge_partitions", between)
    batch = fact(spark, [(1, 2017, "06-09", 9)])
    jobs._store_facts(spark, wh, batch, batch, "upsert")
    assert len(calls) == 2
    assert snapshot(read_facts(spark, wh.facts)) == [(2017, "06-09", 1, 9), (2017, "06-09", 7, 7), (2017, "06-16", 2, 0),
                                                     (2017, "06-16", 8, 8)]


def test_many_new_members_are_numbered_alike(spark):
    keys = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "x").otherwise("y").alias("dimension"),
                                    F.format_string("k%05d", (F.col("id") * 7919) % 10007).alias("member")).distinct()
    base = spark.createDataFrame([("x", 40), ("z", 9)], "dimension string, _base int")
    few, many = {}, {}
    a = sorted(map(tuple, dense_ids(keys, base, few).collect()))
    b = sorted(map(tuple, dense_ids(keys, base, many, window_keys=10).collect()))
    assert a == b and few == many == {"x": 1000, "y": 2000} and min(i for d, _, i in a if d == "x") == 41


# ---- K1: account changes ---------------------------------------------------------------------

def accounts(spark, *rows):
    return spark.createDataFrame(rows, "id int, name string")


def test_account_changes_read_back_as_the_rewrite(spark, tmp_path):
    wh = Warehouse(str(tmp_path / "wh"))
    base = spark.range(5000).select(F.col("id").cast("int").alias("id"), F.concat(F.lit("n"), "id").alias("name"))
    want, batches = base, [accounts(spark, (7, "seven"), (9000, "new")), accounts(spark, (7, "n7")), accounts(spark, (8, None)),
                           accounts(spark, (8, None), (7, "n7"))]
    assert grow_accounts(spark, wh, base) == 5000
    changes = []
    for batch in batches:
        changes.append(grow_accounts(spark, wh, batch))
        want = upsert_accounts(want, batch)
        assert sorted(map(tuple, read_accounts(spark, wh).collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert changes == [2, 1, 1, 0]
    table = VersionedTable(spark, wh.dimension("account"))
    version = table.current()
    assert [f.part[:2] for f in version.folders] == [("base", 5000), ("change", 2), ("change", 1), ("change", 1)]
    one = os.listdir(table.location(version.folders[2]).removeprefix("file:"))
    assert len([f for f in one if f.endswith(".orc")]) == 1                   # a one-name batch is one small file
    compact_accounts(spark, wh)
    assert [f.part[0] for f in table.current().folders] == ["base"]
    assert sorted(map(tuple, read_accounts(spark, wh).collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_accounts_are_compacted_by_themselves_and_keep_later_changes(spark, tmp_path, monkeypatch):
    wh = Warehouse(str(tmp_path / "wh"))
    monkeypatch.setattr(jobs, "COMPACT_FILES", 2)
    for k in range(5):
        grow_accounts(spark, wh, accounts(spark, (1, f"name {k}"), (10 + k, "own")))
    table = VersionedTable(spark, wh.dimension("account"))
    assert [f.part[0] for f in table.current().folders] == ["base", "change"]
    assert {r["id"]: r["name"] for r in read_accounts(spark, wh).collect()} == {1: "name 4"} | {10 + k: "own" for k in range(5)}
    real = jobs._read_accounts

    def between(*args):
        out = real(*args)
        monkeypatch.setattr(jobs, "_read_accounts", real)
        grow_accounts(spark, wh, accounts(spark, (1, "changed while compacting")))
        return out
    monkeypatch.setattr(jobs, "_read_accounts", between)
    compact_accounts(spark, wh)
    assert {r["id"]: r["name"] for r in read_accounts(spark, wh).collect()}[1] == "changed while compacting"


def test_accounts_of_plain_files_take_changes(spark, tmp_path):
    wh = Warehouse(str(tmp_path / "wh"))
    accounts(spark, (1, "a"), (2, "b")).write.orc(wh.dimension("account"))
    assert grow_accounts(spark, wh, accounts(spark, (2, "B"), (3, "c"))) == 2
    assert sorted(map(tuple, read_accounts(spark, wh).collect())) == [(1, "a"), (2, "B"), (3, "c")]


def test_the_join_of_account_changes_is_not_one_task(spark, tmp_path):
    wh = Warehouse(str(tmp_path / "wh"))
    base = spark.range(5000).select(F.col("id").cast("int").alias("id"), F.concat(F.lit("n"), "id").alias("name"))
    sent = base.where("id < 4000").select("id", F.concat(F.col("name"), F.lit(" Ltd")).alias("name"))
    plain = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in plain}
    try:
        for k, v in plain.items():
            spark.conf.set(k, v)
        assert (grow_accounts(spark, wh, base), grow_accounts(spark, wh, sent.repartition(4))) == (5000, 4000)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    names = {f: len([n for n in os.listdir(tmp_path / "wh" / "account" / f) if n.endswith(".orc")])
             for f in os.listdir(tmp_path / "wh" / "account") if f.startswith("load=")}
    assert all(n > 1 for n in names.values()), names
    assert read_accounts(spark, wh).where("name LIKE '% Ltd'").count() == 4000


# ---- K12: drops in one pass ------------------------------------------------------------------

def five_drops(spark, root):
    paths = []
    for k in range(5):
        rows = [(c, "20170605 010000" if (c + k) % 3 else "20170613 010000", f"X-{c % 4}", f"acct {c % 4} of {k}" if c % 2 else None,
                 f"comp{(c * 7 + k) % 6}", f"2.{k}" if c % 3 else None) for c in range(k, 12 + k, 1 + k % 2)]
        rows += [(3, "20170605 020000", "X-1", "again", "zz", "2.0")] * 2 + [("bad", "n/a", "X-1", "b", "c", "d")]
        paths.append(extract(spark, rows, f"{root}/in/{k}"))
    return paths


@pytest.mark.parametrize("mode", ["upsert", "append", "overwrite"])
def test_five_files_in_one_pass_equal_file_by_file(spark, mode):
    root = work_path(spark, "t-drops")
    paths = five_drops(spark, root)
    one, ref = Warehouse(f"{root}/one"), Warehouse(f"{root}/ref")
    run = process_once(spark, f"{root}/in/*/*.csv", one, checkpoint=f"{root}/cp", as_of=AS_OF, mode=mode)
    for path in paths:
        if mode == "upsert":
            update_batch(spark, path, ref, as_of=AS_OF)
        else:
            load_batch(spark, path, ref, as_of=AS_OF, overwrite=mode == "overwrite")

    def rows(df):
        return sorted(map(str, df.collect()))
    assert rows(read_facts(spark, one.facts)) == rows(read_facts(spark, ref.facts)) != []
    assert rows(read_surrogates(spark, one)) == rows(read_surrogates(spark, ref))
    assert rows(read_accounts(spark, one)) == rows(read_accounts(spark, ref))
    for path in ("findings", "refused"):
        mine, theirs = (spark.read.orc(f"{w.root}/{path}") for w in (one, ref))
        assert rows(mine.drop("batch")) == rows(theirs.drop("batch"))
        assert mine.select("batch").distinct().count() == theirs.select("batch").distinct().count()
    assert spark.read.orc(ledger_path(one)).count() == 5
    # as many jobs as for one file: the files are read and loaded once
    alone = Warehouse(f"{root}/alone")
    single = process_once(spark, f"{root}/in/0/*.csv", alone, checkpoint=f"{root}/cp1", as_of=AS_OF, mode=mode)
    count = [len(spark.sparkContext.statusTracker().getJobIdsForGroup(r)) for r in (run, single)]
    assert count[0] <= count[1] + 4


def test_a_drop_is_read_once_and_coded_in_compiled_methods(spark, monkeypatch):
    module = sys.modules["caseweek.streaming.process_once"]
    root, seen = work_path(spark, "t-once"), {}
    extract(spark, [(c, "20170605 010000", "X-1", "a", "c", "2.0") for c in range(9)], f"{root}/in/0")
    load, ledger, limit = module.load_frame, module.write_ledger, "spark.sql.codegen.hugeMethodLimit"

    def loading(session, rows, *args, **kw):
        seen["limit"] = int(rows.sparkSession.conf.get(limit))
        return load(session, rows, *args, **kw)

    def entering(session, wh, rows, *args):
        seen["held"] = rows.storageLevel.useMemory
        return ledger(session, wh, rows, *args)
    monkeypatch.setattr(module, "load_frame", loading)
    monkeypatch.setattr(module, "write_ledger", entering)
    before = spark.conf.get(limit)
    process_once(spark, f"{root}/in/*/*.csv", Warehouse(f"{root}/wh"), checkpoint=f"{root}/cp", as_of=AS_OF)
    assert seen == {"limit": 8000, "held": True}
    assert spark.conf.get(limit) == before


def test_kept_rows_are_stored_in_small_batches(spark, monkeypatch):
    module = sys.modules["caseweek.streaming.process_once"]
    root, seen, size = work_path(spark, "t-batches"), {}, "spark.sql.inMemoryColumnarStorage.batchSize"
    extract(spark, [(c, "20170605 010000", "X-1", "a", "c", "2.0") for c in range(4000)], f"{root}/in/0")
    ledger, before = module.write_ledger, spark.conf.get(size)

    def entering(session, wh, rows, *args):
        kept = rows._jdf.queryExecution().withCachedData().cacheBuilder().cachedColumnBuffers()
        seen["partitions"], seen["batches"] = kept.getNumPartitions(), kept.count()
        return ledger(session, wh, rows, *args)
    monkeypatch.setattr(module, "write_ledger", entering)
    process_once(spark, f"{root}/in/*/*.csv", Warehouse(f"{root}/wh"), checkpoint=f"{root}/cp", as_of=AS_OF)
    assert seen["partitions"] <= 4 and seen["batches"] >= 8       # a task of 1,000 rows holds one batch otherwise
    assert spark.conf.get(size) == before


@pytest.mark.parametrize("mode", ["upsert", "overwrite"])
def test_the_first_and_last_drop_are_found_without_sorting_all_rows(spark, monkeypatch, mode):
    root, plans = work_path(spark, "t-numbers"), {}
    five_drops(spark, root)

    def seeing(name, plan_of):
        run = getattr(jobs, name)

        def wrapped(*args, **kw):
            out = run(*args, **kw)
            plans[name] = plan_of(out)._jdf.queryExecution().executedPlan().toString()
            return out
        monkeypatch.setattr(jobs, name, wrapped)
    seeing("batch_members", lambda members: members)
    seeing("last_drops", lambda rows: rows)
    process_once(spark, f"{root}/in/*/*.csv", Warehouse(f"{root}/wh"), checkpoint=f"{root}/cp", as_of=AS_OF, mode=mode)
    assert set(plans) == {"batch_members", "last_drops"}
    for name, plan in plans.items():        # an aggregate of a struct or a text sorts its rows first
        assert "HashAggregate" in plan and "SortAggregate" not in plan, (name, plan)


def test_drops_are_numbered_in_order(spark):
    times = "timestamp '2020-01-02'", "timestamp '2020-01-01'"
    rows = spark.sql(f"""SELECT 1 AS n, named_struct('time', {times[0]}, 'file', 'a') AS _drop UNION ALL
        SELECT 2, named_struct('time', {times[1]}, 'file', 'b') UNION ALL SELECT 3, named_struct('time', {times[1]}, 'file', 'a')
        UNION ALL SELECT 4, named_struct('time', {times[1]}, 'file', 'b') UNION ALL SELECT 5, NULL""")
    numbered, listed = number_drops(rows)
    assert {r["n"]: r[DROP_NUMBER] for r in numbered.collect()} == {1: 3, 2: 2, 3: 1, 4: 2, 5: None}
    assert numbered.columns == ["n", "_drop", DROP_NUMBER] and listed.count() == 3
    listed.unpersist()


def test_drops_of_several_files_are_folders(spark):
    root = work_path(spark, "t-folders")
    for k, batch in enumerate(("old", "new")):
        write_extract(testbed.raw_extract(spark, SF, batch).repartition(4), f"{root}/in/{k}")
    wh, ref = Warehouse(f"{root}/wh"), Warehouse(f"{root}/ref")
    process_once(spark, f"{root}/in/*/*.csv", wh, checkpoint=f"{root}/cp", as_of=AS_OF, drops="folder")
    load_batch(spark, f"{root}/in/0", ref, as_of=AS_OF)
    update_batch(spark, f"{root}/in/1", ref, as_of=AS_OF)
    assert sorted(map(str, read_facts(spark, wh.facts).collect())) == sorted(map(str, read_facts(spark, ref.facts).collect()))
    assert spark.read.orc(ledger_path(wh)).count() == 2


def test_a_load_may_remember_its_files(spark):
    root = work_path(spark, "t-once")
    wh, path = Warehouse(f"{root}/wh"), extract(spark, [(1, "20170605 010000", "X-1", "a", "c", None)], f"{root}/in/a")
    assert load_batch(spark, path, wh, as_of=AS_OF, once=True).rows == 1
    assert load_batch(spark, path, wh, as_of=AS_OF, once=True).rows == 0
    extract(spark, [(2, "20170605 010000", "X-2", "b", "c", None)], f"{root}/in/b")
    assert update_batch(spark, f"{root}/in/*", wh, as_of=AS_OF, once=True).rows == 1
    assert sorted(r["caseNum"] for r in read_facts(spark, wh.facts).collect()) == [1, 2]
    assert load_batch(spark, path, wh, as_of=AS_OF).rows == 1 and read_facts(spark, wh.facts).count() == 3


# ---- K7, K8: buckets of many files -------------------------------------------------------------

def test_a_hot_bucket_is_written_by_many_tasks(spark, tmp_path, capsys):
    from caseweek.sinks import deal_buckets
    side = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, 42).otherwise(F.col("id")).cast("int").alias("CaseNum"), F.lit("r").alias("Existing_Rule"),
        F.col("id").cast("string").alias("Suggestion"), F.lit("o").alias("Suggestion_Owner"), F.lit("v").alias("Reviewed_By"),
        F.lit("j").alias("JIRA"), F.lit("s").alias("status"), F.when(F.col("id") % 3 == 1, 1 + F.col("id") % 4).otherwise(9).cast("int").alias("Priority"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")      # small tasks stay apart here
    try:
        for rows_per_file, most in ((500, 500), (100_000, 9000)):
            write_smartsense(side, "t_hot", str(tmp_path / f"s{rows_per_file}"), rows_per_file=rows_per_file)
            files = [f for folder, _, names in os.walk(tmp_path / f"s{rows_per_file}") for f in names if f.endswith(".orc")]
            hot = [n for folder, _, names in os.walk(tmp_path / f"s{rows_per_file}/Priority=9") for n in names if n.endswith(".orc")]
            assert len(hot) >= (8 if rows_per_file == 500 else 2) and len(files) > len(hot)
            assert sorted(map(str, spark.table("t_hot").select(*side.columns).collect())) == sorted(map(str, side.collect()))
            spark.sql("DROP TABLE t_hot")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    events = testbed.side_rows(spark, SF)
    write_automation(events, "t_auto_hot", str(tmp_path / "a"), rows_per_file=50)
    capsys.readouterr()
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    one = spark.table("t_auto_hot").where("CaseNum = 42")
    one.explain()
    spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    assert "SelectedBucketsCount: 1 out of 3" in capsys.readouterr().out
    assert one.count() == events.where("CaseNum = 42").count() == 1
    assert spark.table("t_auto_hot").join(spark.table("t_auto_hot").groupBy("CaseNum").count(), "CaseNum").count() == events.count()
    dealt = deal_buckets(events, 3, "CaseNum", [], 50)
    assert sorted(map(str, dealt.collect())) == sorted(map(str, events.collect()))


# ---- S1: lines that don't fit -------------------------------------------------------------------

def test_lines_of_too_few_or_too_many_fields_are_refused(spark, tmp_path):
    header = ",".join(h for h, _, _ in EXTRACT_LAYOUT)
    good = "S1 - Production Down,X-1,a,11,Open,20170605 010000" + "," * 12
    lines = [header, good, "S1 - Production Down,X-1,a,12,Open,20170605 010000,,,2.0", good.replace(",11,", ",13,") + ",more,fields",
             "S1 - Production Down,X-1,a,x14,Open,20170605 010000" + "," * 12, good.replace(",11,", ",15,")]
    (tmp_path / "x.csv").write_text("\n".join(lines) + "\n")
    cases, refused = split_refused(read_extract(spark, str(tmp_path / "x.csv"), raw_line=True))
    assert sorted(r["caseNum"] for r in cases.collect()) == [11, 15]
    got = {r["line"]: (r["reason"], r["case_num"]) for r in refused.collect()}
    assert got == {lines[2]: ("fields", 12), lines[3]: ("fields", 13), lines[4]: ("case number", None)}
    wh = Warehouse(str(tmp_path / "wh"))
    loaded = load_batch(spark, str(tmp_path / "x.csv"), wh, as_of=AS_OF)
    assert (loaded.rows, loaded.refused) == (5, 3) and read_facts(spark, wh.facts).count() == 2
    assert sorted(r["case_num"] for r in spark.read.orc(wh.findings).where("code = 'X1'").collect()) == [12, 13]
    assert read_accounts(spark, wh).count() == 1


# ---- J1, J4: broadcasts by bytes ----------------------------------------------------------------

def test_many_long_names_are_not_broadcast(spark):
    short = spark.range(500_000).select("id", F.lit("n").alias("name"))
    long = spark.range(2_000_000).select("id", F.repeat(F.lit("long name "), 20).alias("name"))
    assert fits_broadcast(short) and not fits_broadcast(long)
    assert not fits_broadcast(spark.range(2_000_001)) and fits_broadcast(long.limit(100))
    assert not fits_broadcast(short, max_bytes=1000) and fits_broadcast(short.where("id < 0"))


def test_one_broadcast_serves_all_lookups(spark):
    from caseweek.operators import batch_members, code_cases, lookup_ids
    from caseweek.sources import extract_fields
    x = extract_fields(testbed.raw_extract(spark, SF))
    looked = lookup_ids(code_cases(x, AS_OF), dense_ids(batch_members(x)))
    looked.collect()
    plan = looked._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert all(f"ReusedExchange [_m_{name}" in final for name in ("stackVersion", "product", "rootcause"))


def test_a_load_takes_few_jobs(spark, tmp_path):
    wh = Warehouse(str(tmp_path / "wh"))
    context, counts = spark.sparkContext, []
    for batch in ("old", "new"):
        write_extract(testbed.raw_extract(spark, SF, batch), str(tmp_path / batch))
        context.setJobGroup(f"t-{batch}", batch)
        (load_batch if batch == "old" else update_batch)(spark, str(tmp_path / batch), wh, as_of=AS_OF)
        counts.append(len(context.statusTracker().getJobIdsForGroup(f"t-{batch}")))
    context.setJobGroup("rest", "rest")
    print("jobs a load, an update:", counts)
    assert counts[0] <= 28 and counts[1] <= 35
