"""Process-once loading and plan shapes that matter at scale."""

from pyspark.sql import functions as F

from caseweek import testbed
from caseweek.operators import code_cases, lookup_ids, to_facts, touched_partitions
from caseweek.plans import Warehouse, load_batch
from caseweek.session import work_path
from caseweek.sources import extract_fields, read_facts, read_partitions, write_extract
from caseweek.streaming import ledger_path, process_once

from conftest import SF


def test_process_once_loads_each_file_once(spark):
    root = work_path(spark, "t-inbox")
    for batch in ("old", "new"):          # a drop is one file
        write_extract(testbed.raw_extract(spark, SF, batch).coalesce(1), f"{root}/in/{batch}")
    wh = Warehouse(f"{root}/wh")
    kw = dict(checkpoint=f"{root}/cp", archive=f"{root}/archive", as_of=testbed.AS_OF)
    process_once(spark, f"{root}/in/*/*.csv", wh, **kw)
    first = read_facts(spark, wh.facts).count()
    process_once(spark, f"{root}/in/*/*.csv", wh, **kw)
    assert read_facts(spark, wh.facts).count() == first
    old, new = (testbed.raw_extract(spark, SF, b).select("Case Number") for b in ("old", "new"))
    assert first == old.union(new).distinct().count()      # cases sent again replace the earlier rows
    ledger = spark.read.orc(ledger_path(wh))
    assert ledger.agg(F.sum("rows")).first()[0] == old.count() + new.count()
    assert ledger.where(F.length("run_date") == 8).count() == ledger.count()


def plan_text(df, capsys) -> str:
    capsys.readouterr()
    df.explain()
    return capsys.readouterr().out


def test_touched_weeks_prune_the_fact_scan(spark, capsys):
    wh = Warehouse(work_path(spark, "t-prune"))
    p = work_path(spark, "t-prune-x")
    write_extract(testbed.raw_extract(spark, SF, "old"), p)
    load_batch(spark, p, wh, as_of=testbed.AS_OF)
    coded = code_cases(extract_fields(testbed.raw_extract(spark, SF, "new")), testbed.AS_OF)
    scan = read_partitions(spark, wh.facts, touched_partitions(coded))
    plan = plan_text(scan, capsys)
    assert "PartitionFilters: [" in plan and ("INSET" in plan or " IN (" in plan)
    # only touched weeks come back
    weeks = {(r.year, r.week) for r in touched_partitions(coded).collect()}
    assert {(r.year, r.week) for r in scan.select("year", "week").distinct().collect()} <= weeks


def test_lookups_broadcast_small_dimensions(spark, capsys):
    x = extract_fields(testbed.raw_extract(spark, SF))
    from caseweek.operators import batch_members, dense_ids
    facts = to_facts(lookup_ids(code_cases(x, testbed.AS_OF), dense_ids(batch_members(x))))
    plan = plan_text(facts, capsys)
    assert plan.count("BroadcastHashJoin") >= 4 and "SortMergeJoin" not in plan


def test_upsert_keeps_existing_rows_in_place(spark, capsys):
    """The batch keys are broadcast: the existing rows are not shuffled for the anti join."""
    from caseweek.operators import merge_partitions
    wh = Warehouse(work_path(spark, "t-bcast"))
    p = work_path(spark, "t-bcast-x")
    write_extract(testbed.raw_extract(spark, SF, "old"), p)
    load_batch(spark, p, wh, as_of=testbed.AS_OF)
    coded = code_cases(extract_fields(testbed.raw_extract(spark, SF, "new")), testbed.AS_OF)
    facts = coded.select(*[c for c in coded.columns if not c.startswith("_nk_") and c != "findings"],
                         *[F.lit(-1).alias(c) for c in ("ambariVersionID", "stackVersionID",
                                                         "componentID", "rootcauseID")])
    merged = merge_partitions(read_partitions(spark, wh.facts, touched_partitions(coded)), facts,
                              scoped=True)
    plan = plan_text(merged, capsys)
    anti = [line for line in plan.splitlines() if "LeftAnti" in line]
    assert anti and all("BroadcastHashJoin" in line and "BuildRight" in line for line in anti)
    assert "SortMergeJoin" not in plan


def test_process_once_one_file_per_micro_batch_equals_load_then_update(spark):
    from caseweek.plans import update_batch
    root = work_path(spark, "t-inbox2")
    for batch in ("old", "new"):          # one file per drop, written in order
        write_extract(testbed.raw_extract(spark, SF, batch).coalesce(1), f"{root}/in/{batch}")
    wh, together = Warehouse(f"{root}/wh"), Warehouse(f"{root}/together")
    process_once(spark, f"{root}/in/*/*.csv", wh, checkpoint=f"{root}/cp", as_of=testbed.AS_OF,
                 max_files_per_trigger=1)
    process_once(spark, f"{root}/in/*/*.csv", together, checkpoint=f"{root}/cp2", as_of=testbed.AS_OF)
    ref = Warehouse(f"{root}/ref")
    load_batch(spark, f"{root}/in/old", ref, as_of=testbed.AS_OF)
    update_batch(spark, f"{root}/in/new", ref, as_of=testbed.AS_OF)

    def rows(w):
        return sorted(map(tuple, read_facts(spark, w.facts).collect()), key=str)
    assert rows(wh) == rows(ref) == rows(together)
    assert spark.read.orc(ledger_path(wh)).count() == 2


def test_account_merge_reads_the_dimension_in_place(spark, capsys):
    from caseweek.operators import account_merge, batch_accounts
    dim = spark.range(0, 5000).select(F.col("id").cast("int").alias("id"),
                                      F.concat(F.lit("acct-"), F.col("id").cast("string")).alias("name"))
    x = extract_fields(testbed.raw_extract(spark, SF, "new"))
    plan = plan_text(account_merge(dim, batch_accounts(x)), capsys)
    joins = [line for line in plan.splitlines() if "Join" in line and "==" not in line]
    assert joins and all("BroadcastHashJoin" in line for line in joins)
    assert "SortMergeJoin" not in plan


def test_inboxes_and_new_checkpoints_keep_each_others_findings(spark):
    root = work_path(spark, "t-inboxes")
    for batch in ("old", "new"):
        write_extract(testbed.raw_extract(spark, SF, batch).coalesce(1), f"{root}/{batch}")
    wh = Warehouse(f"{root}/wh")
    seen = []
    for inbox, checkpoint in (("old", "a"), ("new", "b"), ("new", "c")):
        process_once(spark, f"{root}/{inbox}", wh, checkpoint=f"{root}/cp-{checkpoint}", as_of=testbed.AS_OF)
        seen.append(spark.read.orc(wh.findings).count())
    assert seen[0] < seen[1] < seen[2]
    ledger = spark.read.orc(ledger_path(wh))
    assert ledger.count() == 3 and ledger.select("query_id").distinct().count() == 3
    assert spark.read.orc(wh.findings).select("batch").distinct().count() == 3


def test_row_coding_runs_each_link_regex_once(spark):
    from caseweek.operators import explode_findings
    coded = code_cases(extract_fields(testbed.raw_extract(spark, SF, "new")), testbed.AS_OF)
    plan = coded._jdf.queryExecution().optimizedPlan().toString()      # as a load persists it
    assert plan.count("regexp_extract(") <= 5 and "lambdafunction" not in plan
    assert "lambdafunction" not in explode_findings(coded)._jdf.queryExecution().optimizedPlan().toString()
