"""Query catalogue: one Spark query per operator group, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the driver's test tables (through ``testbed`` for the
stand-in extracts) and runs the library's own operators over all rows.
Queries that write use a fresh folder under the session's shared
checkpoint root and return what they read back.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import testbed
from .functions import (account_id, environment_id, link_parts, link_tail, link_tail_backtrack,
                        resolution_minutes, severity_code, status_code, week_partition_columns,
                        with_case_timestamps)
from .operators import (account_merge, batch_accounts, batch_members, batch_profile, code_cases,
                        dense_ids, duplicate_keys, explode_findings, findings_case_count,
                        findings_report, lookup_ids, merge_surrogates, new_members, orphan_rows,
                        to_facts, touched_partitions, upsert_accounts)
from .plans import (Warehouse, bootstrap_dimensions, fact_rows, load_batch, maintain_dimensions, read_accounts,
                    read_surrogates, update_batch)
from .session import work_path
from .sinks import write_automation, write_smartsense, write_staging
from .schemas import NAME_DIM_SCHEMA
from .sources import (extract_fields, read_dimension, read_extract, read_facts, read_partitions,
                      write_extract)
from .specs import LINKS, MISFIT_RULE
from .streaming import ledger_path
from .streaming import process_once as _process_once

AS_OF = testbed.AS_OF
BACKTRACK = 6
_LINK = {s.column: s for s in LINKS}


def _x(spark: SparkSession, sf: str, batch: str = "all") -> DataFrame:
    return extract_fields(testbed.raw_extract(spark, sf, batch))


def _coded(spark, sf, batch="all") -> DataFrame:
    return code_cases(_x(spark, sf, batch), AS_OF)


def _dims_from(spark, sf, batch) -> DataFrame:
    """Surrogate dimensions built from one batch into empty tables."""
    return dense_ids(batch_members(_x(spark, sf, batch)))


def _csv(spark, sf, batch) -> str:
    path = work_path(spark, f"extract-{batch}")
    write_extract(testbed.raw_extract(spark, sf, batch), path)
    return path


# ---- scan and column rules ------------------------------------------------------

def case_extract_scan(spark, sf):
    """The extract written as delimited text and scanned back by position."""
    return read_extract(spark, _csv(spark, sf, "all"))


def severity_status_codes(spark, sf):
    """Severity and status codes."""
    return _x(spark, sf).select("caseNum", severity_code(F.col("severity")).alias("severity"),
                                status_code(F.col("status")).alias("status"))


def case_timestamps(spark, sf):
    """open/close timestamps from the two layouts."""
    x = _x(spark, sf).select("caseNum", F.col("dateOpen").alias("_o"), F.col("dateClose").alias("_c"))
    return with_case_timestamps(x, {"dateOpen": "_o", "dateClose": "_c"}, AS_OF).drop("_o", "_c")


def account_env_ids(spark, sf):
    """account id (-1 default) and environment id."""
    return _x(spark, sf).select("caseNum", account_id(F.col("accountID")).alias("accountID"),
                                environment_id(F.col("Env")).alias("Env"))


def link_tail_q(spark, sf):
    """Link tails of every extract link column and of ``pages.url``."""
    links = F.explode(F.array(*[F.struct(F.lit(s.column).alias("source"), F.col(s.column).alias("link"))
                                for s in LINKS]))
    cases = _x(spark, sf).select(F.col("caseNum").cast("long").alias("id"), links.alias("l")).select(
        "l.source", "id", "l.link")
    rows = cases.unionByName(testbed.table(spark, sf, "pages").select(
        F.lit("pages.url").alias("source"), F.col("page_id").cast("long").alias("id"),
        F.col("url").alias("link")))
    return rows.select("source", "id", "link", link_tail(F.col("link")).alias("tail"),
                       link_tail_backtrack(F.col("link"), BACKTRACK).alias("tail_back"))


def reference_ids(spark, sf):
    """Internal bug, hotfix, EAR and enhancement-request ids."""
    names = ("hBug", "hotfix", "EAR", "RMP")
    x = _x(spark, sf).select("caseNum", *names, *[link_tail(F.col(c)).alias(f"_t{c}") for c in names])
    cols = [link_parts(F.col(c), _LINK[c], tail=F.col(f"_t{c}"))["id"].alias(c) for c in names]
    return x.select("caseNum", *cols)


def component_issue(spark, sf):
    """F8: upstream issue number, only when its project is the case's component."""
    x = _x(spark, sf).select("caseNum", "component", "aBug", link_tail(F.col("aBug")).alias("_t"))
    return x.select("caseNum", "component",
                    link_parts(F.col("aBug"), _LINK["aBug"], F.col("component"), F.col("_t"))["id"].alias("aBug"))


def resolution_minutes_q(spark, sf):
    """resolution time in minutes."""
    return _x(spark, sf).select("caseNum", resolution_minutes(F.col("ResolutionTime")).alias("ResolutionTime"))


def week_partition(spark, sf):
    """(week-year, Friday label) of case open dates (as_of when
    missing), event times and line-item ship dates."""
    x = with_case_timestamps(_x(spark, sf), {"_opened": "dateOpen"}, AS_OF)
    opened = F.col("_opened")

    def part(df, source, key, ts):
        w = week_partition_columns(ts, AS_OF)
        return df.select(F.lit(source).alias("source"), F.col(key).cast("long").alias("key"),
                         w["year"].alias("year"), w["week"].alias("week"))
    return (part(x, "cases", "caseNum", opened)
            .unionByName(part(testbed.table(spark, sf, "events"), "events", "event_id", F.col("ts")))
            .unionByName(part(testbed.table(spark, sf, "lineitem"), "lineitem", "l_orderkey",
                              F.col("l_shipdate"))))


# ---- dimensions ---------------------------------------------------------------------

def dim_new_members(spark, sf):
    """Members of the new batch absent from the dimensions of the old one."""
    x_old, x_new = _x(spark, sf, "old"), _x(spark, sf, "new")
    surrogate = new_members(batch_members(x_new), dense_ids(batch_members(x_old)))
    acc_new = batch_accounts(x_new).select("id")
    acc_old = batch_accounts(x_old).select("id")
    accounts = acc_new.join(acc_old, "id", "left_anti").select(
        F.lit("account").alias("dimension"), F.col("id").cast("string").alias("member"))
    return surrogate.unionByName(accounts)


def dim_dense_ids(spark, sf):
    """D1 from empty: dense ids of part brands and part names, in name order."""
    part = testbed.table(spark, sf, "part")
    keys = (part.select(F.lit("p_brand").alias("dimension"), F.col("p_brand").alias("member"))
            .unionByName(part.select(F.lit("p_name").alias("dimension"), F.col("p_name").alias("member")))
            .distinct())
    return dense_ids(keys)


def dim_merge_ids(spark, sf):
    """Old-batch dimensions merged with the new batch's members."""
    merged, _ = merge_surrogates(_dims_from(spark, sf, "old"), batch_members(_x(spark, sf, "new")))
    return merged


def dim_account_upsert(spark, sf):
    """Account dimension of the old batch, upserted with the new batch."""
    old = batch_accounts(_x(spark, sf, "old"))
    return upsert_accounts(old, batch_accounts(_x(spark, sf, "new")))


def dim_growth(spark, sf):
    """Per dimension, old and new size, members added, accounts renamed."""
    x_old, x_new = _x(spark, sf, "old"), _x(spark, sf, "new")
    dims_old = dense_ids(batch_members(x_old))
    _, added = merge_surrogates(dims_old, batch_members(x_new))
    # every row of the merged tables once, with what the update did to it
    accounts = account_merge(batch_accounts(x_old), batch_accounts(x_new)).select(
        F.lit("account").alias("dimension"), "change")
    rows = (dims_old.select("dimension", F.lit(None).cast("string").alias("change"))
            .unionByName(added.select("dimension", F.lit("new").alias("change"))).unionByName(accounts))
    is_new = F.coalesce(F.col("change") == "new", F.lit(False))
    return rows.groupBy("dimension").agg(
        F.count(F.when(~is_new, 1)).alias("old_size"), F.count(F.lit(1)).alias("new_size"),
        F.count(F.when(is_new, 1)).alias("added"),
        F.count(F.when(F.col("change") == "renamed", 1)).alias("renamed"))


def dim_lookup_default(spark, sf):
    """New-batch rows looked up in the old dimensions; misses get -1."""
    looked = lookup_ids(_coded(spark, sf, "new"), _dims_from(spark, sf, "old"))
    return looked.select("caseNum", "ambariVersionID", "stackVersionID", "componentID", "rootcauseID")


def _read_all_dims(spark, wh) -> DataFrame:
    acc = read_accounts(spark, wh).select(F.lit("account").alias("dimension"),
                                          F.col("name").alias("member"), F.col("id"))
    return read_surrogates(spark, wh).unionByName(acc)


def dim_rewrite_roundtrip(spark, sf):
    """K1: dimension tables written for the old batch, updated for the new one
    (surrogates: new members added; accounts: changes put over the base), read back."""
    wh = Warehouse(work_path(spark, "dims"))
    maintain_dimensions(spark, wh, _x(spark, sf, "old"))
    maintain_dimensions(spark, wh, _x(spark, sf, "new"))
    return _read_all_dims(spark, wh)


# ---- facts ------------------------------------------------------------------------

def fact_normalised(spark, sf):
    """Coded, id-looked-up, week-partitioned fact rows of one extract."""
    x = _x(spark, sf)
    return to_facts(lookup_ids(code_cases(x, AS_OF), dense_ids(batch_members(x))))


def _two_loads(spark, sf, second: str, catalog: bool = False) -> DataFrame:
    wh = Warehouse(work_path(spark, "wh"), catalog_prefix=_table_name("cw") + "_" if catalog else None)
    old_csv, new_csv = _csv(spark, sf, "old"), _csv(spark, sf, "new")
    load_batch(spark, old_csv, wh, as_of=AS_OF)
    if second == "append":
        load_batch(spark, new_csv, wh, as_of=AS_OF)
    elif second == "overwrite":
        load_batch(spark, new_csv, wh, overwrite=True, as_of=AS_OF)
    else:
        update_batch(spark, new_csv, wh, as_of=AS_OF)
    return fact_rows(spark, wh)


def fact_append_roundtrip(spark, sf):
    """K2: old then new batch appended to the partitioned ORC fact table (by path)."""
    return _two_loads(spark, sf, "append")


def fact_overwrite_partitions(spark, sf):
    """K3/K6: old batch appended, then the new batch overwrites only its weeks,
    read through the catalog fact table."""
    return _two_loads(spark, sf, "overwrite", catalog=True)


def fact_upsert_partitions(spark, sf):
    """Old batch loaded, then the new batch upserted by case
    number inside each touched week (the merged rows stay a DataFrame; K13's
    temporary view is not needed)."""
    return _two_loads(spark, sf, "upsert")


def touched_partitions_q(spark, sf):
    """A2: distinct (year, week) of the new batch."""
    return touched_partitions(_coded(spark, sf, "new"))


def fact_partition_scan(spark, sf):
    """After loading the old batch, scan only the weeks the new batch touches."""
    wh = Warehouse(work_path(spark, "wh"))
    load_batch(spark, _csv(spark, sf, "old"), wh, as_of=AS_OF)
    return read_partitions(spark, wh.facts, touched_partitions(_coded(spark, sf, "new")))


# ---- findings -----------------------------------------------------------------------

def _findings(spark, sf) -> DataFrame:
    return explode_findings(_coded(spark, sf))


def findings_rules(spark, sf):
    """The first matching record-quality rule of each closed case."""
    return _findings(spark, sf).where(F.col("code").startswith("R"))


def findings_links(spark, sf):
    """L0-L5U: link findings (many per case possible)."""
    return _findings(spark, sf).where(F.col("code").startswith("L"))


def findings_report_q(spark, sf):
    """Per case, the sorted set of messages joined into one string."""
    return findings_report(_findings(spark, sf))


def findings_case_count_q(spark, sf):
    """Number of cases with findings (and of findings rows)."""
    return findings_case_count(_findings(spark, sf))


def batch_profile_q(spark, sf):
    """Member counts of the new batch and of the old batch's dimensions."""
    x_old, x_new = _x(spark, sf, "old"), _x(spark, sf, "new")
    return batch_profile(batch_members(x_new), batch_accounts(x_new),
                         dense_ids(batch_members(x_old)), batch_accounts(x_old))


# ---- audits, staging, side tables ----------------------------------------------------------

def audit_duplicate_cases(spark, sf):
    """K9: (order, line) keys held by more than one line item."""
    li = testbed.table(spark, sf, "lineitem")
    return duplicate_keys(li, ["l_orderkey", "l_linenumber"])


def audit_duplicate_facts(spark, sf):
    """K9 on the fact table: the old and the new batch appended (a repeated
    append keeps both copies), then case numbers stored more than once."""
    return duplicate_keys(_two_loads(spark, sf, "append"), ["caseNum"])


def audit_orphan_cases(spark, sf):
    """Side-table rows whose case number has no case."""
    side = testbed.side_rows(spark, sf)
    return orphan_rows(side, _x(spark, sf), "CaseNum", "caseNum").select("CaseNum", "Description")


def staging_account(spark, sf):
    """Customers as $-delimited staging text -> account dimension."""
    wh = Warehouse(work_path(spark, "staging"))
    cust = testbed.table(spark, sf, "customer")
    write_staging(cust.select(F.col("c_name").alias("name"), F.col("c_custkey").alias("ID")),
                  f"{wh.root}/stage-accounts", "$")
    bootstrap_dimensions(spark, wh, account_staging=f"{wh.root}/stage-accounts")
    return read_accounts(spark, wh)


def staging_product(spark, sf):
    """Parts as comma-delimited staging text -> product dimension."""
    wh = Warehouse(work_path(spark, "staging"))
    part = testbed.table(spark, sf, "part")
    write_staging(part.select(F.col("p_name").alias("name"), F.col("p_partkey").alias("ID")),
                  f"{wh.root}/stage-products", ",")
    bootstrap_dimensions(spark, wh, product_staging=f"{wh.root}/stage-products")
    return read_dimension(spark, wh.dimension("product"), NAME_DIM_SCHEMA)


def fact_after_bootstrap(spark, sf):
    """A product dimension bootstrapped from staging text that lists every
    name many times, then a load: one fact row for each extract row."""
    wh = Warehouse(work_path(spark, "wh"))
    cust = testbed.table(spark, sf, "customer")
    write_staging(cust.select(F.col("c_mktsegment").alias("name"), F.col("c_custkey").alias("ID")),
                  f"{wh.root}/stage-products", ",")
    bootstrap_dimensions(spark, wh, product_staging=f"{wh.root}/stage-products")
    load_batch(spark, _csv(spark, sf, "new"), wh, as_of=AS_OF)
    return fact_rows(spark, wh).select("caseNum", "componentID")


def malformed_cases(spark, sf):
    """A new batch updated twice in which pending cases have unreadable numbers, cases of severity
    ``other`` lines that end after nine fields, and S4 cases lines of twenty. Those rows stand in the refused
    table of both loads, with why, and misfit lines have a finding; the others are stored once. Counts by kind
    and case."""
    root = work_path(spark, "wh")
    wh, path = Warehouse(root), f"{root}/csv"
    number = F.col("Case Number").cast("string")
    raw = testbed.raw_extract(spark, sf, "new").withColumn(
        "Case Number", F.when(F.col("Status") == "Pending", F.concat(F.lit("no-"), number)).otherwise(number))
    short, long = F.col("Severity") == "other", F.col("Severity").startswith("S4")
    write_extract(raw.where(~short & ~long), f"{path}/fit")
    for name, rows in (("short", raw.where(short).select(*raw.columns[:9])),
                       ("long", raw.where(long).select("*", F.lit("more").alias("x"), F.lit("fields").alias("y")))):
        rows.write.option("header", True).csv(f"{path}/{name}")
    for _ in range(2):
        update_batch(spark, f"{path}/*", wh, as_of=AS_OF)
    refused = spark.read.format(wh.fmt).load(wh.refused).select(
        F.concat(F.lit("refused: "), F.col("reason")).alias("kind"),
        F.regexp_extract("line", "^(?:[^,]*,){3}(?:no-)?([0-9]+),", 1).alias("case_number"))
    found = spark.read.format(wh.fmt).load(wh.findings).where(F.col("code") == MISFIT_RULE.code).select(
        F.lit("finding").alias("kind"), F.col("case_num").cast("string").alias("case_number"))
    stored = fact_rows(spark, wh).select(F.lit("fact").alias("kind"), F.col("caseNum").cast("string").alias("case_number"))
    rows = refused.unionByName(found).unionByName(stored)
    return rows.groupBy("kind", "case_number").agg(F.count(F.lit(1)).alias("n"))


def _table_name(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:10]}"


def _side_table(spark, name: str, write, rows: DataFrame) -> DataFrame:
    """Write a side table, drop it from the catalog (its files stay) and read the files back."""
    table, path = _table_name(name), work_path(spark, name)
    write(rows, table, path)
    schema = spark.table(table).schema
    spark.sql(f"DROP TABLE `{table}`")
    return spark.read.schema(schema).orc(path).select(*rows.columns)


def automation_bucketed(spark, sf):
    """K7: Automation side table, 3 buckets on CaseNum, read back."""
    return _side_table(spark, "automation", write_automation, testbed.side_rows(spark, sf))


def smartsense_bucketed(spark, sf):
    """K8: SmartSense side table, partitioned by Priority, 2 buckets, read back."""
    return _side_table(spark, "smartsense", write_smartsense, testbed.smartsense_rows(spark, sf))


def process_once(spark, sf):
    """Two extract drops (folders of part files) in an inbox, loaded by a
    file-stream source that runs twice; every file is loaded exactly once, in
    one pass over both, the later drop after the earlier."""
    root = work_path(spark, "inbox")
    for batch in ("old", "new"):
        write_extract(testbed.raw_extract(spark, sf, batch), f"{root}/in/{('old', 'new').index(batch)}-{batch}")
    wh = Warehouse(f"{root}/wh")
    for _ in range(2):
        _process_once(spark, f"{root}/in/*/*.csv", wh, checkpoint=f"{root}/checkpoint",
                      archive=f"{root}/archive", as_of=AS_OF, drops="folder")
    return read_facts(spark, wh.facts)


def process_ledger(spark, sf):
    """Two inboxes, each with its own checkpoint, loaded into one
    warehouse: per load its rows, the length of its run date, and its cases with findings."""
    root = work_path(spark, "inboxes")
    wh = Warehouse(f"{root}/wh")
    for batch in ("old", "new"):
        write_extract(testbed.raw_extract(spark, sf, batch), f"{root}/in-{batch}")
        _process_once(spark, f"{root}/in-{batch}", wh, checkpoint=f"{root}/checkpoint-{batch}", as_of=AS_OF, drops="folder")
    ledger = spark.read.format(wh.fmt).load(ledger_path(wh))
    cases = spark.read.format(wh.fmt).load(wh.findings).groupBy("batch").agg(
        F.count_distinct("case_num").alias("cases"))
    return ledger.join(cases, "batch", "left").select(
        "batch_id", "rows", F.length("run_date").alias("run_date_length"), "cases")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "case_extract_scan": case_extract_scan,
    "severity_status_codes": severity_status_codes,
    "case_timestamps": case_timestamps,
    "account_env_ids": account_env_ids,
    "link_tail": link_tail_q,
    "reference_ids": reference_ids,
    "component_issue": component_issue,
    "resolution_minutes": resolution_minutes_q,
    "week_partition": week_partition,
    "dim_new_members": dim_new_members,
    "dim_dense_ids": dim_dense_ids,
    "dim_merge_ids": dim_merge_ids,
    "dim_account_upsert": dim_account_upsert,
    "dim_growth": dim_growth,
    "dim_lookup_default": dim_lookup_default,
    "dim_rewrite_roundtrip": dim_rewrite_roundtrip,
    "fact_normalised": fact_normalised,
    "fact_append_roundtrip": fact_append_roundtrip,
    "fact_overwrite_partitions": fact_overwrite_partitions,
    "touched_partitions": touched_partitions_q,
    "fact_partition_scan": fact_partition_scan,
    "fact_upsert_partitions": fact_upsert_partitions,
    "findings_rules": findings_rules,
    "findings_links": findings_links,
    "findings_report": findings_report_q,
    "findings_case_count": findings_case_count_q,
    "batch_profile": batch_profile_q,
    "audit_duplicate_cases": audit_duplicate_cases,
    "audit_duplicate_facts": audit_duplicate_facts,
    "audit_orphan_cases": audit_orphan_cases,
    "staging_account": staging_account,
    "staging_product": staging_product,
    "automation_bucketed": automation_bucketed,
    "smartsense_bucketed": smartsense_bucketed,
    "process_once": process_once,
    "fact_after_bootstrap": fact_after_bootstrap,
    "malformed_cases": malformed_cases,
    "process_ledger": process_ledger,
}
