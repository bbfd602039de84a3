"""Stand-in weekly extracts built from the driver's test tables.

This module only *makes input*: rows in the extract's 18-column layout, one
case per order (``orders`` joined with ``customer``), with texts in the shapes
the jobs must handle (both timestamp layouts, malformed links, blank ids,
...). The jobs never look at how these rows were made.

Two follow-up batches are cut by order date, not by id: the *old* batch has
the cases opened before ``OLD_BEFORE``; the *new* batch has those opened from
``NEW_FROM`` on (so the half-year in between is sent again) and is a later
extract: accounts carry renamed names, two more stack releases and one more
Ambari release appear, and open cases are now closed.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .session import spread

LINK_BASE = "https://issues.example.org/browse/"
ROOT_CAUSES = ["Undetermined at this time", "Working as Designed", "Use Case Advice",
               "Documentation Defect", "System Limitation", "No Customer Response",
               "Product Defect", "Configuration"]
SEVERITY_TEXTS = ["S1 - Production Down", "S2 - Core Feature Inoperative",
                  "S3 - Minor Feature Inoperative", "S4 - Request for Information"]
OLD_BEFORE = _dt.date(1999, 1, 1)
NEW_FROM = _dt.date(1998, 7, 1)
AS_OF = _dt.date(2017, 7, 1)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _cases(choices: list[tuple[Column, Column]]) -> Column:
    out = None
    for cond, val in choices:
        out = F.when(cond, val) if out is None else out.when(cond, val)
    return out


def _s(c: Column) -> Column:
    return c.cast("string")


def _raw_extract(orders: DataFrame, customer: DataFrame, revised: bool) -> DataFrame:
    j = orders.join(customer, orders["o_custkey"] == customer["c_custkey"])
    k = F.col("o_orderkey")
    status = F.col("o_orderstatus")
    opened = F.col("o_orderdate")
    base = F.lit(LINK_BASE)
    comp = F.col("c_mktsegment")
    first = F.substring("o_orderpriority", 1, 1)
    severity = _cases([(first == F.lit(str(i + 1)), F.lit(t)) for i, t in enumerate(SEVERITY_TEXTS)]
                      + [(first == F.lit("5"), F.lit("other"))])
    open_status = F.lit("Closed") if revised else F.lit("Open")
    status_txt = _cases([
        (status == "F", F.when(k % 2 == 0, F.lit("CLOSED")).otherwise(F.lit("Closed"))),
        (status == "O", open_status), (status == "P", F.lit("Pending"))])
    compact = F.date_format(opened, "yyyyMMdd HHmmss")
    slashed = F.date_format(opened, "M/d/yy H:mm")
    date_open = _cases([(k % 3 == 0, F.concat(compact, F.lit(".000"))), (k % 3 == 1, slashed),
                        (k % 17 == 0, F.lit("n/a"))]).otherwise(compact)
    date_close = F.when(status == "F",
                        F.date_format(opened + F.expr("INTERVAL 3 DAYS"), "M/d/yy H:mm"))
    account = F.concat(F.col("c_name"), F.lit(" Ltd")) if revised else F.col("c_name")
    account_id = (F.when(k % 211 == 0, F.lit(""))
                  .when(k % 223 == 0, F.concat(F.lit("CUST- "), _s(F.col("o_custkey"))))
                  .otherwise(F.concat(F.lit("CUST-"), _s(F.col("o_custkey")))))
    ambari_mod = 6 if revised else 5
    stack_mod = 9 if revised else 7
    ambari = F.when(k % 4 != 0, F.concat(F.lit("2."), _s(k % ambari_mod)))
    stack = F.concat(F.lit("2.6."), _s(k % stack_mod))
    h_bug = _cases([(k % 5 == 0, F.concat(base, F.lit("bug-"), _s(k), F.lit(";"))),
                    (k % 5 == 1, F.lit("nolink")),
                    (k % 5 == 2, F.concat(base, F.lit("BUG-x"), _s(k)))])
    a_bug = _cases([(k % 6 == 0, F.concat(base, comp, F.lit("-"), _s(k))),
                    (k % 6 == 1, F.concat(base, F.lit("OTHER-"), _s(k))),
                    (k % 6 == 2, F.concat(base, _s(k)))])
    hotfix = _cases([(k % 7 == 0, F.concat(base, F.lit("HOTFIX-"), _s(k), F.lit("/"))),
                     (k % 7 == 1, F.concat(base, F.lit("HF-"), _s(k)))])
    ear = _cases([(k % 11 == 0, F.concat(base, F.lit("EAR-"), _s(k))), (k % 11 == 1, F.lit("a-b/c"))])
    rmp = _cases([(k % 9 == 0, F.concat(base, F.lit("RMP-"), _s(k))), (k % 9 == 1, F.lit("x-1"))])
    rootcause = _cases([(k % 8 == i, F.lit(rc)) for i, rc in enumerate(ROOT_CAUSES)])
    env = F.when(k % 13 != 0, F.concat(F.lit("ENV-"), _s(k % 5)))
    resolution = F.when(status == "F", F.concat(_s(k % 10), F.lit(" days "), _s(k % 24),
                                                F.lit(" hours"), _s(k % 60), F.lit(" mn")))
    return j.select(
        severity.alias("Severity"), account_id.alias("Customer Record ID"),
        account.alias("Account Name"), k.cast("int").alias("Case Number"),
        status_txt.alias("Status"), date_open.alias("Date/Time Opened"),
        date_close.alias("Date/Time Closed"), resolution.alias("Resolution Time"),
        ambari.alias("Ambari Version"), stack.alias("Stack Version"),
        comp.alias("Product Component"), a_bug.alias("Apache BugID URL"),
        h_bug.alias("Internal BugID URL"), hotfix.alias("HOTFIX BugID URL"),
        ear.alias("EAR URL"), rootcause.alias("Root Cause"),
        rmp.alias("Enhancement Request Number"), env.alias("Environment"))


def raw_extract(spark: SparkSession, sf_dir: str, batch: str = "all") -> DataFrame:
    """Header-named extract rows: ``batch`` is ``all``, ``old`` or ``new``."""
    orders = spread(table(spark, sf_dir, "orders"))
    if batch == "old":
        orders = orders.where(F.col("o_orderdate") < F.lit(OLD_BEFORE))
    elif batch == "new":
        orders = orders.where(F.col("o_orderdate") >= F.lit(NEW_FROM))
    elif batch != "all":
        raise ValueError(batch)
    customer = table(spark, sf_dir, "customer")
    return _raw_extract(orders, customer, revised=(batch == "new"))


def side_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Automation-style side rows from ``events``; the case number is twice
    the event id, so only some of them point at an existing case."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        (F.col("event_id") * 2).cast("int").alias("CaseNum"),
        F.concat(F.lit("user-"), _s(F.col("user_id"))).alias("Case_Owner"),
        F.col("event_type").alias("Description"),
        (F.col("value") > F.lit(50.0)).alias("Actionable"),
        F.col("props").alias("JIRA"),
        F.col("event_type").alias("status"))


def smartsense_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SmartSense-style rows from ``events``; priority 1-4 by hour of day."""
    ev = table(spark, sf_dir, "events")
    return ev.select(
        (F.col("event_id") * 2).cast("int").alias("CaseNum"),
        F.col("event_type").alias("Existing_Rule"),
        F.col("props").alias("Suggestion"),
        F.concat(F.lit("user-"), _s(F.col("user_id"))).alias("Suggestion_Owner"),
        F.lit(None).cast("string").alias("Reviewed_By"),
        F.concat(F.lit("EV-"), _s(F.col("event_id"))).alias("JIRA"),
        F.col("event_type").alias("status"),
        (F.floor(F.hour("ts") / 6) + 1).cast("int").alias("Priority"))
