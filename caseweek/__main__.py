"""Command line for spark-submit: the weekly load and update jobs.

Each ends with a report: dimension changes, refused rows, and the findings of the load by case.

    spark-submit -m caseweek load   --file EXTRACT --warehouse ROOT [--overwrite]
    python -m caseweek update --file EXTRACT --warehouse ROOT
    python -m caseweek process-once --inbox FOLDER --checkpoint FOLDER --warehouse ROOT [--archive FOLDER]
    python -m caseweek bootstrap --warehouse ROOT [--accounts STAGING] [--products STAGING]

The session comes from ``SparkSession.builder.getOrCreate()``, so the
cluster's own settings (master, shared ``spark.checkpoint.dir``) apply.
Exit status 1 on bad arguments or a failed load.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from pyspark.sql import SparkSession

from pyspark.sql import functions as F

from .operators import findings_case_count, findings_report
from .plans import Warehouse, bootstrap_dimensions, load_batch, register_tables, update_batch
from .session import path_exists
from .streaming import process_once

# Cases listed in the report that a job prints; the findings table has all of them.
REPORT_CASES = 50


def report(spark: SparkSession, wh: Warehouse, batch: str) -> None:
    """Print how many cases of a load have findings, and the first of them with their messages."""
    if not path_exists(spark, wh.findings):
        return
    own = spark.read.format(wh.fmt).load(wh.findings).where(F.col("batch") == batch)
    n = findings_case_count(own).first()
    print(f"load {batch}: {n['cases']} cases with {n['findings']} findings")
    for row in findings_report(own).orderBy("case_num").limit(REPORT_CASES).collect():
        print(f"  {row['case_num']}: {row['messages']}")


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="caseweek")
    ap.add_argument("job", choices=["load", "update", "process-once", "bootstrap"])
    ap.add_argument("--file", help="extract file or folder (load, update)")
    ap.add_argument("--inbox", help="process-once: folder (or glob) of dropped extract files")
    ap.add_argument("--checkpoint", help="process-once: folder that remembers the files already loaded")
    ap.add_argument("--archive", help="process-once: folder that loaded files are moved to")
    ap.add_argument("--table", default="cases", help="name of the fact table")
    ap.add_argument("--accounts", help="bootstrap: $-delimited account staging text")
    ap.add_argument("--products", help="bootstrap: comma-delimited product staging text")
    ap.add_argument("--warehouse", required=True, help="shared warehouse root folder")
    ap.add_argument("--overwrite", action="store_true",
                    help="load: replace the week partitions the batch touches")
    ap.add_argument("--as-of", type=dt.date.fromisoformat, default=None,
                    help="date used for cases without an open date (default: today)")
    ap.add_argument("--sep", default=",")
    ap.add_argument("--format", default="orc")
    ap.add_argument("--once", action="store_true",
                    help="load, update: leave out files that the ledger has, and enter the others in it")
    ap.add_argument("--register", action="store_true", help="also expose the tables in the catalog")
    ap.add_argument("--catalog-prefix", default=None,
                    help="keep the fact table in the catalog as <prefix>cases (partition pruning by the catalog)")
    args = ap.parse_args(argv)
    if args.job in ("load", "update") and not args.file:
        ap.error("--file is required for load and update")
    if args.job == "process-once" and not (args.inbox and args.checkpoint):
        ap.error("--inbox and --checkpoint are required for process-once")

    spark = SparkSession.builder.appName(f"caseweek-{args.job}").getOrCreate()
    wh = Warehouse(args.warehouse, args.format, args.catalog_prefix, args.table)
    try:
        if args.job == "bootstrap":
            bootstrap_dimensions(spark, wh, account_staging=args.accounts, product_staging=args.products)
            print("caseweek bootstrap: done")
            return 0
        if args.job == "process-once":
            process_once(spark, args.inbox, wh, checkpoint=args.checkpoint, archive=args.archive,
                         as_of=args.as_of, sep=args.sep)
            if args.register:
                register_tables(spark, wh, prefix=args.catalog_prefix or "")
            print("caseweek process-once: done")
            return 0
        if args.job == "load":
            res = load_batch(spark, args.file, wh, overwrite=args.overwrite, as_of=args.as_of, sep=args.sep,
                             once=args.once)
        else:
            res = update_batch(spark, args.file, wh, as_of=args.as_of, sep=args.sep, once=args.once)
        if args.register:
            register_tables(spark, wh, prefix=args.catalog_prefix or "")
    except Exception as exc:  # noqa: BLE001 - report and fail the job
        print(f"caseweek {args.job} failed: {exc}", file=sys.stderr)
        return 1
    print(f"caseweek {args.job}: {res.rows} rows, {res.refused} refused, new dimension members {res.added}, "
          f"account changes {res.account_changes}")
    if not args.once:                 # there, each file has a report label of its own
        report(spark, wh, res.batch)
    return 0


if __name__ == "__main__":
    sys.exit(main())
