"""Headline benchmark: runs catalogue queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line:
{"metric": "total_query_seconds", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Each query is forced completely with the ``noop`` sink (every row computed,
nothing collected to the driver). A warm-up query runs first so JVM start-up
and code generation are not charged to the first headline query.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from caseweek import testbed  # noqa: E402
from caseweek.catalogue import QUERIES  # noqa: E402
from caseweek.operators import code_cases, touched_partitions  # noqa: E402
from caseweek.plans import Warehouse, load_batch, update_batch  # noqa: E402
from caseweek.session import build_session, work_path  # noqa: E402
from caseweek.sources import extract_fields, write_extract  # noqa: E402

HEADLINE = [
    "case_extract_scan",       # delimited extract scan, positional schema
    "fact_normalised",         # coding + dense dimension ids + lookups + week partitions
    "findings_report",         # rules + link findings + per-case message sets
    "dim_merge_ids",           # dimension merge with dense ids after max
    "dim_account_upsert",      # type-1 account upsert
    "week_partition",          # week keys over cases, events and line items
    "audit_duplicate_cases",   # key audit over line items
    "fact_append_roundtrip",   # two weekly loads appended, read back
    "fact_upsert_partitions",  # weekly load then partition upsert, read back
    "process_once",            # file-stream source, two runs, read back
]


class ActionCounter:
    """Counts DataFrame actions (collect, count, checkpoint, writer save) and
    the rows that reach the driver, by wrapping those entry points."""

    def __init__(self, spark):
        frame = type(spark.range(0))              # the runtime DataFrame class
        writer = type(spark.range(0).write)
        self.targets = [(frame, "collect"), (frame, "count"), (frame, "checkpoint"),
                        (writer, "save")]
        self.actions = self.rows = 0
        self.saved = {}

    def __enter__(self):
        for cls, name in self.targets:
            orig = getattr(cls, name)
            self.saved[(cls, name)] = orig

            def wrapped(*a, __orig=orig, __name=name, **k):
                self.actions += 1
                out = __orig(*a, **k)
                if __name == "collect":
                    self.rows += len(out)
                elif __name == "count":
                    self.rows += 1
                return out
            setattr(cls, name, wrapped)
        return self

    def __exit__(self, *exc):
        for (cls, name), orig in self.saved.items():
            setattr(cls, name, orig)


def structure(spark, sf_dir: str) -> dict:
    """Actions, rows returned to the driver and Spark jobs (AQE runs each
    shuffle stage as its own job) of one weekly load and one weekly update,
    and how many week partitions the update rewrites in its single write
    job - to set against BASELINE's counts."""
    sc = spark.sparkContext
    paths = {}
    for b in ("old", "new"):
        paths[b] = work_path(spark, f"bench-{b}")
        write_extract(testbed.raw_extract(spark, sf_dir, b), paths[b])
    wh = Warehouse(work_path(spark, "bench-wh"))
    out = {}
    for key, run in (("jobs_per_weekly_load", lambda: load_batch(spark, paths["old"], wh, as_of=testbed.AS_OF)),
                     ("jobs_per_weekly_update", lambda: update_batch(spark, paths["new"], wh, as_of=testbed.AS_OF))):
        sc.setJobGroup(key, key)
        with ActionCounter(spark) as counter:
            run()
        kind = key.replace("jobs_per_", "")
        out[key] = len(sc.statusTracker().getJobIdsForGroup(key))
        out[f"actions_per_{kind}"] = counter.actions
        out[f"driver_rows_per_{kind}"] = counter.rows
    sc.setJobGroup("bench", "bench")
    new = code_cases(extract_fields(testbed.raw_extract(spark, sf_dir, "new")), testbed.AS_OF)
    out["update_partitions_in_one_write"] = touched_partitions(new).count()
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(f"local[{cpus}]", shuffle_partitions=int(cpus))
    QUERIES["severity_status_codes"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    extra = structure(spark, sf_dir) if not sys.argv[1:] else {}
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times,
                      "sf": float(m.group(1)) if m else sf_dir, "structure": extra}))
    spark.stop()


if __name__ == "__main__":
    main()
