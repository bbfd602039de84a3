"""Load every extract file dropped into an inbox exactly once.

A file-stream source with an ``availableNow`` trigger: each run picks up the
files not yet committed in the checkpoint, loads them through ``load_frame``
in ``foreachBatch`` and archives them. A drop is one file. All files of a
micro-batch are read once and loaded in one pass, with the rows that loading
them one after another, oldest first (then by name), would leave; so the
result doesn't depend on how many files a micro-batch takes. With the
default mode ``upsert`` a later file replaces a case within its week.

Findings, refused rows and ledger rows belong to a drop, named by the
stream's id (which its checkpoint keeps), the micro-batch and the file; two
inboxes, or one with a new checkpoint, never share a name. A micro-batch's
date for cases without open date is stored before it starts. So a
micro-batch replayed after a failure, even in another week, writes the same
rows to the same places instead of adding them twice.
"""

from __future__ import annotations

import datetime as _dt
import threading

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from ..plans.jobs import Warehouse, load_frame, write_ledger
from ..session import path_exists, spread
from ..sinks import write_batch
from ..sources import drop_column, scan_options, with_raw_line


#: The row coding as one generated method is larger than the 8,000 bytes that HotSpot compiles and would be
#: interpreted; beyond the limit Spark runs each projection by itself, in small methods. Set in the stream's own
#: session, not in the caller's.
METHOD_LIMIT = ("spark.sql.codegen.hugeMethodLimit", "8000")
#: Kept rows are stored as serialized batches, and Java's object streams hold on to the last 100 batches that a task
#: writes or reads, outside the memory that Spark counts. With Spark's 10,000 rows a batch that is all rows of a
#: 128 MB split, in plain form, for each task. Also set in the stream's own session.
BATCH_ROWS = ("spark.sql.inMemoryColumnarStorage.batchSize", "500")


def ledger_path(wh: Warehouse) -> str:
    """(batch, query_id, batch_id, file, time, run_date yyyyMMdd, rows) of every drop that was loaded."""
    return wh.ledger


def dates_path(wh: Warehouse) -> str:
    """(batch, as_of) of every micro-batch that was begun."""
    return f"{wh.root}/processed_dates"


def _date_of(spark: SparkSession, wh: Warehouse, label: str, as_of: _dt.date | None) -> _dt.date:
    """The date that the micro-batch began with, stored when it begins first."""
    if path_exists(spark, f"{dates_path(wh)}/batch={label}"):
        stored = spark.read.format(wh.fmt).load(f"{dates_path(wh)}/batch={label}").first()
        if stored:
            return stored["as_of"]
    day = as_of or _dt.date.today()
    write_batch(spark.createDataFrame([(day, label)], "as_of date, batch string"), dates_path(wh), wh.fmt)
    return day


def process_once(spark: SparkSession, inbox: str, wh: Warehouse, *, checkpoint: str,
                 archive: str | None = None, mode: str = "upsert",
                 as_of: _dt.date | None = None, sep: str = ",",
                 max_files_per_trigger: int | None = None, drops: str = "file") -> str:
    """Run one availableNow pass over ``inbox``, wait for it to finish and return the run's id.

    ``max_files_per_trigger`` splits a backlog of drops into several
    micro-batches; the rows are the same for any number. With ``drops="folder"``
    the files of a folder are one drop, and drops are ordered by folder name.
    """
    stream = scan_options(spark.readStream, sep)
    if archive:
        stream = stream.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    if max_files_per_trigger:
        stream = stream.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = stream.csv(inbox).select("*", drop_column(drops))
    started, query_id = threading.Event(), []

    def _load(batch: DataFrame, batch_id: int) -> None:
        started.wait()
        for setting in (METHOD_LIMIT, BATCH_ROWS):
            batch.sparkSession.conf.set(*setting)
        label = f"{query_id[0]}-{batch_id}"
        drops = with_raw_line(spread(batch)).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            load_frame(spark, drops, wh, mode=mode, as_of=_date_of(spark, wh, label, as_of), batch_label=label)
            write_ledger(spark, wh, drops, label, query_id[0], batch_id)
        finally:
            drops.unpersist()

    query = (raw.writeStream.foreachBatch(_load)
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query_id.append(str(query.id))
    started.set()
    query.awaitTermination()
    return str(query.runId)
