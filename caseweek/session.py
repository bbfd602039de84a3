"""Session defaults, the shared work folder and size-checked broadcasts."""

from __future__ import annotations

import tempfile
import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Sides above this many rows or bytes are joined without a broadcast hint; the
# planner (sort-merge join, AQE skew handling) takes over beyond the bounds.
BROADCAST_MAX_ROWS = 2_000_000
BROADCAST_MAX_BYTES = 64 << 20


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app: str = "caseweek") -> SparkSession:
    """A session with AQE on, UI off and a UTC clock (tests, bench, CLI)."""
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        # delete reliable checkpoints once their DataFrames are garbage-collected
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    shared_root(spark)
    return spark


def is_local(master: str) -> bool:
    """Whether driver and executors are one process."""
    return master == "local" or master.startswith("local[")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists in the file system its path names."""
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(found)


def shared_root(spark: SparkSession) -> str:
    """The cluster-shared folder named by ``spark.checkpoint.dir``.

    The session's setting wins. Only when it is unset on a local master (a
    test or a laptop run) is a private temporary folder created and
    installed as the checkpoint directory; a cluster, whose executors could
    not see it, must name a shared folder.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        current = sc.getCheckpointDir()
        if current:
            root = current.rstrip("/").rsplit("/", 1)[0]
    if not root:
        if not is_local(sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="caseweek-")
        sc.setCheckpointDir(root)
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def _work_root(spark: SparkSession) -> str:
    return f"{shared_root(spark)}/caseweek-work"


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh, unique folder under the shared root for one job's tables, among those of this application."""
    return f"{_work_root(spark)}/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex[:12]}"


def clear_work(spark: SparkSession, others_older_than_hours: float | None = None) -> int:
    """Delete the working tables of this application, once its results have been read or written elsewhere; with
    an age also those that other applications left behind and added nothing to for that long. How many
    applications' folders went."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_work_root(spark))
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(root):
        return 0
    gone = 0
    for status in files.listStatus(root):
        own = status.getPath().getName() == spark.sparkContext.applicationId
        old = (others_older_than_hours is not None
               and status.getModificationTime() <= (time.time() - 3600 * others_older_than_hours) * 1000)
        if own or old:
            files.delete(status.getPath(), True)
            gone += 1
    return gone


def pin(df: DataFrame) -> DataFrame:
    """Materialise ``df`` to the reliable checkpoint folder and cut lineage.

    Used where a plan must be evaluated exactly once (range-partition
    samples, ids) or where its source is about to be overwritten.
    """
    shared_root(df.sparkSession)
    return df.checkpoint(eager=True)


def row_bytes(df: DataFrame) -> Column:
    """Bytes that a row takes in memory, about: the lengths of its texts, eight for any other value and for
    each row's own upkeep."""
    fixed = F.lit(8 * (len(df.columns) + 1)).cast("long")
    texts = [F.coalesce(F.octet_length(F.col(f"`{name}`")), F.lit(0)).cast("long")
             for name, kind in df.dtypes if kind in ("string", "binary")]
    return sum(texts, fixed)


def within_bounds(rows: int, size: int, max_rows: int = BROADCAST_MAX_ROWS,
                  max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """Whether a side of so many rows and bytes may be broadcast."""
    return rows <= max_rows and size <= max_bytes


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """Count the rows and bytes of ``df`` (one aggregate) and say whether both are within bounds."""
    size = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(row_bytes(df)), F.lit(0)).alias("bytes")).first()
    return within_bounds(size["n"], size["bytes"], max_rows, max_bytes)


def spread(scan: DataFrame) -> DataFrame:
    """Round-robin a plain file scan that yields fewer partitions than the
    cluster has cores (one small extract file is one split), so the
    CPU-heavy row coding runs as one full wave of tasks. The count is
    explicit on purpose: AQE would size the partitions by bytes, and a few
    megabytes of text would collapse onto a couple of tasks although the
    regex work per byte is high. A large input already splits into at least
    as many partitions as there are cores and is returned unchanged (no
    shuffle). Call it on scans only: counting partitions of a scan plans it
    but runs nothing.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan
