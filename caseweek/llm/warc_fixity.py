"""WARC records and a Merkle fixity audit of their replicas (operator 5).

Pages become WARC response records in files of a bounded number of records. Over a replica's files a tree
of hashes is built: a record's hash, then the hash of the ordered records of an offset range, of ranges of
ranges up to the file, and of files grouped by name up to one root. Two replicas are compared from their
roots down: a level reads only the children of nodes that differ above it, so an intact replica costs one
comparison and a damaged one the paths to its damage.

A replica is a table (file, offset, payload, record_id): offset is the place of the payload's first byte
in its file, record_id says whose record it is and isn't hashed. Equal rows of a replica count as one; of
different payloads at one place all are hashed, in order of their hashes.

Defined results: a null url or html counts as empty and a null page_id as no id; repeated pages are records
of their own; empty replicas have equal roots; a replica that is empty differs in every record of the
other; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import gzip
import io

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored

#: Records in a file, bytes of the first offset ranges, and ranges (or groups of files) under a node.
FILE_RECORDS = 512
RANGE_BYTES = 1 << 18
FAN_OUT = 16
#: Levels of ranges: the last takes files up to RANGE_BYTES * FAN_OUT ** (RANGE_LEVELS - 1) in one node.
RANGE_LEVELS = 3
#: Levels of file groups, by leading hex digits of the hash of the file's name.
NAME_DIGITS = 4


def record_bytes(record_id: Column, url: Column, html: Column) -> Column:
    """A WARC/1.0 response record as binary."""
    body = F.encode(F.coalesce(html, F.lit("")), "UTF-8")
    head = F.concat(F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"),
                    F.coalesce(record_id.cast("string"), F.lit("")), F.lit(">\r\nWARC-Target-URI: "),
                    F.coalesce(url, F.lit("")), F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
                    F.length(body).cast("string"), F.lit("\r\n\r\n"))
    return F.concat(F.encode(head, "UTF-8"), body, F.encode(F.lit("\r\n\r\n"), "UTF-8"))


def archive(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """The records of ``pages`` as a replica; each task fills files of its own. Store it before use."""

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, n, at = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            files, offsets = [], []
            for size in batch.column("size").to_pylist():
                if n % FILE_RECORDS == 0:
                    at = 0
                files.append(f"part-{task:06d}-{n // FILE_RECORDS:06d}.warc")
                offsets.append(at)
                n, at = n + 1, at + size
            yield pa.record_batch([pa.array(files, pa.string()), pa.array(offsets, pa.int64()),
                                   batch.column("payload"), batch.column("record_id")],
                                  names=["file", "offset", "payload", "record_id"])

    payload = record_bytes(F.col(id_col), F.col(url_col), F.col(html_col))
    rows = pages.select(F.col(id_col).alias("record_id"), payload.alias("payload"))
    rows = rows.select("record_id", "payload", F.length("payload").cast("long").alias("size"))
    return rows.mapInArrow(placed, f"file string, offset long, payload binary, record_id {rows.dtypes[0][1]}")


def split_records(data: bytes) -> list[tuple[int, bytes]]:
    """(offset, payload) of the records of an uncompressed WARC file.

    A record ends after its content and two line ends; bytes that are no record go with what follows
    them up to the next record's start, so that damage to a header can't hide anything.
    """
    found, at = [], 0
    while at < len(data):
        head_end = data.find(b"\r\n\r\n", at)
        length = None
        if data.startswith(b"WARC/", at) and head_end >= 0:
            for line in data[at:head_end].split(b"\r\n"):
                name, _, value = line.partition(b":")
                if name.strip().lower() == b"content-length" and value.strip().isdigit():
                    length = int(value)
        end = head_end + 4 + length + 4 if length is not None else -1
        if end < 0 or end > len(data) or data[end - 4:end] != b"\r\n\r\n":
            end = data.find(b"WARC/1.", at + 1)
            end = len(data) if end < 0 else end
        found.append((at, data[at:end]))
        at = end
    return found


def read_warc(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """WARC files, plain or gzip-compressed, as a replica (offsets are those of the plain bytes).

    A file is read as a whole by one task, as ``binaryFile`` does, so it must fit in its memory.
    """

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
                if content[:2] == b"\x1f\x8b":
                    content = gzip.GzipFile(fileobj=io.BytesIO(content)).read()
                rows = split_records(content)
                yield pa.record_batch([pa.array([path.rsplit("/", 1)[-1]] * len(rows), pa.string()),
                                       pa.array([o for o, _ in rows], pa.int64()),
                                       pa.array([p for _, p in rows], pa.binary()),
                                       pa.nulls(len(rows), pa.int64())],
                                      names=["file", "offset", "payload", "record_id"])

    files = spark.read.format("binaryFile").load(paths).select("path", "content")
    return files.mapInArrow(parsed, "file string, offset long, payload binary, record_id long")


class FixityTree:
    """Levels of nodes (node, parent, order, digest), each stored; level 0 are records, the last the root."""

    def __init__(self, replica: DataFrame):
        leaves = replica.select("file", "offset", F.length("payload").cast("long").alias("length"),
                                F.sha2("payload", 256).alias("digest"), "record_id").dropDuplicates()
        self.records = stored(leaves.withColumn("parent", self._range(1)), "fixity-records")
        self.levels = []
        below = self.records.select(F.col("parent").alias("node"), F.concat_ws(
            ":", F.lpad(F.col("offset").cast("string"), 20, "0"), "length", "digest").alias("child"), "file", "offset")
        for k in range(1, RANGE_LEVELS + 1):
            above = self._range(k + 1) if k < RANGE_LEVELS else F.col("file")
            below = self._level(below, above, True)
        for k in range(NAME_DIGITS, -1, -1):
            below = self._level(below, F.substring(F.md5("file"), 1, k), False)
        self._level(below, F.lit(None).cast("string"), False)

    @staticmethod
    def _range(level: int) -> Column:
        width = RANGE_BYTES * FAN_OUT ** (level - 1)
        return F.concat_ws("|", "file", F.lit(level).cast("string"),
                           F.lpad(F.floor(F.col("offset") / width).cast("string"), 20, "0"))

    def _level(self, children: DataFrame, parent: Column, in_file: bool) -> DataFrame:
        """Hash the children of each node, in order; the nodes as children of the next level."""
        nodes = children.groupBy("node").agg(
            F.sha2(F.concat_ws("\n", F.array_sort(F.collect_list("child"))), 256).alias("digest"),
            F.min("file").alias("file"), F.min("offset").alias("offset"))
        nodes = stored(nodes.withColumn("parent", parent), f"fixity-level{len(self.levels) + 1}")
        self.levels.append(nodes)
        return nodes.select(F.col("parent").alias("node"), F.concat_ws(":", "node", "digest").alias("child"),
                            "file", "offset")

    def root(self) -> str | None:
        """The root's digest; None for an empty replica."""
        row = self.levels[-1].select("digest").first()
        return row["digest"] if row else None


def _differing(a: DataFrame, b: DataFrame, keys: list[str], within: DataFrame | None) -> DataFrame:
    """Nodes (keys and both digests) whose digests differ, among the children of ``within``."""
    if within is not None:
        a, b = (x.join(within, "parent", "left_semi") for x in (a, b))
    a = a.select(*keys, F.col("digest").alias("digest_a"))
    b = b.select(*keys, F.col("digest").alias("digest_b"))
    return a.join(b, keys, "full").filter(~F.col("digest_a").eqNullSafe(F.col("digest_b")))


def audit(a: FixityTree, b: FixityTree) -> DataFrame:
    """(file, offset, status, digest_a, digest_b) of the records where two replicas differ.

    status: ``changed``, ``missing`` (from b) or ``extra`` (in b).
    """
    frontier = None
    for above, below in zip(reversed(a.levels), reversed(b.levels), strict=True):
        if frontier is None and a.root() == b.root():
            frontier = above.select(F.col("node").alias("parent")).limit(0)
            break
        differing = _differing(above, below, ["node"], frontier)
        frontier = stored(differing.select(F.col("node").alias("parent")), "fixity-frontier")
    found = _differing(a.records, b.records, ["file", "offset"], frontier)
    status = (F.when(F.col("digest_b").isNull(), "missing").when(F.col("digest_a").isNull(), "extra")
              .otherwise("changed"))
    return found.select("file", "offset", status.alias("status"), "digest_a", "digest_b")
