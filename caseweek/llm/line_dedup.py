"""Removing lines that many documents share, by levelled sorted runs of line hashes (operator 8).

Documents come in batches. A batch becomes one run: for each line hash the number of documents with it
and the largest id among them, sorted by hash. It is merge-joined with the runs there are: an anti-join
gives the lines never seen before, the rest are repeats, and both are marked so in the run that is added. Runs
are bucketed tables with sorted buckets, so these joins read them as they lie, without a shuffle or sort.
A fresh line starts its count there; only repeats are added up, and added to the count that was started.
Runs live in levels; when a level has as many as its fan-out they are merged into one run of the next,
so there are only a logarithm of the batches to join with. Lines whose counts over all runs reach the
limit lose their places, except in the document with the largest id among their holders.

Lines are compared by 128-bit hashes of their keys. A document is a row: rows that share an id count
each, and all rows with the keeping id keep the line.

Defined results: a null or empty text is one empty line; a null id is below all ids, and where no holder
has an id all keep the line; repeated rows each give a row; an empty table gives no rows; extra columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import work_path
from .common import stored

#: ASCII white space, stripped from keys (fixed values).
BLANKS = b" \t\n\x0b\x0c\r"
#: Runs of a level that are merged into one of the next.
FAN_OUT = 3
#: Buckets that Spark allows a table (its default); a run has as many as the session has shuffle partitions.
MOST_BUCKETS = 100_000
#: Entries that four batches are for; each doubling adds one.
FOUR_BATCHES = 4_000_000
#: Rows handled at a time.
ROWS = 256


def line_key(line: bytes) -> bytes:
    """A line without white space at its ends, A-Z in lower case."""
    return line.strip(BLANKS).lower()


def _signed(h: int) -> int:
    return h - (h >> 63 << 64)


def _entries(least_chars: int):
    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, ROWS):
                part = batch.slice(i, ROWS)
                doc, h1, h2, places = [], [], [], []
                for d, text in enumerate(part.column("text").to_pylist()):
                    found: dict[int, list[int]] = {}
                    for at, line in enumerate((text or "").encode("utf-8", "surrogatepass").split(b"\n")):
                        key = line_key(line)
                        if len(key) >= least_chars and len(key.decode("utf-8", "surrogatepass")) >= least_chars:
                            found.setdefault(xxhash.xxh3_128_intdigest(key), []).append(at)
                    for h, own in found.items():
                        doc.append(d)
                        h1.append(_signed(h >> 64))
                        h2.append(_signed(h & (1 << 64) - 1))
                        places.append(own)
                at = pa.array(doc, pa.int64())
                yield pa.record_batch([part.column("id").take(at), part.column("digest").take(at),
                                       pa.array(h1, pa.int64()), pa.array(h2, pa.int64()),
                                       pa.array(places, pa.list_(pa.int32()))],
                                      names=["id", "digest", "h1", "h2", "places"])

    return entries


class LevelledRuns:
    """Runs (h1, h2, n, top, fresh) by level, as tables bucketed by hash and sorted inside each bucket.

    All runs have as many buckets, one sorted file each, so joins and merges of runs read bucket beside bucket: nothing
    is shuffled or sorted again but a new batch, once. The tables live in the shared folder; ``drop`` takes their names
    out of the catalog. They are read in a session of their own (with the settings of the batches' session), where
    Spark may rely on the order inside the files.
    """

    def __init__(self, fan_out: int = FAN_OUT):
        self.fan_out, self.levels, self.tables, self.session, self.buckets = fan_out, [[]], [], None, 0

    def runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def add(self, batch: DataFrame) -> DataFrame:
        """Add a batch of (id, h1, h2), one row for each document and line; its run, with what is fresh."""
        if self.session is None:
            self._begin(batch.sparkSession)
        counted = batch.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("top"))
        if not self.runs():
            run = self._sorted(counted.withColumn("fresh", F.lit(True)), "run")
        else:
            known = self._sorted(counted, "batch")
            run = self._sorted(self._marked(known), "run")
        level = 0
        self.levels[0].append(run)
        while len(self.levels[level]) >= self.fan_out:
            merged = self._sorted(self._merged(self.levels[level]), "run")
            self.levels[level] = []
            level += 1
            if level == len(self.levels):
                self.levels.append([])
            self.levels[level].append(merged)
        return run

    def common(self, least_docs: int) -> DataFrame:
        """(h1, h2, top) of the lines that at least so many documents hold."""
        union = self._union(self.runs())
        # A line is fresh in one run, where its count starts; only what the other runs repeat is added up.
        begun = union.filter("fresh").select("h1", "h2", "n", "top")
        more = union.filter(~F.col("fresh")).groupBy("h1", "h2").agg(F.sum("n").alias("more"),
                                                                     F.max("top").alias("more_top"))
        total = begun.join(more.hint("merge"), ["h1", "h2"], "left")
        return (total.filter(F.col("n") + F.coalesce("more", F.lit(0)) >= least_docs)
                .select("h1", "h2", F.greatest("top", "more_top").alias("top")))

    def drop(self) -> None:
        """Take the runs' tables out of the catalog; their files stay with the application's working tables."""
        for table in self.tables:
            self.session.sql(f"DROP TABLE IF EXISTS {table}")
        self.tables = []

    def _begin(self, spark: SparkSession) -> None:
        self.buckets = min(int(spark.conf.get("spark.sql.shuffle.partitions")), MOST_BUCKETS)
        self.session = spark.newSession()
        for name, value in spark.conf.getAll.items():
            if spark.conf.isModifiable(name):
                self.session.conf.set(name, value)
        # A bucket is one file here; where it is not, Spark sorts it again.
        self.session.conf.set("spark.sql.legacy.bucketedTableScan.outputOrdering", "true")
        # All runs are read by their buckets, whatever is asked of them.
        self.session.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")

    def _marked(self, batch: DataFrame) -> DataFrame:
        """The batch's lines, those marked that no run holds."""
        fresh = batch.select("h1", "h2")
        for known in self.runs():
            fresh = fresh.join(known.select("h1", "h2").hint("merge"), ["h1", "h2"], "left_anti")
        marked = batch.join(fresh.withColumn("fresh", F.lit(True)).hint("merge"), ["h1", "h2"], "left")
        return marked.select("h1", "h2", "n", "top", F.coalesce("fresh", F.lit(False)).alias("fresh"))

    @staticmethod
    def _union(runs: list[DataFrame]) -> DataFrame:
        union = runs[0]
        for run in runs[1:]:
            union = union.unionAll(run)
        return union

    @classmethod
    def _merged(cls, runs: list[DataFrame]) -> DataFrame:
        return cls._union(runs).groupBy("h1", "h2").agg(F.sum("n").alias("n"), F.max("top").alias("top"),
                                                        F.max("fresh").alias("fresh"))

    def _sorted(self, rows: DataFrame, label: str) -> DataFrame:
        """``rows``, whose tasks hold whole buckets, as a table of sorted buckets."""
        path = work_path(rows.sparkSession, f"lines-{label}")
        table = "caseweek_" + path.rsplit("/", 1)[1].replace("-", "_")
        self.tables.append(table)
        (rows.write.format("parquet").option("compression", "zstd").option("path", path)
         .bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2").saveAsTable(table))
        return self.session.table(table)


def _rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, batch.num_rows, ROWS):
            part = batch.slice(i, ROWS)
            texts, n_lines, n_dropped = [], [], []
            for text, places in zip(part.column("text").to_pylist(), part.column("dropped").to_pylist(), strict=True):
                lines, gone = (text or "").split("\n"), set(places or ())
                texts.append("\n".join([x for k, x in enumerate(lines) if k not in gone]) if gone else text or "")
                n_lines.append(len(lines))
                n_dropped.append(len(gone))
            yield pa.record_batch([part.column("id"), pa.array(texts, pa.string()), pa.array(n_lines, pa.int64()),
                                   pa.array(n_dropped, pa.int64())], names=["id", "text", "n_lines", "n_dropped"])


def batches_for(entries: int) -> int:
    """Batches that so many entries are dealt into: they grow with the logarithm of the entries, as the levels do."""
    return 4 + max(0, (entries // FOUR_BATCHES).bit_length())


def drop_common_lines(docs: DataFrame, least_docs: int = 3, least_chars: int = 20, batches: int | None = None,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, n_lines, n_dropped) of every row: its text without the lines it loses.

    ``batches`` (by default from the number of entries) only cuts the work; the result is the same for any number.
    A batch is a set of the files that hold the entries, so each entry is read once on its way into a run.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("digest"), text.alias("text"))
    kind = rows.dtypes[0][1]
    entries = stored(rows.mapInArrow(_entries(least_chars),
                                     f"id {kind}, digest long, h1 long, h2 long, places array<int>"), "lines-entries")
    files, runs = sorted(unquote(f) for f in entries.inputFiles()), LevelledRuns()
    batches = max(1, min(batches or batches_for(entries.count()), len(files)))
    reader = docs.sparkSession.read.schema(entries.schema)
    for k in range(batches):
        batch = reader.parquet(*files[k::batches]) if files else entries
        runs.add(batch.select("id", "h1", "h2"))
    common = stored(runs.common(least_docs), "lines-common")
    runs.drop()
    losing = entries.join(common, ["h1", "h2"]).filter(~F.coalesce(F.col("id") == F.col("top"), F.col("top").isNull()))
    # Rows alike in id and text lose the same lines, so one list serves them all.
    dropped = stored(losing.groupBy("id", "digest").agg(F.array_distinct(F.flatten(F.collect_list("places")))
                                                        .alias("dropped")), "lines-dropped")
    dropped = dropped.select(F.col("id").alias("own_id"), F.col("digest").alias("own_digest"), "dropped")
    # A sort-merge join for any number of lists, so that the plan is the same at every size.
    joined = rows.join(dropped.hint("merge"), F.col("id").eqNullSafe(F.col("own_id")) & (F.col("digest") == F.col("own_digest")),
                       "left").select("id", "text", "dropped")
    return joined.mapInArrow(_rewrite, f"id {kind}, text string, n_lines long, n_dropped long").select(
        F.col("id").alias(id_col), F.col("text").alias(text_col), "n_lines", "n_dropped")
