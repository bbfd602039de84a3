"""Exact deduplication by recursive Grace hashing (operator 3).

Each scan task first folds equal texts among its own rows, so a text that a third of all rows hold
leaves a task once. The rows go to a table in the shared folder, a text only on the one row of each fold
that may stay. These folds are then dealt to buckets by a hash of the text. A bucket's task keeps an
open-addressing table that compares complete texts; once the table holds its share of bytes it takes no
new texts, and folds whose text it doesn't hold go to spill files, which the next level deals out by
other bits of the hash, until nothing spills. Hashes only choose buckets and slots.

Defined results: a null text counts as empty, and empty texts are equal; the row with the largest id
stays (null below all ids), of rows that tie one stays; every row gives one row; other columns are kept
with the rows that stay and may have any names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

#: Bytes of text that a scan task folds together, and that a bucket's table holds.
FOLD_BYTES = 32 << 20
TABLE_BYTES = 32 << 20
#: Mean bytes of text dealt to a bucket.
BUCKET_BYTES = 16 << 20


class TextTable:
    """Open addressing with linear probing; equality is that of the complete texts."""

    def __init__(self):
        self.texts: list[str] = []
        self.hashes: list[int] = []
        self.slots = [-1] * 1024
        self.bytes = 0

    def find(self, h: int, text: str) -> tuple[int, int]:
        """(entry or -1, slot) of a text."""
        mask = len(self.slots) - 1
        slot = h & mask
        while (entry := self.slots[slot]) >= 0:
            if self.hashes[entry] == h and self.texts[entry] == text:
                return entry, slot
            slot = (slot + 1) & mask
        return -1, slot

    def add(self, h: int, text: str, slot: int) -> int:
        """Put a text that find() didn't find into its slot."""
        self.slots[slot] = entry = len(self.texts)
        self.texts.append(text)
        self.hashes.append(h)
        self.bytes += len(text.encode("utf-8", "surrogatepass"))
        if 2 * len(self.texts) > len(self.slots):
            self.slots = [-1] * (2 * len(self.slots))
            mask = len(self.slots) - 1
            for e, known in enumerate(self.hashes):
                at = known & mask
                while self.slots[at] >= 0:
                    at = (at + 1) & mask
                self.slots[at] = e
        return entry


def text_hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass"))


def _folded(table: pa.Table, first: int) -> pa.Table:
    """One fold: rows numbered from ``first``, the text and its hash only on the row that may stay."""
    texts, ids = table["text"].to_pylist(), table["id"].to_pylist()
    known, best, entries = TextTable(), [], []
    for i, text in enumerate(texts):
        h = text_hash(text)
        entry, slot = known.find(h, text)
        if entry < 0:
            entry = known.add(h, text, slot)
            best.append(i)
        elif ids[i] is not None and (ids[best[entry]] is None or ids[i] > ids[best[entry]]):
            best[entry] = i
        entries.append(entry)
    leader = [best[e] == i for i, e in enumerate(entries)]
    signed = [known.hashes[e] - (known.hashes[e] >> 63 << 64) for e in entries]
    counts = [0] * len(best)
    for e in entries:
        counts[e] += 1
    return pa.table({
        "id": table["id"], "other": table["other"],
        "row": pa.array(range(first, first + len(texts)), pa.int64()),
        "fold": pa.array([first + best[e] for e in entries], pa.int64()),
        "copies": pa.array([counts[e] if lead else None for e, lead in zip(entries, leader, strict=True)], pa.int64()),
        "hash": pa.array([h if lead else None for h, lead in zip(signed, leader, strict=True)], pa.int64()),
        "text": pa.array([t if lead else None for t, lead in zip(texts, leader, strict=True)], table["text"].type),
    })


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 36  # rows of a task
    held, size = [], 0

    def flushed():
        nonlocal number
        if held:
            table = _folded(pa.Table.from_batches(held), number)
            number += table.num_rows
            yield from table.to_batches(max_chunksize=2000)
        held.clear()

    for batch in batches:
        for i in range(0, batch.num_rows, 500):
            part = batch.slice(i, 500)
            held.append(part)
            size += part.get_total_buffer_size() * part.num_rows // max(1, batch.num_rows)
            if size >= FOLD_BYTES:
                yield from flushed()
                size = 0
    yield from flushed()


def _bucketed(table_bytes: int):
    def deduplicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, classes, digests = TextTable(), [], []
        for batch in batches:
            rows = {c: batch.column(c).to_pylist() for c in ("fold", "id", "copies", "hash", "text")}
            out = {"fold": rows["fold"], "id": rows["id"], "copies": rows["copies"], "hash": rows["hash"],
                   "class": [], "text_sha256": [], "text": []}
            for fold, h, text in zip(rows["fold"], rows["hash"], rows["text"], strict=True):
                entry, slot = known.find(h & (1 << 64) - 1, text)
                if entry < 0 and (known.bytes < table_bytes or not known.texts):
                    entry = known.add(h & (1 << 64) - 1, text, slot)
                    classes.append(fold)
                    digests.append(hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest())
                spilled = entry < 0
                out["class"].append(None if spilled else classes[entry])
                out["text_sha256"].append(None if spilled else digests[entry])
                out["text"].append(text if spilled else None)
            yield pa.record_batch([pa.array(v, t) for v, t in zip(out.values(), (
                pa.int64(), batch.schema.field("id").type, pa.int64(), pa.int64(), pa.int64(), pa.string(),
                pa.string()), strict=True)], names=list(out))

    return deduplicate


def _classes(folds: DataFrame, id_type: str, table_bytes: int, bucket_bytes: int) -> DataFrame:
    """(fold, id, copies, class, text_sha256) of every fold, by as many levels of spill files as it takes."""
    schema = f"fold long, id {id_type}, copies long, hash long, class long, text_sha256 string, text string"
    done, level, pending = None, 0, folds.select("fold", "id", "copies", "hash", "text")
    while True:
        size = pending.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("b")).first()["b"]
        least = int(pending.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        buckets = max(least, -(-size // bucket_bytes))
        dealt = pending.repartition(buckets, F.xxhash64("hash", F.lit(level)))
        found = stored(dealt.mapInArrow(_bucketed(table_bytes), schema), f"dedup-level{level}")
        resolved = found.filter(F.col("class").isNotNull()).drop("hash", "text")
        done = resolved if done is None else done.unionAll(resolved)
        pending = found.filter(F.col("class").isNull()).select("fold", "id", "copies", "hash", "text")
        level += 1
        if pending.isEmpty():
            return done


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                table_bytes: int = TABLE_BYTES, bucket_bytes: int = BUCKET_BYTES,
                carry: bool = True) -> tuple[DataFrame, DataFrame]:
    """(verdicts, kept rows).

    Verdicts: (id, keep_id, group_size, kept, text_sha256) of every row. Kept rows: ``docs`` without the
    rows that equal one that stays; ``carry=False`` leaves them out of the work and returns None.
    """
    others = [c for c in docs.columns if c not in (id_col, text_col)] if carry else []
    other = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(others)], F.lit(0).alias("none"))
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                       F.col(text_col).isNull().alias("was_null"), other.alias("other"))
    rows = rows.select("id", "text", F.struct("was_null", "other").alias("other"))
    kinds = dict(rows.dtypes)
    folds = stored(rows.mapInArrow(_fold, f"id {kinds['id']}, other {kinds['other']}, row long, fold long, "
                                          "copies long, hash long, text string"), "dedup-folds")
    classed = _classes(folds.filter(F.col("copies").isNotNull()), kinds["id"], table_bytes, bucket_bytes)
    classed = classed.select("fold", "id", "copies", "class", "text_sha256")
    groups = stored(classed.groupBy("class").agg(
        F.max(F.struct("id", "fold")).alias("stays"), F.sum("copies").alias("group_size")), "dedup-groups")
    verdict = stored(classed.join(groups, "class").select(
        "fold", F.col("stays.id").alias("keep_id"), F.col("stays.fold").alias("keep_row"), "group_size",
        "text_sha256"), "dedup-verdicts")
    verdicts = folds.select("id", "row", "fold").join(verdict, "fold").select(
        F.col("id").alias(id_col), "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"),
        "text_sha256")
    if not carry:
        return verdicts, None
    staying = folds.filter(F.col("copies").isNotNull()).join(
        verdict.filter(F.col("fold") == F.col("keep_row")).select(F.col("keep_row").alias("row")), "row", "left_semi")
    columns = {id_col: F.col("id"),
               text_col: F.when(F.col("other.was_null"), F.lit(None)).otherwise(F.col("text"))}
    columns |= {c: F.col(f"other.other.c{i}") for i, c in enumerate(others)}
    return verdicts, staying.select(*[columns[c].alias(c) for c in docs.columns])
