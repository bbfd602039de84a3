"""Packing tokenised documents into sequences by linear grouping and best fit (operator 6).

Lengths are whole numbers up to the sequence length, so a count by length (bounded by the sequence
length, whatever the corpus) holds all that the packing needs. The plan is made from it on the driver:

1. Large lengths are sorted and cut into groups of equal cardinality; each is rounded up to the largest
   length of its group.
2. A linear program over configurations (how many of each rounded length one sequence holds) is solved
   by column generation and rounded down.
3. Real documents, always shorter or equal, take the places of the rounded ones, group by group.
4. Whatever is left, the small ones last, goes by best fit, longest first, into the gaps and then into
   new sequences.

Documents of equal length are interchangeable, so the plan speaks of runs: the documents ``first`` to
``first + count`` of a length go to consecutive sequences at the same offset. Tasks number their
documents of each length; a task's numbers and the counts of the tasks before it give the documents'
places in the plan.

Defined results: a null or empty text is a document of the end token only; every row is packed,
repeated rows and null ids too; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import bisect
import functools
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .byte_level import plain_encoder
from .common import WHITE_SPACE, Memo, stored

#: Groups of large lengths, and the shares of a sequence over which lengths are large: the plan of fewest
#: sequences among these is taken. Under a half, so that configurations hold several documents; more large
#: lengths leave fewer small ones to fill the gaps.
GROUPS = 512
LARGE = (0.45,)
#: Column generation stops after so many columns at the latest (any number gives a valid plan).
COLUMNS = 3000
#: Chunks a worker remembers, and rows handled at a time (bounds on memory only).
MEMO_ENTRIES = 400_000
ROWS = 256


#: Text between white space, with one space before it, or white space as the split pattern leaves it.
#: No alternative of a byte-level split pattern crosses these borders.
_CHUNK = re.compile(rf" ?[^{WHITE_SPACE}]+|[{WHITE_SPACE}]+(?![^{WHITE_SPACE}])|[{WHITE_SPACE}]+")


@functools.lru_cache(maxsize=2)
def _encoder(path: str) -> tuple:
    """(the tokenizer, strings of its added tokens, remembered packed ids of chunks) of a tokenizer file."""
    from tokenizers import Tokenizer

    tokenizer, plain = Tokenizer.from_file(path), plain_encoder(path)
    added = [token.content for token in tokenizer.get_added_tokens_decoder().values()]
    return tokenizer, added, Memo(lambda chunk: array("I", plain(chunk)).tobytes(), MEMO_ENTRIES)


def encode_text(text: str | None, path: str) -> bytes:
    """Packed 32-bit ids of a text. A chunk between white space is encoded once and remembered; a text with
    the string of an added token, which may cross chunks, is encoded whole by the tokenizer itself."""
    tokenizer, added, chunks = _encoder(path)
    text = text or ""
    if any(map(text.__contains__, added)):
        return array("I", tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
    return b"".join(map(chunks.__getitem__, _CHUNK.findall(text)))


def cut(docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int, id_col: str = "doc_id",
        text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Pieces (id, piece, start, length, ids_crc32, task, nth[, ids]) of every row's tokens.

    ``nth`` numbers a task's pieces of one length. A document over ``capacity`` is cut from its end, so
    only its first piece may be shorter. The result must be stored before it is used more than once.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seen = TaskContext.get().partitionId(), [0] * (capacity + 1)
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for i in range(0, batch.num_rows, ROWS):
                part = batch.slice(i, ROWS)
                rows, doc = [], []
                for d, text in enumerate(part.column(1).to_pylist()):
                    packed = encode_text(text, tokenizer_path) + end
                    n, at = len(packed) // 4, 0
                    for k in range(-(-n // capacity)):
                        length = (n - at) % capacity or capacity
                        own = packed[4 * at:4 * (at + length)]
                        rows.append((k, at, length, zlib.crc32(own), task, seen[length], own))
                        doc.append(d)
                        seen[length] += 1
                        at += length
                columns = list(zip(*rows, strict=True)) or [()] * 7
                kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64())
                arrays = [pa.array(c, t) for c, t in zip(columns[:6], kinds, strict=True)]
                if with_ids:
                    ends = np.cumsum([0, *(len(x) // 4 for x in columns[6])], dtype=np.int32)
                    arrays.append(pa.ListArray.from_arrays(
                        pa.array(ends), pa.array(np.frombuffer(b"".join(columns[6]), np.int32))))
                names = ["id", "piece", "start", "length", "ids_crc32", "task", "nth", "ids"][:len(arrays) + 1]
                yield pa.record_batch([part.column(0).take(pa.array(doc, pa.int64())), *arrays], names=names)

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = (f"id {rows.dtypes[0][1]}, piece int, start long, length long, ids_crc32 long, task int, nth long"
              + ", ids array<int>" * with_ids)
    return rows.mapInArrow(pieces, schema)


def _configurations(sizes: list[int], counts: list[int], capacity: int) -> list[tuple[tuple[int, ...], float]]:
    """(items of each size, times) of a linear program's solution: as few sequences as hold all items."""
    k = len(sizes)
    size, need = np.array(sizes), np.array(counts, float)
    basis = np.diag([float(capacity // s) for s in sizes])
    times = need / np.diag(basis)
    for _ in range(COLUMNS):
        value = np.linalg.solve(basis.T, np.ones(k))
        best, last = np.zeros(capacity + 1), np.full(capacity + 1, -1)
        for c in range(int(size.min()), capacity + 1):  # most valuable content of each capacity
            fits = size <= c
            worth = np.where(fits, value + best[np.maximum(c - size, 0)], -1.0)
            i = int(np.argmax(worth))
            best[c], last[c] = max((best[c - 1], -1), (worth[i], i))
        if best[capacity] <= 1 + 1e-9:
            break
        column, c = np.zeros(k), capacity
        while c > 0:
            if last[c] < 0:
                c -= 1
            else:
                column[last[c]] += 1
                c -= sizes[last[c]]
        change = np.linalg.solve(basis, column)
        usable = change > 1e-9
        ratio = np.full(k, np.inf)
        ratio[usable] = times[usable] / change[usable]
        out = int(np.argmin(ratio))
        step = ratio[out]
        times = np.maximum(times - step * change, 0)
        times[out] = step
        basis[:, out] = column
    return [(tuple(int(round(v)) for v in basis[:, j]), float(times[j])) for j in range(k)]


class Plan:
    """Runs (length, first, count, sequence, offset), made from a count by length."""

    def __init__(self, counts: dict[int, int], capacity: int, groups: int = GROUPS, large: float = LARGE[0]):
        self.capacity, self.runs, self.sequences = capacity, [], 0
        #: Open sequences by room: stacks of (first sequence, how many).
        self.open: dict[int, list[tuple[int, int]]] = {}
        self.rooms: list[int] = []  # ascending, those with open sequences
        rest = self._grouped(sorted(((n, 0, c) for n, c in counts.items() if n > large * capacity), reverse=True),
                             groups)
        small = [(n, 0, c) for n, c in counts.items() if n <= large * capacity]
        for length, first, count in sorted(rest + small, reverse=True):
            self._best_fit(length, first, count)

    def _opened(self, room: int, sequence: int, count: int) -> None:
        if room and count:
            if room not in self.open:
                self.open[room] = []
                bisect.insort(self.rooms, room)
            self.open[room].append((sequence, count))

    def _grouped(self, items: list[tuple[int, int, int]], groups: int) -> list[tuple[int, int, int]]:
        """Place the large runs by configurations of rounded lengths; the runs left over."""
        total = sum(c for _, _, c in items)
        if not total:
            return []
        share, queues = -(-total // groups), [[]]
        taken = 0
        for length, first, count in items:
            while count:
                if taken == share:
                    queues.append([])
                    taken = 0
                part = min(count, share - taken)
                queues[-1].append((length, first, part))
                first, count, taken = first + part, count - part, taken + part
        merged: dict[int, list] = {}  # groups that round up to the same length are one size
        for queue in queues:
            merged.setdefault(queue[0][0], []).extend(queue)
        sizes = sorted(merged)
        found = _configurations(sizes, [sum(c for _, _, c in merged[s]) for s in sizes], self.capacity)
        for items_of, times in sorted(found, reverse=True):
            times = int(times + 1e-6)
            if times:
                slots = [self._take(merged[sizes[i]], times) for i, n in enumerate(items_of) for _ in range(n)]
                self._place(slots, times)
        return [run for queue in merged.values() for run in queue]

    @staticmethod
    def _take(queue: list[tuple[int, int, int]], count: int) -> list[tuple[int, int, int]]:
        """Up to ``count`` documents from the front of a queue of runs."""
        out = []
        while count and queue:
            length, first, n = queue.pop(0)
            part = min(n, count)
            out.append((length, first, part))
            if part < n:
                queue.insert(0, (length, first + part, n - part))
            count -= part
        return out

    def _place(self, slots: list[list[tuple[int, int, int]]], times: int) -> None:
        """Fill ``times`` new sequences, one document of each slot in each as long as the slot has any."""
        slots, done = [list(s) for s in slots], 0
        while done < times and any(slots):
            part = min(times - done, *(s[0][2] for s in slots if s))
            used = 0
            for s in slots:
                if s:
                    length, first, n = s.pop(0)
                    self.runs.append((length, first, part, self.sequences, used))
                    used += length
                    if n > part:
                        s.insert(0, (length, first + part, n - part))
            self._opened(self.capacity - used, self.sequences, part)
            self.sequences += part
            done += part

    def _fill(self, length: int, first: int, sequence: int, count: int, each: int, room: int) -> int:
        """Put ``each`` documents into each of ``count`` sequences; the first document not placed."""
        for k in range(each):
            self.runs.append((length, first, count, sequence, self.capacity - room + k * length))
            first += count
        self._opened(room - each * length, sequence, count)
        return first

    def _best_fit(self, length: int, first: int, count: int) -> None:
        """Best fit of equal documents: the least room that takes one is filled until it takes none."""
        end = first + count
        while first < end:
            at = bisect.bisect_left(self.rooms, length)
            if at < len(self.rooms):
                room = self.rooms[at]
                stack = self.open[room]
                sequence, n = stack.pop()
                if not stack:
                    del self.open[room]
                    self.rooms.pop(at)
            else:
                room, sequence = self.capacity, self.sequences
                n = -(-(end - first) // (room // length))
                self.sequences += n
            each = room // length
            full = min(n, (end - first) // each)
            if full:
                first = self._fill(length, first, sequence, full, each, room)
                sequence, n = sequence + full, n - full
            if n and first < end:  # fewer than ``each`` are left
                first = self._fill(length, first, sequence, 1, end - first, room)
                sequence, n = sequence + 1, n - 1
            self._opened(room, sequence, n)


def pack(pieces: DataFrame, capacity: int) -> DataFrame:
    """``pieces`` (stored, as ``cut`` makes them) with sequence_id and offset.

    The driver gets one row for each length. The plan's size is bounded by the lengths and groups.
    """
    per_task = stored(pieces.groupBy("task", "length").agg((F.max("nth") + 1).alias("n")), "packing-counts")
    counts = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = min((Plan(counts, capacity, large=share) for share in LARGE), key=lambda p: p.sequences)
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = stored(per_task.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")),
                    "packing-starts")
    runs = np.array(sorted(plan.runs), np.int64).reshape(-1, 5)

    @F.pandas_udf("sequence_id long, offset long")
    def placed(length: pd.Series, nth: pd.Series) -> pd.DataFrame:
        key, own = runs[:, 0] << 40 | runs[:, 1], length.to_numpy(np.int64) << 40 | nth.to_numpy(np.int64)
        run = runs[np.searchsorted(key, own, side="right") - 1] if len(own) else runs[:0]
        return pd.DataFrame({"sequence_id": run[:, 3] + nth.to_numpy(np.int64) - run[:, 1], "offset": run[:, 4]})

    rows = pieces.join(starts, ["task", "length"])
    at = placed(F.col("length"), F.col("before") + F.col("nth"))
    rows = rows.select(*[c for c in pieces.columns if c not in ("task", "nth")], at.alias("at"))
    return rows.select(*[c for c in rows.columns if c != "at"], "at.sequence_id", "at.offset")


def pack_documents(docs: DataFrame, tokenizer_path: str, end_id: int = 2, capacity: int = 1024,
                   id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32[, ids], sequence_id, offset) of every piece of every row."""
    pieces = stored(cut(docs, tokenizer_path, end_id, capacity, id_col, text_col, with_ids), "packing-pieces")
    return pack(pieces, capacity).withColumnRenamed("id", id_col)
