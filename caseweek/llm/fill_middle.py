"""Fill-in-the-middle transformation by a sparse exception index (operator 11).

Texts stay UTF-8 bytes. Of a whole batch of texts only the multibyte characters are recorded: their
places and the bytes they take beyond one. A binary search in that list turns cuts in bytes into cuts in
code points and back; where all is ASCII the two differ by nothing that has to be looked up. Word ends,
which lie beside ASCII white space, are found in bytes for a batch at once.

A document's choices (form and both cuts) come from a digest of a seed and its id, so that they do not
depend on the partitioning. The form ``plain`` leaves the text as it is; ``psm`` is prefix, suffix, middle
and ``spm`` suffix, prefix, middle, each after its marker. A text that holds a marker stays plain, so
markers in the output of the other forms are unambiguous and the text can be rebuilt from it.

Defined results: a null text counts as empty, an empty text has no units and stays plain, a null id
counts as empty text in the digest, every row gives one row (repeated rows too), an empty table gives no
rows, extra columns are ignored whatever their names.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows handled at a time (bounds memory only).
ROWS = 256


@dataclass(frozen=True)
class Recipe:
    """Shares in percent of documents that are rearranged, and of those in the order suffix, prefix, middle;
    cuts between ``word`` units (white space goes with the word after it) or between any code points (``char``)."""
    seed: int = 42
    rearranged: int = 50
    suffix_first: int = 80
    unit: str = "word"
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def __post_init__(self):
        if self.unit not in ("word", "char"):
            raise ValueError(f"unknown unit {self.unit!r}")

    @property
    def markers(self) -> tuple[str, str, str]:
        return self.prefix, self.suffix, self.middle

    def choices(self, doc_id) -> tuple[int, int, int, int]:
        """Four unsigned numbers that decide on a document."""
        text = f"{self.seed}:{'' if doc_id is None else doc_id}"
        return struct.unpack(">4I", hashlib.sha256(text.encode()).digest()[:16])


class ExceptionIndex:
    """The multibyte characters of a UTF-8 buffer: byte places, code-point places and excess bytes so far."""

    def __init__(self, data: np.ndarray):
        self.bytes_at = np.flatnonzero(data >= 0xC0)
        lead = data[self.bytes_at]
        excess = 1 + (lead >= 0xE0) + (lead >= 0xF0)
        self.excess = np.concatenate(([0], np.cumsum(excess, dtype=np.int64)))
        self.chars_at = self.bytes_at - self.excess[:-1]

    def to_chars(self, cuts: np.ndarray) -> np.ndarray:
        """Code points before each byte cut (a cut between characters)."""
        return cuts - self.excess[np.searchsorted(self.bytes_at, cuts)]

    def to_bytes(self, cuts: np.ndarray) -> np.ndarray:
        """Bytes before each code-point cut."""
        return cuts + self.excess[np.searchsorted(self.chars_at, cuts)]


class WordEnds:
    """Ends of the units of a buffer of texts: white space and the word after it, or trailing white space."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, stops: np.ndarray):
        gap = (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))
        last = ~gap
        inner = np.ones(len(data), bool)
        inner[stops[stops > starts] - 1] = False            # a text's last byte ends its word
        last[:-1] &= gap[1:] | ~inner[:-1]
        self.ends = np.flatnonzero(last) + 1
        self.starts, self.stops = starts, stops
        self.first = np.searchsorted(self.ends, starts, side="right")
        self.words = np.searchsorted(self.ends, stops, side="right") - self.first
        filled = stops > starts
        trailing = np.zeros(len(starts), bool)
        trailing[filled] = gap[stops[filled] - 1]
        self.counts = self.words + trailing

    def cut(self, units: np.ndarray) -> np.ndarray:
        """Byte places after the first ``units`` units of each text."""
        at = np.where(units > self.words, self.stops, self.starts)
        inside = (units > 0) & (units <= self.words)
        at[inside] = self.ends[(self.first + units - 1)[inside]]
        return at


def _buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a column of texts; nulls are empty."""
    texts = texts.fill_null("").cast(pa.large_string())
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def rearrange(ids: list, texts: pa.Array, recipe: Recipe) -> tuple[list, ...]:
    """(n, form, prefix_chars, middle_chars, output bytes) of each text, as lists."""
    data, offsets = _buffer(texts)
    starts, stops = offsets[:-1], offsets[1:]
    index = ExceptionIndex(data)
    chosen = np.array([recipe.choices(i) for i in ids], np.int64).reshape(-1, 4)
    first_char = index.to_chars(starts)
    if recipe.unit == "word":
        units = WordEnds(data, starts, stops)
        n = units.counts
    else:
        n = index.to_chars(stops) - first_char
    a, b = (chosen[:, k] % (n + 1) for k in (0, 1))
    a, b = np.minimum(a, b), np.maximum(a, b)
    if recipe.unit == "word":
        a, b = units.cut(a), units.cut(b)                    # bytes first, code points from them
        chars = index.to_chars(a) - first_char, index.to_chars(b) - index.to_chars(a)
    else:
        chars = a, b - a                                     # code points first, bytes from them
        a, b = index.to_bytes(first_char + a), index.to_bytes(first_char + b)
    prefix, suffix, middle = (m.encode() for m in recipe.markers)
    whole, forms, outputs, prefix_chars, middle_chars = data.tobytes(), [], [], [], []
    for k, (i, p, q, j) in enumerate(zip(starts.tolist(), a.tolist(), b.tolist(), stops.tolist(), strict=True)):
        text = whole[i:j]
        if (not text or chosen[k, 2] % 100 >= recipe.rearranged
                or prefix in text or suffix in text or middle in text):
            forms.append("plain")
            outputs.append(text)
            prefix_chars.append(None)
            middle_chars.append(None)
            continue
        head, body, tail = whole[i:p], whole[p:q], whole[q:j]
        if chosen[k, 3] % 100 < recipe.suffix_first:
            forms.append("spm")
            outputs.append(b"".join((suffix, tail, prefix, head, middle, body)))
        else:
            forms.append("psm")
            outputs.append(b"".join((prefix, head, suffix, tail, middle, body)))
        prefix_chars.append(int(chars[0][k]))
        middle_chars.append(int(chars[1][k]))
    return n.tolist(), forms, prefix_chars, middle_chars, outputs


def transform(docs: DataFrame, recipe: Recipe = Recipe(), id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output) of every row's whole text: its units, its form, the
    code points of prefix and middle (null where plain) and the training text."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, ROWS):
                part = batch.slice(i, ROWS)
                n, forms, heads, bodies, outputs = rearrange(part.column(0).to_pylist(), part.column(1), recipe)
                yield pa.record_batch(
                    [part.column(0), pa.array(n, pa.int64()), pa.array(forms, pa.string()), pa.array(heads, pa.int64()),
                     pa.array(bodies, pa.int64()), pa.array(outputs, pa.binary()).cast(pa.string())],
                    names=["id", "n", "form", "prefix_chars", "middle_chars", "output"])

    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    found = rows.mapInArrow(made, f"id {rows.dtypes[0][1]}, n long, form string, prefix_chars long, "
                                  "middle_chars long, output string")
    return found.withColumnRenamed("id", id_col)


def restored_column(output: Column, form: Column, recipe: Recipe = Recipe()) -> Column:
    """The text that an output and its form were made from."""
    prefix, suffix, middle = (F.lit(m) for m in recipe.markers)

    def between(left: Column, right: Column) -> Column:
        return F.split_part(F.split_part(output, left, F.lit(2)), right, F.lit(1))

    body = F.split_part(output, middle, F.lit(2))
    return (F.when(form == "psm", F.concat(between(prefix, suffix), body, between(suffix, middle)))
            .when(form == "spm", F.concat(between(prefix, middle), body, between(suffix, prefix)))
            .otherwise(output))
