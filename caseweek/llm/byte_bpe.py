"""Byte-level BPE by backtracking over longest matches (operator 9).

Token bytes are mapped to Latin-1 text, so a pyahocorasick automaton finds every vocabulary token in a
piece in one pass. The encoder then walks the piece from the left, taking the longest token at each
position that may follow the token before it, and steps back to shorter ones where no token fits. Whether
two tokens may stand side by side depends on the two alone (undoing their merges must not expose an
earlier merge across the border) and is memoised. A position that once led nowhere is never tried again:
the valid tokens up to a position are unique, so the walk is linear in the piece.

Defined results: a null text counts as empty, an empty text has no ids and decodes to no bytes, every
row gives one row (repeated rows and null ids too), extra columns are ignored.
"""

from __future__ import annotations

import base64
import functools
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Memo

#: Entries of a memo (pieces, token pairs) and rows handled at a time; both bound memory only.
MEMO_ENTRIES = 300_000
ROWS = 256

def read_ranks(path: str) -> list[bytes]:
    """Token bytes by id from a rank file (base64 bytes and rank on each line)."""
    with open(path, "rb") as f:
        ranks = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, f)}
    return [ranks[i] for i in range(len(ranks))]


class Decoder:
    """Token bytes in one buffer, gathered by id."""

    def __init__(self, tokens: list[bytes]):
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)
        self.sizes = np.array([len(token) for token in tokens], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes that the ids stand for, their ends by id)."""
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        return self.flat[np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[ids] - ends + sizes, sizes)], ends


class ByteBpe:
    """Encoder and decoder for one vocabulary and one split pattern."""

    def __init__(self, tokens: list[bytes], pattern: str):
        self.tokens = tokens
        self.ranks = {token: i for i, token in enumerate(tokens)}
        self.pattern = regex.compile(pattern)
        #: The two parts whose merge made a token; a single byte is its own two parts.
        self.parts: list[tuple[int, int]] = []
        self.merged: dict[tuple[int, int], int] = {}
        self.automaton = ahocorasick.Automaton()
        for i, token in enumerate(tokens):
            parts = self._last_merge(i, token) if len(token) > 1 else (i, i)
            self.parts.append(parts or (i, i))
            if parts is None:
                continue  # merges never make it; only a piece that equals it gets it
            if len(token) > 1:
                self.merged[parts] = i
            self.automaton.add_word(token.decode("latin-1"), i)
        self.automaton.make_automaton()
        self.lengths = [len(token) for token in tokens]
        self.pairs: dict[tuple[int, int], bool] = {}
        #: The longest token that a token begins with, -1 if none.
        self.shorter = [self._shorter(token) for token in tokens]
        self.pieces = Memo(self._packed, MEMO_ENTRIES)
        self.decoder = Decoder(tokens)

    def _last_merge(self, rank: int, token: bytes) -> tuple[int, int] | None:
        """The parts left when only merges of lower rank have been made, if they are two."""
        parts = [token[i:i + 1] for i in range(len(token))]
        while len(parts) > 2:
            best, at = rank, -1
            for i in range(len(parts) - 1):
                r = self.ranks.get(parts[i] + parts[i + 1], rank)
                if r < best:
                    best, at = r, i
            if at < 0:
                return None
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return self.ranks[parts[0]], self.ranks[parts[1]]

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both tokens keeps their border."""
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) >= MEMO_ENTRIES:
                self.pairs.clear()
            known = self.pairs[left, right] = self._border_holds(left, right)
        return known

    def _border_holds(self, left: int, right: int) -> bool:
        # Undo the later of the two merges again and again; a merge across the border that comes
        # before the merges undone so far would have joined them first.
        bound = len(self.tokens) + 1
        while True:
            across = self.merged.get((left, right))
            if across is not None and across < bound:
                return False
            if left > right:
                undone, inner = left, self.parts[left][1]
                if inner != undone:
                    bound, left = undone, inner
                    continue
                bound = right + 1
                if self.parts[right][0] == right:
                    return True
                right = self.parts[right][0]
            else:
                undone, inner = right, self.parts[right][0]
                if inner != undone:
                    bound, right = undone + 1, inner
                    continue
                bound = left
                if self.parts[left][1] == left:
                    return True
                left = self.parts[left][1]

    def _shorter(self, token: bytes) -> int:
        for n in range(len(token) - 1, 0, -1):
            i = self.ranks.get(token[:n], -1)
            if i >= 0 and (n == 1 or self.parts[i] != (i, i)):
                return i
        return -1

    def encode_piece(self, piece: bytes) -> list[int]:
        """Ids of one match of the split pattern."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        text, n, lengths, pairs, shorter = piece.decode("latin-1"), len(piece), self.lengths, self.pairs, self.shorter
        ids, at, last, fruitless = [], 0, -1, None
        longest = self.automaton.iter_long(text)          # goes on as long as each of its matches is taken
        _, token = next(longest, (0, -1))
        taken = True
        while token >= 0:
            end = at + lengths[token]
            if not (fruitless and end in fruitless):
                fits = last < 0 or pairs.get((last, token))
                if fits or fits is None and self.compatible(last, token):
                    ids.append(token)
                    if end == n:
                        return ids
                    at, last = end, token
                    if not taken:
                        longest = self.automaton.iter_long(text, at)
                    _, token = next(longest, (0, -1))
                    taken = True
                    continue
            token, taken = shorter[token], False
            while token < 0 and ids:                      # nothing fits here: a shorter one before
                fruitless = fruitless or set()
                fruitless.add(at)
                token = ids.pop()
                at -= lengths[token]
                last = ids[-1] if ids else -1
                token = shorter[token]
        raise ValueError("the vocabulary lacks single bytes")

    def _packed(self, piece: str) -> bytes:
        return array("i", self.encode_piece(piece.encode("utf-8", "surrogatepass"))).tobytes()

    def encode(self, text: str) -> bytes:
        """Ids of a text as packed 32-bit integers."""
        return b"".join(map(self.pieces.__getitem__, self.pattern.findall(text)))


@functools.lru_cache(maxsize=2)
def _codec(path: str, pattern: str) -> ByteBpe:
    return ByteBpe(read_ranks(path), pattern)


@functools.lru_cache(maxsize=2)
def _decoder(path: str) -> Decoder:
    return Decoder(read_ranks(path))


def _ids_column(ids: list[bytes]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(list column, flat ids, ends by row) of packed ids."""
    ends = np.cumsum([0, *(len(x) // 4 for x in ids)], dtype=np.int32)
    flat = np.frombuffer(b"".join(ids), np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)), flat, ends


def _decoded_column(decoder: Decoder, flat: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Binary column of what rows of ids stand for."""
    data, byte_ends = decoder.decode(flat)
    ends = np.concatenate(([0], byte_ends))[ends].astype(np.int64)
    texts = pa.Array.from_buffers(pa.large_binary(), len(ends) - 1, [None, pa.py_buffer(ends), pa.py_buffer(data)])
    return texts.cast(pa.binary())


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
           with_decoded: bool = False) -> DataFrame:
    """(id, ids array<int>[, decoded]) of every row's whole text; ``decoded`` is what the ids stand for, as bytes.
    ``ranks_path`` must exist on every worker."""

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(ranks_path, pattern)
        for batch in batches:
            for i in range(0, batch.num_rows, ROWS):
                part = batch.slice(i, ROWS)
                column, flat, ends = _ids_column([codec.encode(t or "") for t in part.column(1).to_pylist()])
                arrays = [part.column(0), column]
                if with_decoded:
                    arrays.append(_decoded_column(codec.decoder, flat, ends))
                yield pa.record_batch(arrays, names=["id", "ids", "decoded"][:len(arrays)])

    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    found = rows.mapInArrow(encoded, f"id {rows.dtypes[0][1]}, ids array<int>" + ", decoded binary" * with_decoded)
    return found.withColumnRenamed("id", id_col)


def decode(encoded: DataFrame, ranks_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, ids, decoded) with the bytes the ids stand for."""

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = _decoder(ranks_path)
        for batch in batches:
            for i in range(0, batch.num_rows, ROWS):
                part = batch.slice(i, ROWS)
                lists = part.column(1)
                flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int32)
                sizes = pc.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False)
                ends = np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)
                yield pa.record_batch([part.column(0), lists, _decoded_column(decoder, flat, ends)],
                                      names=["id", "ids", "decoded"])

    rows = encoded.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{ids_col}`").alias("ids"))
    found = rows.mapInArrow(decoded, f"id {rows.dtypes[0][1]}, ids array<int>, decoded binary")
    return found.withColumnRenamed("id", id_col)
