"""Alignment of two tokenizers' tokens by white-space anchors (operator 12).

A document is tokenised by a byte-level BPE (A) and by a sentence-piece model (B), each over its whole
text with one space before it. Places where tokens of both end, before tokens of both that begin with a
space, are the anchors: byte ends are compared, nothing is assumed. They cut the token sequences into
windows, and what a window gives (groups between shared ends, links between overlapping tokens) depends
on its token ids alone, so it is remembered by the pair of id tuples.

How often two ids are linked in the whole corpus is counted from the links that each document holds, once
for each different one. The counts then go back to the documents: the pairs that are linked most often, of
which there are at most ``FREQUENT`` by a bound taken from a histogram of the counts, are broadcast; all
others meet the documents' links in a shuffle, where a pair has fewer rows than that bound.

Tokenising is sped up by a memo of chunks. A chunk ends between a character that is no white space and a
space; no split of A and no piece of B crosses there (the vocabulary is looked through when it is loaded),
so the tokens of a text are those of its chunks.

Defined results: a text that is null or empty, or that either tokenizer doesn't give back byte by byte, has
no tokens: all its figures are zero and its groups empty. Rows count each for itself (repeated rows and ids,
null ids), an empty table gives no rows, extra columns are ignored whatever their names.
"""

from __future__ import annotations

import functools
import gc
import hashlib
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .byte_level import byte_level_tokens, plain_encoder
from .common import WHITE_SPACE, stored

#: Pairs of ids that are broadcast with their counts (16 bytes each and what a hash table adds).
FREQUENT = 100_000
#: Chunks and windows that a worker remembers, characters or packed bytes of the longest among them, characters
#: tokenised by one call, and rows handled at a time (bounds on memory only).
MEMO_ENTRIES = 400_000
LONGEST = 64
JOINED = 1 << 14

#: What stands after the ids by A and after those by B in a window's key; no token has such an id.
END_A, END_B = -1, -2
ROWS = 256

#: White space but the plain space.
_OTHER_SPACE = WHITE_SPACE.replace(" ", "", 1)
#: Text up to the next place between a character that is no white space and a space.
_CHUNK = re.compile(rf"[{WHITE_SPACE}]*[^{WHITE_SPACE}]+(?:[{_OTHER_SPACE}][{WHITE_SPACE}]*[^{WHITE_SPACE}]+)*"
                    rf"(?:[{_OTHER_SPACE}][{WHITE_SPACE}]*\Z)?|[{WHITE_SPACE}]+")


def piece_tokens(model) -> list[bytes]:
    """Bytes by id of a sentence-piece model's pieces; control pieces stand for none."""
    out = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            out.append(bytes([int(piece[3:5], 16)]))
        else:
            out.append(b"" if model.is_control(i) or model.is_unknown(i) else piece.replace("▁", " ").encode())
    return out


def bound(memo: dict, new: Iterable, used: set, length) -> None:
    """Bound a memo after a slice of rows: of the keys new in it the long ones aren't kept, and when the memo is
    full only what the slice used is."""
    for key in [k for k in new if length(k) > LONGEST]:
        del memo[key]
    if len(memo) > MEMO_ENTRIES:
        kept = [(k, memo[k]) for k in used if k in memo]
        memo.clear()
        memo.update(kept)


def parts(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(places of ``END_A``, places of ``END_B``, which are ids by A, which are ids by B) of packed id tuples."""
    end_a, end_b = ids == END_A, ids == END_B
    by_b = np.cumsum(end_a.astype(np.int8) - end_b.astype(np.int8), dtype=np.int8) > 0
    is_id = ids >= 0
    return np.flatnonzero(end_a), np.flatnonzero(end_b), is_id & ~by_b, is_id & by_b


class Aligner:
    """Both tokenizers, the bytes of their tokens, and the memos."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_a, self.bytes_b = byte_level_tokens(path_a), piece_tokens(self.b)
        inner = re.compile(r"[^▁]▁")
        if any(inner.search(self.b.id_to_piece(i)) for i in range(self.b.get_piece_size())):
            raise ValueError("pieces of the model cross a space; its texts can't be cut there")
        self.length_a, self.length_b = (np.array([len(t) for t in x], np.int64) for x in (self.bytes_a, self.bytes_b))
        self.marked_a, self.marked_b = (np.array([t[:1] == b" " for t in x]) for x in (self.bytes_a, self.bytes_b))
        self.space_b = self.b.piece_to_id("▁")
        self.fast_a = plain_encoder(path_a)
        self.chunks: dict[str, bytes | None] = {}           # both id tuples, packed; None: not given back
        self.windows: dict[bytes, tuple] = {}               # by both id tuples, packed
        decimal = [str(i) for i in range(max(len(self.bytes_a), len(self.bytes_b)))]
        self.inner, self.last_a, self.last_b = (np.array([d + end for d in decimal], object) for end in ",|;")

    def _encode(self, chunks: list[str]) -> list[bytes] | None:
        """Packed ids by A, ``END_A``, by B, ``END_B`` of chunks that are tokenised as one text; None where that
        text isn't given back byte by byte."""
        joined = "".join(chunks)
        exact = joined.encode("utf-8", "surrogatepass")
        ends = np.cumsum([len(c.encode("utf-8", "surrogatepass")) for c in chunks])
        found = []
        # the model adds the first space itself
        for ids, tokens, lengths in ((self.fast_a(joined), self.bytes_a, self.length_a),
                                     (self.b.encode(joined[1:]) if len(joined) > 1 else [self.space_b], self.bytes_b,
                                      self.length_b)):
            if b"".join(map(tokens.__getitem__, ids)) != exact:
                return None
            ids = np.array(ids, np.int32)
            token_ends = np.cumsum(lengths[ids])
            cuts = np.searchsorted(token_ends, ends)
            if (token_ends[cuts] != ends).any():
                return None
            found += [ids, np.concatenate(([0], cuts + 1))]
        return self._keys(*found[::2], *found[1::2])

    def _learn(self, chunks: set[str]) -> None:
        """Remember the tokens of chunks. Those that end without white space are tokenised many at once: the
        text that they make has the same places to cut."""
        batches, size, single = [[]], 0, []
        for c in chunks:
            if c[-1].isspace():
                single.append(c)
                continue
            if size > JOINED:
                batches.append([])
                size = 0
            batches[-1].append(c)
            size += len(c)
        for batch in batches:
            keys = self._encode(batch) if batch else []
            if keys is None:
                single += batch
            else:
                self.chunks.update(zip(batch, keys, strict=True))
        for c in single:
            self.chunks[c] = (self._encode([c]) or [None])[0]

    def tokenise(self, texts: list[str | None]) -> list[bytes]:
        """Both packed id tuples of each text's chunks, one after another; nothing where one tokenizer doesn't give
        the text's bytes back."""
        split = [_CHUNK.findall(" " + t) if t else [] for t in texts]
        used = set().union(*split)
        new, out, chunk = used.difference(self.chunks), [], self.chunks.__getitem__
        self._learn(new)
        for text, own in zip(texts, split, strict=True):
            keys = list(map(chunk, own))
            if None in keys:                              # the text is looked at as a whole
                keys = self._encode([" " + text]) or []
            out.append(b"".join(keys))
        bound(self.chunks, new, used, len)
        return out

    def align_windows(self, keys: list[bytes]) -> list[tuple[str, int, bytes]]:
        """(groups as text, number of groups, packed links) of each window. A key is the window's packed ids by A,
        ``END_A``, those by B, ``END_B``; a link is A's id times 2**32 plus B's. A window has as many bytes by A
        as by B, so all are compared end to end."""
        ids = np.frombuffer(b"".join(keys), np.int32)
        at_a, at_b, is_a, is_b = parts(ids)
        a, b = ids[is_a], ids[is_b]
        length_a, length_b = self.length_a[a], self.length_b[b]
        end_a, end_b = np.cumsum(length_a), np.cumsum(length_b)
        first = np.searchsorted(end_b, end_a - length_a, side="right")   # tokens of B that a token of A overlaps
        last = np.searchsorted(end_b, end_a, side="left")
        times = last - first + 1
        run = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        links = (np.repeat(a.astype(np.int64), times) << 32) | b[np.repeat(first, times) + run]
        shared_a = end_b[last] == end_a
        shared_b = np.zeros(len(b), bool)
        shared_b[last[shared_a]] = True
        group_a, group_b = np.cumsum(shared_a) - shared_a, np.cumsum(shared_b) - shared_b
        # in the text, a group's tokens of A come before its tokens of B
        before_b = np.searchsorted(group_b, group_a, side="left")
        before_a = np.searchsorted(group_a, group_b, side="right")
        words = np.empty(len(a) + len(b), object)
        words[np.arange(len(a)) + before_b] = np.where(shared_a, self.last_a[a], self.inner[a])
        words[np.arange(len(b)) + before_a] = np.where(shared_b, self.last_b[b], self.inner[b])
        words, packed = words.tolist(), links.tobytes()
        stop_a = np.cumsum(np.diff(np.concatenate(([-1], at_b))) - (at_b - at_a) - 1)
        stop_b = np.cumsum(at_b - at_a - 1)
        groups = np.cumsum(shared_a)[stop_a - 1]
        stop_links = 8 * np.cumsum(times)[stop_a - 1]
        out, i, g, n = [], 0, 0, 0
        for j, h, m in zip((stop_a + stop_b).tolist(), groups.tolist(), stop_links.tolist(), strict=True):
            out.append(("".join(words[i:j]), h - g, packed[n:m]))
            i, g, n = j, h, m
        return out

    @staticmethod
    def _keys(a: np.ndarray, b: np.ndarray, cuts_a: np.ndarray, cuts_b: np.ndarray) -> list[bytes]:
        """Keys of the windows between the cuts."""
        windows = len(cuts_a) - 1
        ids = np.empty(len(a) + len(b) + 2 * windows, np.int32)
        n_a, n_b, k = np.diff(cuts_a), np.diff(cuts_b), np.arange(windows)
        ids[np.arange(len(a)) + np.repeat(cuts_b[:-1] + 2 * k, n_a)] = a
        ids[np.arange(len(b)) + np.repeat(cuts_a[1:] + 2 * k + 1, n_b)] = b
        stops = cuts_a[1:] + cuts_b[1:] + 2 * k + 2
        ids[stops - 1] = END_B
        ids[stops - n_b - 2] = END_A
        packed, cuts = ids.tobytes(), [0, *(4 * stops).tolist()]
        return [packed[i:j] for i, j in zip(cuts, cuts[1:])]

    def align(self, texts: list[str | None]) -> Iterator[tuple[int, int, int, int, str, np.ndarray, np.ndarray]]:
        """(A's tokens, B's tokens, groups, links, groups as text, different links, times of each) of each text."""
        packed = self.tokenise(texts)
        ids = np.frombuffer(b"".join(packed), np.int32)
        *_, is_a, is_b = parts(ids)
        a, b = ids[is_a], ids[is_b]
        stops = np.cumsum([0, *(len(p) // 4 for p in packed)])
        rows_a, rows_b = (np.concatenate(([0], np.cumsum(x)))[stops] for x in (is_a, is_b))   # tokens before each row
        end_a, end_b = np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b])
        # tokens of A that begin with a space, and B's token at the same place if it does too and one ended there
        at_a = np.flatnonzero(self.marked_a[a])
        start = end_a[at_a] - self.length_a[a[at_a]]
        at_b = np.searchsorted(end_b, start, side="left")
        inner = start > 0
        shared = ~inner
        shared[inner] = end_b[at_b[inner]] == start[inner]
        at_b = at_b + inner
        if len(b):
            shared &= self.marked_b[b[np.minimum(at_b, len(b) - 1)]]
        # texts begin with a space, so each begins a window; its last ends where the next text begins
        cuts_a, cuts_b = (np.concatenate((at[shared], [len(x)])) for at, x in ((at_a, a), (at_b, b)))
        keys = self._keys(a, b, cuts_a, cuts_b)
        used = set(keys)
        new = list(used.difference(self.windows))
        if new:
            self.windows.update(zip(new, self.align_windows(new), strict=True))
        values = list(map(self.windows.__getitem__, keys))
        bound(self.windows, new, used, lambda key: len(key) // 4)
        firsts = np.searchsorted(cuts_a[:-1], rows_a).tolist()
        counts = zip(np.diff(rows_a).tolist(), np.diff(rows_b).tolist(), firsts[:-1], firsts[1:], strict=True)
        for n_a, n_b, i, j in counts:
            if not n_a:
                yield 0, 0, 0, 0, "", np.zeros(0, np.int64), np.zeros(0, np.int32)
                continue
            groups, n_groups, links = zip(*values[i:j], strict=True)
            pairs = np.frombuffer(b"".join(links), np.int64)
            different, times = np.unique(pairs, return_counts=True)
            yield n_a, n_b, sum(n_groups), len(pairs), "".join(groups)[:-1], different, times.astype(np.int32)


@functools.lru_cache(maxsize=1)
def _aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text",
          with_groups: bool = False) -> DataFrame:
    """(id, row, n_a, n_b, n_groups, n_links, groups_sha256, links, times[, groups]) of every row's whole text.

    ``links`` are the different linked pairs (A's id times 2**32 plus B's) and ``times`` how often each occurs.
    ``row`` numbers the rows; the result must be stored before it is used more than once.
    """

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, row = _aligner(path_a, path_b), TaskContext.get().partitionId() << 33
        for batch in batches:
            for i in range(0, batch.num_rows, ROWS):
                part = batch.slice(i, ROWS)
                gc.disable()          # a slice makes millions of tuples, none in a cycle; looking them through costs more
                found = list(aligner.align(part.column(1).to_pylist()))
                gc.enable()
                n_a, n_b, groups, links, texts, keys, times = zip(*found, strict=True)
                shas = [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in texts]
                ends = pa.array(np.cumsum([0, *map(len, keys)], dtype=np.int32))
                arrays = [part.column(0), pa.array(np.arange(row, row + part.num_rows)),
                          *(pa.array(x, pa.int64()) for x in (n_a, n_b, groups, links)), pa.array(shas, pa.string()),
                          pa.ListArray.from_arrays(ends, pa.array(np.concatenate(keys), pa.int64())),
                          pa.ListArray.from_arrays(ends, pa.array(np.concatenate(times), pa.int32()))]
                row += part.num_rows
                names = ["id", "row", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "links", "times"]
                if with_groups:
                    arrays.append(pa.array(texts, pa.string()))
                    names.append("groups")
                yield pa.record_batch(arrays, names=names)

    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    schema = (f"id {rows.dtypes[0][1]}, row long, n_a long, n_b long, n_groups long, n_links long, "
              "groups_sha256 string, links array<long>, times array<int>" + ", groups string" * with_groups)
    return rows.mapInArrow(aligned, schema).withColumnRenamed("id", id_col)


def _links(aligned: DataFrame) -> DataFrame:
    """(row, link, times), a row for each different link of a document."""
    each = aligned.select("row", F.explode(F.arrays_zip("links", "times")).alias("l"))
    return each.select("row", F.col("l.links").alias("link"), F.col("l.times").alias("times"))


def count_links(aligned: DataFrame) -> DataFrame:
    """(link, n, best): how often two ids are linked in the corpus, and whether no other id of A is linked more
    often with that id of B. Stored."""
    counts = stored(_links(aligned).groupBy("link").agg(F.sum("times").alias("n")), "cross-counts")
    b = F.col("link").bitwiseAND(0xFFFFFFFF)
    highest = counts.groupBy(b.alias("b")).agg(F.max("n").alias("highest"))      # a row for each id of B at most
    marked = counts.join(highest, b == F.col("b")).select("link", "n", (F.col("n") == F.col("highest")).alias("best"))
    return stored(marked, "cross-marked")


def frequent_from(counts: DataFrame, most: int = FREQUENT) -> int:
    """The least power of two such that at most ``most`` links have that count or a higher one."""
    per_power = counts.groupBy(F.floor(F.log2("n")).alias("power")).agg(F.count(F.lit(1)).alias("n")).collect()
    total, bound = 0, 1 << 62
    for power, n in sorted(((r["power"], r["n"]) for r in per_power), reverse=True):
        total += n
        if total > most:
            break
        bound = 1 << power
    return bound


def score(aligned: DataFrame, counts: DataFrame, most: int = FREQUENT) -> DataFrame:
    """(row, n_best, count_sum) of each document with links: its links whose count is the highest of their id of
    B, and the sum of the counts over its links. Both arguments must be stored."""
    bound = frequent_from(counts, most)
    frequent, rare = counts.filter(F.col("n") >= bound), counts.filter(F.col("n") < bound)
    links = _links(aligned)
    known = links.join(F.broadcast(frequent), "link")
    others = links.join(F.broadcast(frequent.select("link")), "link", "left_anti").join(rare.hint("merge"), "link")

    def summed(df: DataFrame) -> DataFrame:
        return df.groupBy("row").agg(F.sum(F.col("times") * F.col("best").cast("long")).alias("n_best"),
                                     F.sum(F.col("times") * F.col("n")).alias("count_sum"))

    both = summed(known).unionByName(summed(others))
    return both.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def align_corpus(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row."""
    aligned = stored(align(docs, path_a, path_b, id_col, text_col), "cross-aligned")
    sums = score(aligned, count_links(aligned))
    rows = aligned.select("row", id_col, "n_a", "n_b", "n_groups", "n_links", "groups_sha256").join(sums, "row", "left")
    return rows.select(id_col, "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", F.lit(0)).alias("n_best"),
                       F.coalesce("count_sum", F.lit(0)).alias("count_sum"), "groups_sha256")
