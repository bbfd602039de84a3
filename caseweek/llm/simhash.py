"""Near-duplicates by SimHash fingerprints and Golay-code fuzzy hashing (operator 2).

A 64-bit fingerprint falls into three segments (22, 21 and 21 bits), each a word of the perfect binary
Golay code of length 23: every word lies within three bits of exactly one codeword, its centre, whose
12 information bits are the codeword's index. Two words one bit apart have the same centre, or both lie
three bits from theirs and four from the other's; so with its centre a word also gets the index of each
codeword four bits away that is smaller than its centre's, and two such words always share an index.
If two fingerprints differ in at most three bits, either a segment is the same in both, and then one of
the other two differs in at most one bit; or each segment differs in one bit. So a fingerprint gets the
keys (one segment as it is, an index of another) for each two segments, and (an index of each segment)
for all three: about forty keys of 33 to 36 bits, which stay selective among billions of fingerprints.
Fingerprints that share a key are candidates, and the bit distance of every candidate pair is checked,
so no link is lost and none is made up.

Work is done on distinct fingerprints. Within a key only a forest of links leaves the task, enough to
connect what is linked. A key of many fingerprints is cut into blocks, and each pair of blocks is a
group of its own.

Defined results: null, empty or blank text has no words and fingerprint zero, which links like any
other; texts of fewer words than a shingle have one shingle of all words; every row gives one row
(repeated rows too); null ids are linked but never name a component unless it has no other id, then its
name is null; extra columns are ignored.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored
from .components import connect

#: Generator polynomial x^11+x^10+x^6+x^5+x^4+x^2+1 of the Golay code (a fixed value).
GENERATOR = 0b110001110101
#: First bit and width of each segment.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Fingerprints in a block of a key, and shingles counted at a time.
BLOCK = 2048
SHINGLES = 65_536
#: Runs up to this length are compared by shifts over the whole batch, longer ones one by one.
SHORT_RUN = 12


def fingerprint(text: str | None, shingle_words: int = 3) -> int:
    """Unsigned 64-bit SimHash of a text's word shingles."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z, only ASCII blanks
    if not words:
        return 0
    k = min(shingle_words, len(words))
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])[:len(words) - k + 1].tolist()
    ends = ends[k - 1:].tolist()
    ones = np.zeros(64, np.int64)
    for i in range(0, len(starts), SHINGLES):
        hashed = b"".join([xxhash.xxh64_digest(joined[s:e], 42)
                           for s, e in zip(starts[i:i + SHINGLES], ends[i:i + SHINGLES], strict=True)])
        bits = np.unpackbits(np.frombuffer(hashed, np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(starts)).tobytes(), "big")


def fingerprint_column(text: Column, shingle_words: int = 3) -> Column:
    """The fingerprint of a text column as a (signed) long."""

    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        found = np.fromiter((fingerprint(t, shingle_words) for t in texts), np.uint64, len(texts))
        return pd.Series(found.view(np.int64))

    return of(text)


class Golay:
    """Centres and farther codewords of 23-bit words."""

    def __init__(self):
        self.remainder = np.zeros(1 << 12, np.int32), np.zeros(1 << 11, np.int32)
        for table, shift in zip(self.remainder, (0, 12), strict=True):
            for value in range(len(table)):
                table[value] = self._divide(value << shift)
        near = [0, *(sum(1 << b for b in bits) for n in (1, 2, 3) for bits in itertools.combinations(range(23), n))]
        self.leader = np.zeros(1 << 11, np.int32)
        self.leader[self.syndrome(np.array(near))] = near
        four = np.array([sum(1 << b for b in bits) for bits in itertools.combinations(range(23), 4)], np.int32)
        by = self.syndrome(four)
        #: Words of weight four by syndrome: five each where the leader has weight three, else none.
        self.four = np.zeros((1 << 11, 5), np.int32)
        order = np.argsort(by, kind="stable")
        self.has_four = np.bincount(by, minlength=1 << 11) == 5
        self.four[self.has_four] = four[order].reshape(-1, 5)

    @staticmethod
    def _divide(word: int) -> int:
        for bit in range(22, 10, -1):
            if word >> bit & 1:
                word ^= GENERATOR << (bit - 11)
        return word

    def syndrome(self, words: np.ndarray) -> np.ndarray:
        return self.remainder[0][words & 0xFFF] ^ self.remainder[1][words >> 12]

    def indices(self, words: np.ndarray) -> np.ndarray:
        """Six columns of codeword indices: the centre's, then the smaller ones four bits off (else -1)."""
        syndrome = self.syndrome(words)
        centre = (words ^ self.leader[syndrome]) >> 11
        other = (words[:, None] ^ self.four[syndrome]) >> 11
        other[~self.has_four[syndrome][:, None] | (other >= centre[:, None])] = -1
        return np.concatenate([centre[:, None], other], axis=1)


def golay_keys(fps: np.ndarray, golay: Golay) -> tuple[np.ndarray, np.ndarray]:
    """(position in ``fps``, key) of every key of every fingerprint; ``fps`` are unsigned."""
    segments = [(fps >> np.uint64(first) & np.uint64((1 << width) - 1)).astype(np.int32) for first, width in SEGMENTS]
    found = [golay.indices(segment).astype(np.int64) for segment in segments]
    positions, keys = [], []
    for kind, (exact, fuzzy) in enumerate(itertools.permutations(range(3), 2)):
        row, column = np.nonzero(found[fuzzy] >= 0)
        positions.append(row)
        keys.append(kind << 40 | segments[exact][row].astype(np.int64) << 12 | found[fuzzy][row, column])
    a, b, c = found[0][:, :, None, None], found[1][:, None, :, None], found[2][:, None, None, :]
    row, i, j, k = np.nonzero((a >= 0) & (b >= 0) & (c >= 0))
    positions.append(row)
    keys.append(6 << 40 | found[0][row, i] << 24 | found[1][row, j] << 12 | found[2][row, k])
    return np.concatenate(positions), np.concatenate(keys)


def _forest(fps: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links that connect whatever is connected by links of at most ``max_bits`` bits."""
    rest = np.ones(len(fps), bool)
    links = []
    while rest.any():
        start = int(np.argmax(rest))
        rest[start] = False
        reached = [start]
        while reached:
            i = reached.pop()
            candidates = np.flatnonzero(rest)
            if not len(candidates):
                break
            near = candidates[np.bitwise_count(fps[candidates] ^ fps[i]) <= max_bits]
            rest[near] = False
            links += [(i, j) for j in near.tolist()]
            reached += near.tolist()
    return links


def _links_in_runs(groups: np.ndarray, fps: np.ndarray, max_bits: int) -> np.ndarray:
    """Links (two rows of positions) among fingerprints of equal consecutive groups."""
    starts = np.flatnonzero(np.concatenate([[True], groups[1:] != groups[:-1]]))
    lengths = np.diff(np.concatenate([starts, [len(groups)]]))
    found = []
    long_run = np.repeat(lengths > SHORT_RUN, lengths)
    for shift in range(1, min(SHORT_RUN, int(lengths.max(initial=0)))):
        a = np.arange(len(groups) - shift)
        a = a[(groups[a] == groups[a + shift]) & ~long_run[a]]
        a = a[np.bitwise_count(fps[a] ^ fps[a + shift]) <= max_bits]
        found.append(np.stack([a, a + shift]))
    for s, n in zip(starts[lengths > SHORT_RUN].tolist(), lengths[lengths > SHORT_RUN].tolist(), strict=True):
        if links := _forest(fps[s:s + n], max_bits):
            found.append(np.array(links).T + s)
    return np.concatenate(found, axis=1) if found else np.empty((2, 0), np.int64)


def fingerprint_links(fps: DataFrame, max_bits: int = 3) -> DataFrame:
    """Links (u, v) that connect distinct fingerprints (column ``fp``, stored) differing in few bits."""
    if not 0 <= max_bits <= 3:
        raise ValueError("the keys find up to three differing bits")

    def keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        golay = Golay()
        for batch in batches:
            own = batch["fp"].to_numpy()
            at, keys = golay_keys(own.view(np.uint64), golay)
            yield pd.DataFrame({"key": keys, "fp": own[at]})

    def linked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = pd.DataFrame({"group": np.empty(0, np.int64), "fp": np.empty(0, np.int64)})
        for batch in itertools.chain(batches, [None]):
            if batch is None:
                rows = held
            else:
                rows = pd.concat([held, batch[["group", "fp"]]], ignore_index=True)
                last = int(np.searchsorted(rows["group"].to_numpy(), rows["group"].iloc[-1])) if len(rows) else 0
                rows, held = rows.iloc[:last], rows.iloc[last:]  # the last group may go on in the next batch
            own = rows["fp"].to_numpy()
            a, b = _links_in_runs(rows["group"].to_numpy(), own.view(np.uint64), max_bits)
            yield pd.DataFrame({"u": own[a], "v": own[b]})

    keys = fps.select("fp").mapInPandas(keyed, "key long, fp long")
    shared = stored(keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "simhash-keys")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    mine = F.pmod(F.xxhash64("fp"), blocks).cast("int")
    rows = (keys.join(shared, "key").withColumn("mine", mine)
            .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
            .select(F.xxhash64("key", F.least("mine", "other"), F.greatest("mine", "other")).alias("group"), "fp"))
    return rows.repartition("group").sortWithinPartitions("group").mapInPandas(linked, "u long, v long")


def _components(own: DataFrame, max_bits: int) -> DataFrame:
    """(fp, component) of the fingerprints in ``own`` (id, fp), a stored table."""
    nodes = stored(own.groupBy("fp").agg(F.min("id").alias("least_id")), "simhash-nodes")
    roots = connect(fingerprint_links(nodes, max_bits))
    rooted = stored(nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
                    .select("fp", "least_id", F.coalesce("root", "fp").alias("root")), "simhash-roots")
    names = stored(rooted.groupBy("root").agg(F.min("least_id").alias("component")), "simhash-names")
    return stored(rooted.join(names, "root").select("fp", "root", "component"), "simhash-named")


def near_duplicates(docs: DataFrame, shingle_words: int = 3, max_bits: int = 3, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """(id, fp, component) of every row: its signed fingerprint and the smallest id it is linked with."""
    own = stored(docs.select(F.col(id_col).alias("id"),
                             fingerprint_column(F.col(text_col), shingle_words).alias("fp")), "simhash")
    return own.join(_components(own, max_bits), "fp").select(F.col("id").alias(id_col), "fp", "component")


def keep_one(docs: DataFrame, shingle_words: int = 3, max_bits: int = 3, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, whole: of each component the one with the smallest id.

    Of rows that tie for it one stays, as they are numbered in the table that the stage works on.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    rows = stored(docs.select(F.struct(*columns).alias("row"), F.col(f"`{id_col}`").alias("id"),
                              fingerprint_column(F.col(f"`{text_col}`"), shingle_words).alias("fp"),
                              F.monotonically_increasing_id().alias("number")), "simhash-rows")
    own = rows.select("id", "fp", "number")
    named = _components(own, max_bits)
    # null ids come last: the smallest id of a component is that of a row that has one, if any has
    order = F.struct(F.col("id").isNull(), "id", "number")
    least = own.groupBy("fp").agg(F.min(order).alias("first"))
    staying = least.join(named, "fp").groupBy("root").agg(F.min("first").alias("first"))
    return rows.join(staying.select(F.col("first.number").alias("number")), "number", "left_semi").select("row.*")
