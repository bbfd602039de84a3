"""Exact and near-duplicate removal and line removal against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from caseweek.llm import exact_dedup, line_dedup, simhash
from caseweek.llm.components import connect

from .helpers import documents, empty


def test_exact_groups_match_brute_force(spark):
    docs = documents(spark)
    verdicts, kept = exact_dedup.deduplicate(docs)
    groups = defaultdict(list)
    for r in docs.collect():
        groups[r["text"] or ""].append(r["doc_id"])
    top = {t: max((i for i in ids if i is not None), default=None) for t, ids in groups.items()}
    want = Counter((i, top[t], len(ids), hashlib.sha256(t.encode()).hexdigest())
                   for t, ids in groups.items() for i in ids)
    rows = verdicts.collect()
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in rows) == want
    stays = [r for r in rows if r["kept"]]
    assert len(stays) == len(groups) and all(r["doc_id"] == r["keep_id"] for r in stays)
    assert kept.columns == docs.columns
    assert Counter(r["text"] or "" for r in kept.collect()) == Counter(groups.keys())


def test_exact_spills_and_folds_give_the_same(spark, monkeypatch):
    docs = documents(spark, extra=False)
    whole = sorted(map(str, exact_dedup.deduplicate(docs, carry=False)[0].collect()))
    monkeypatch.setattr(exact_dedup, "FOLD_BYTES", 50)
    tiny = exact_dedup.deduplicate(docs.coalesce(1), table_bytes=200, bucket_bytes=10**9, carry=False)[0]
    assert sorted(map(str, tiny.collect())) == whole


def test_exact_empty_table(spark):
    verdicts, kept = exact_dedup.deduplicate(empty(spark))
    assert verdicts.count() == 0 and kept.count() == 0


def test_text_table_compares_complete_texts():
    table = exact_dedup.TextTable()
    for i in range(5000):
        entry, slot = table.find(7, f"t{i % 1700}")
        assert (entry < 0) == (i < 1700)
        if entry < 0:
            table.add(7, f"t{i}", slot)
    assert len(table.texts) == 1700


def brute_fingerprint(text, k=3):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                root[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(fps))]


def test_simhash_matches_brute_force(spark):
    docs = documents(spark)
    rows = docs.collect()
    fps = [brute_fingerprint(r["text"]) for r in rows]
    roots = brute_components(fps)
    least = {}
    for r, c in zip(rows, roots):
        if r["doc_id"] is not None:
            least[c] = min(least.get(c, r["doc_id"]), r["doc_id"])
    want = Counter((r["doc_id"], f, least.get(c)) for r, f, c in zip(rows, fps, roots))
    found = simhash.near_duplicates(docs).collect()
    assert Counter((r["doc_id"], r["fp"] % 2**64, r["component"]) for r in found) == want
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == len(set(roots))
    ids = {least.get(c) for c in roots}
    assert {r["doc_id"] for r in kept.collect()} == ids


def test_simhash_empty_table(spark):
    assert simhash.near_duplicates(empty(spark)).count() == 0
    assert simhash.keep_one(empty(spark)).count() == 0


def test_golay_code_is_perfect():
    golay = simhash.Golay()
    words = np.arange(1 << 23, dtype=np.int32)
    centres = words ^ golay.leader[golay.syndrome(words)]
    assert not golay.syndrome(centres).any() and len(np.unique(centres)) == 4096
    assert int(np.bitwise_count(words ^ centres).max()) == 3


def test_every_link_shares_a_key():
    golay, r = simhash.Golay(), random.Random(3)
    for _ in range(2000):
        a = r.getrandbits(64)
        b = a
        for bit in r.sample(range(64), r.randint(0, 3)):
            b ^= 1 << bit
        at, keys = simhash.golay_keys(np.array([a, b], np.uint64), golay)
        assert set(keys[at == 0]) & set(keys[at == 1])


def test_links_beyond_three_bits_are_refused(spark):
    with pytest.raises(ValueError):
        simhash.fingerprint_links(spark.createDataFrame([(1,)], "fp long"), max_bits=4)


def test_large_groups_of_near_fingerprints_are_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 16)
    r = random.Random(5)
    centre = r.getrandbits(63)
    fps = list({centre ^ (1 << r.randrange(63)) ^ (1 << r.randrange(63)) for _ in range(150)}) + \
        [r.getrandbits(63) for _ in range(100)]
    links = simhash.fingerprint_links(spark.createDataFrame([(f,) for f in fps], "fp long"))
    roots = {row["node"]: row["root"] for row in connect(links).collect()}
    want = brute_components(fps)
    groups = defaultdict(set)
    for f, c in zip(fps, want):
        groups[c].add(f)
    for members in groups.values():
        assert {roots.get(f, f) for f in members} == {min(members)}
    assert links.count() < 40 * len(fps)      # forests, not all pairs


def test_components_of_paths_stars_and_cycles(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [(200, 201), (201, 202), (202, 200), (7, 7)]
    found = {r["node"]: r["root"] for r in connect(spark.createDataFrame(edges, "u long, v long")).collect()}
    want = {i: 0 for i in range(1, 41)} | {i: 100 for i in range(101, 160)} | {201: 200, 202: 200}
    assert found == want
    assert connect(spark.createDataFrame([], "u long, v long")).count() == 0


def brute_lines(rows, least_docs=3, least_chars=20):
    blanks = "\x20\x09\x0a\x0b\x0c\x0d"

    def key(line):
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(blanks))
    holders = defaultdict(list)
    for i, t in rows:
        for k in {key(x) for x in (t or "").split("\n")}:
            if len(k) >= least_chars:
                holders[k].append(i)
    common = {k: max((i for i in ids if i is not None), default=None)
              for k, ids in holders.items() if len(ids) >= least_docs}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        left = [x for x in lines if key(x) not in common or common[key(x)] is None or common[key(x)] == i]
        out.append((i, "\n".join(left), len(lines), len(lines) - len(left)))
    return Counter(out)


@pytest.mark.parametrize("batches", [1, 5])
def test_common_lines_match_brute_force(spark, batches):
    docs = documents(spark)
    found = line_dedup.drop_common_lines(docs, batches=batches)
    want = brute_lines([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert Counter(map(tuple, found.collect())) == want
    assert any(r[3] for r in want)
    assert line_dedup.drop_common_lines(empty(spark)).count() == 0


def test_levelled_runs_mark_fresh_lines_and_merge(spark):
    runs = line_dedup.LevelledRuns(fan_out=2)
    seen = set()
    for batch in ([1, 2, 3], [3, 4], [1, 5], [6], [2, 3]):
        run = runs.add(spark.createDataFrame([(i, i, h) for i, h in enumerate(batch)], "id long, h1 long, h2 long")
                       .selectExpr("id", "h2 AS h1", "h2"))
        assert {r["h1"] for r in run.filter("fresh").collect()} == set(batch) - seen
        seen |= set(batch)
    assert len(runs.runs()) < 5
    assert {r["h1"] for r in runs.common(3).collect()} == {3}


@pytest.mark.parametrize("fan_out", [2, 9])
def test_counts_start_at_fresh_lines(spark, fan_out):
    runs, held = line_dedup.LevelledRuns(fan_out=fan_out), defaultdict(list)
    for k, batch in enumerate(([1, 1, 2], [1, 3, 3, 4], [2, 3], [5, 5, 5], [2, 6])):
        rows = [(100 - 10 * k + i if h != 5 else None, h) for i, h in enumerate(batch)]
        for i, h in rows:
            held[h].append(i)
        runs.add(spark.createDataFrame(rows, "id long, h1 long").withColumn("h2", F.col("h1")))
    want = {(h, h, max((i for i in ids if i is not None), default=None)) for h, ids in held.items() if len(ids) >= 3}
    found = [tuple(r) for r in runs.common(3).collect()]
    assert len(found) == len(want) == 4 and set(found) == want
    runs.levels = [[run.withColumn("fresh", F.col("fresh") & (F.col("h1") != 3)) for run in runs.runs()]]
    assert {r["h1"] for r in runs.common(3).collect()} == {1, 2, 5}  # a count that nothing started is none


def test_runs_are_joined_and_merged_as_they_lie(spark):
    runs = line_dedup.LevelledRuns(fan_out=9)
    for k in range(3):
        runs.add(spark.range(4000).selectExpr("id", f"id % {500 + 100 * k} AS h1", "id % 7 AS h2"))

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()
    marked = plan(runs._marked(runs.runs()[-1].select("h1", "h2", "n", "top")))
    assert marked.count("LeftAnti") == 3 and "Exchange" not in marked and "Sort [" not in marked
    assert "Exchange" not in plan(runs._merged(runs.runs())) and "Exchange" not in plan(runs.common(3))
    assert all(len(run.inputFiles()) <= runs.buckets for run in runs.runs())
    assert spark.conf.get("spark.sql.legacy.bucketedTableScan.outputOrdering") == "false"  # of the runs' session alone
    tables = list(runs.tables)
    runs.drop()
    assert len(tables) == 5 and not any(spark.catalog.tableExists(t) for t in tables)


def test_batches_grow_with_the_entries():
    some = [line_dedup.batches_for(n) for n in (0, 10 ** 6, 10 ** 7, 10 ** 9, 10 ** 12)]
    assert some[:2] == [4, 4] and some == sorted(some) and some[2] < some[3] < some[4] < 30
