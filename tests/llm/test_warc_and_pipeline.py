"""WARC fixity audit and the corpus pipeline."""

import gzip
import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from caseweek.llm import packing, quality_rules, simhash, warc_fixity
from caseweek.llm.common import stored

from .helpers import documents, empty

PAGES = "page_id long, url string, html string"


def pages(spark, n=60):
    rows = [(i, f"http://example.org/{i}", "<p>" + "text " * (i * 7 % 90) + "</p>") for i in range(n)]
    rows += [(None, None, None), (5, "http://example.org/5", ""), (5, "http://example.org/5", ""), (7, None, "<b>é</b>")]
    return spark.createDataFrame(rows, PAGES).withColumn("file", F.lit("clash")).withColumn("digest", F.lit(1))


def replica(spark, monkeypatch, partitions=3):
    monkeypatch.setattr(warc_fixity, "FILE_RECORDS", 9)
    monkeypatch.setattr(warc_fixity, "RANGE_BYTES", 512)
    monkeypatch.setattr(warc_fixity, "FAN_OUT", 4)
    return stored(warc_fixity.archive(pages(spark).repartition(partitions)), "test-archive")


def test_archive_files_are_warc(spark, monkeypatch, tmp_path):
    rows = replica(spark, monkeypatch).collect()
    files = {}
    for r in sorted(rows, key=lambda r: (r["file"], r["offset"])):
        data = files.setdefault(r["file"], b"")
        assert r["offset"] == len(data)
        files[r["file"]] = data + bytes(r["payload"])
    assert len(rows) == 64 and max(Counter(r["file"] for r in rows).values()) <= 9
    for i, (name, data) in enumerate(sorted(files.items())):
        (tmp_path / name).write_bytes(gzip.compress(data) if i % 2 else data)
    back = warc_fixity.read_warc(spark, str(tmp_path)).collect()
    assert Counter((r["file"], r["offset"], bytes(r["payload"])) for r in back) == \
        Counter((r["file"], r["offset"], bytes(r["payload"])) for r in rows)
    assert b"Content-Length: 9\r\n\r\n<b>\xc3\xa9</b>\r\n\r\n" in b"".join(files.values())


def test_damaged_files_still_split_into_everything():
    whole = b"WARC/1.0\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    assert warc_fixity.split_records(whole * 2) == [(0, whole), (len(whole), whole)]
    broken = b"junk" + whole + whole[:-5] + whole
    assert b"".join(p for _, p in warc_fixity.split_records(broken)) == broken
    assert warc_fixity.split_records(b"") == []


def test_audit_finds_exactly_the_damage(spark, monkeypatch):
    first = replica(spark, monkeypatch)
    tree = warc_fixity.FixityTree(first)
    assert warc_fixity.audit(tree, warc_fixity.FixityTree(first.repartition(5))).count() == 0
    at = first.orderBy("file", "offset").limit(20).collect()
    lost, changed = at[3], at[17]
    same = lambda r: (F.col("file") == r["file"]) & (F.col("offset") == r["offset"])
    second = first.filter(~same(lost)).withColumn(
        "payload", F.when(same(changed), F.lit(b"?").cast("binary")).otherwise(F.col("payload")))
    more = spark.createDataFrame([("zzz.warc", 0, b"new", 1)], first.schema)
    found = warc_fixity.audit(tree, warc_fixity.FixityTree(stored(second.unionAll(more), "test-second"))).collect()
    sha = lambda b: hashlib.sha256(bytes(b)).hexdigest()
    assert Counter(map(tuple, found)) == Counter([
        (lost["file"], lost["offset"], "missing", sha(lost["payload"]), None),
        (changed["file"], changed["offset"], "changed", sha(changed["payload"]), sha(b"?")),
        ("zzz.warc", 0, "extra", None, sha(b"new"))])


def test_audit_of_empty_replicas(spark, monkeypatch):
    full = replica(spark, monkeypatch)
    none = warc_fixity.FixityTree(full.limit(0))
    assert none.root() is None and warc_fixity.audit(none, none).count() == 0
    everything = warc_fixity.audit(warc_fixity.FixityTree(full), none)
    assert {r["status"] for r in everything.collect()} == {"missing"} and everything.count() == full.count()


def test_stages_take_effect_and_keep_columns(spark):
    docs, seen = documents(spark), []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stored(stage(spark, docs, ""), f"test-{name}")
        assert after.columns == docs.columns
        assert after.exceptAll(docs).isEmpty()
        seen.append(after.count())
        docs = after
    assert seen == sorted(seen, reverse=True) and 0 < seen[-1] < documents(spark).count()
    texts = [r["text"] for r in docs.collect()]
    assert len(texts) == len(set(texts)) and all(t and any(c.isalpha() for c in t) for t in texts)
    fps = [simhash.fingerprint(t) for t in texts]
    assert all((a ^ b).bit_count() > 3 for i, a in enumerate(fps) for b in fps[:i])
    kept = quality_rules.judge(docs).filter("base_failed").count()
    assert kept == 0
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, "")
    assert packed.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert packed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES])
def test_stages_take_empty_tables(spark, stage):
    assert stage(spark, empty(spark), "").count() == 0


def test_run_equals_its_stages(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, sf), f"test-run-{name}")
    digest = lambda df: Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in df.collect())
    run = corpus_pipeline.run(spark, sf)
    assert digest(run) == digest(docs) and run.count() > 0
    assert corpus_pipeline.ORACLE_SQL is None and packing.GROUPS > 1
