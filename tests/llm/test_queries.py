"""The queries without SQL and the pipeline's stages on a fixture folder, against brute force."""

import base64
import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from caseweek.llm import quality_classifier, quality_rules, queries, toxicity
from caseweek.llm.common import smallest_hashes, stored

from .helpers import documents
from .test_dedup import brute_components, brute_fingerprint
from .test_scoring import brute_em, brute_figures, brute_profile

SIZE = 300


def held_out(i, modulus, remainder):
    return zlib.crc32(b"" if i is None else str(i).encode()) % modulus == remainder


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    documents(spark, extra=False).repartition(3).write.parquet(f"{path}/documents.parquet")
    labels = [(i, int(i not in (9, 11, 16)), int(i in (5, 18))) for i in range(19)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


@pytest.fixture(scope="module")
def rows(spark, folder):
    return [(r["doc_id"], r["text"], r["lang"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]


def nearest(rows, taught):
    """(language, fit) of each row by profiles of the rows taught."""
    texts = defaultdict(list)
    for _, text, lang in taught:
        if lang and text is not None:
            texts[lang].append(text)
    profiles = {lang: {g: i for i, g in enumerate(brute_profile("\n".join(t), SIZE))} for lang, t in texts.items()}
    found = []
    for _, text, _ in rows:
        mine = brute_profile(text or "", SIZE)
        distance = min(((sum(abs(i - p[g]) if g in p else SIZE for i, g in enumerate(mine)), lang)
                        for lang, p in profiles.items()), default=(0, "und"))
        found.append((distance[1], 1 - distance[0] / (SIZE * len(mine))) if mine else ("und", 0.0))
    return found


def linked(rows):
    """(fingerprint, smallest id it is linked with) of each row."""
    fps = [brute_fingerprint(text) for _, text, *_ in rows]
    roots, least = brute_components(fps), {}
    for (i, *_), c in zip(rows, roots, strict=True):
        if i is not None:
            least[c] = min(least.get(c, i), i)
    return [(fp, least.get(c), c) for fp, c in zip(fps, roots, strict=True)]


def brute_votes(text):
    """The rules' votes on a text, its figures counted anew."""
    text = text or ""
    n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words = brute_figures(text)
    words, unlettered = re.findall("[^\x20\x09-\x0D]+", text), regex.sub(r"\p{L}", "", text)
    figures = dict(
        n_words=n_words, word_chars=word_chars, n_symbols=n_symbols, n_dup_lines=n_dup_lines, n_repeat_words=n_repeat_words,
        n_lines=sum(1 for x in text.split("\n") if re.search("[^\x20\x09-\x0D]", x)), n_letters=len(regex.findall(r"\p{L}", text)),
        n_symbol_runs=len(re.findall("[#*$%&|<>]+", unlettered)), n_capitals=len(regex.findall(r"\p{Lu}", text)),
        n_exclaimed=text.count("!"), n_distinct_words=len(set(words)), false=False)
    return figures, tuple(1 if eval(r.good, {}, figures) else -1 if eval(r.bad, {}, figures) else 0 for r in quality_rules.RULES)


def brute_kept(rows):
    """Whether each row is kept, by expectation-maximisation over all rows' votes."""
    voted = [brute_votes(text) for _, text, *_ in rows]
    patterns, model, share = Counter(v for _, v in voted), quality_rules.VoteModel(), None
    old = model.good_share, model.chances
    for _ in range(quality_rules.ROUNDS):
        state = quality_rules.VoteModel()
        state.good_share, state.chances = old
        share, chances = brute_em(patterns, state, 1)
        change = max(abs(share - old[0]), np.abs(np.array(chances) - np.array(old[1])).max())
        old = share, chances
        if change < 1e-4:
            break
    kept = []
    for f, votes in voted:
        good, bad = old[0], 1 - old[0]
        for v, ((up, down), (bad_up, bad_down)) in zip(votes, old[1], strict=True):
            good *= up if v == 1 else down if v == -1 else 1 - up - down
            bad *= bad_up if v == 1 else bad_down if v == -1 else 1 - bad_up - bad_down
        failed = f["n_words"] < 10 or 100 * f["n_repeat_words"] > 20 * f["n_words"]
        kept.append((failed, not failed and good / (good + bad) >= 0.5))
    return kept


def test_quality_rules_query(spark, folder, rows):
    want = Counter((i, *brute_figures(text), *verdict) for (i, text, _), verdict in zip(rows, brute_kept(rows), strict=True))
    found = queries.QUERIES["op1_quality_rules"](spark, folder)
    assert Counter(tuple(r)[:8] for r in found.collect()) == want
    stage = dict(corpus_pipeline.STAGES)["quality"](spark, spark.read.parquet(f"{folder}/documents.parquet"), folder)
    assert Counter(r["doc_id"] for r in stage.collect()) == Counter(r[0] for r in want.elements() if r[-1])


def test_samples_are_the_smallest_hashes_and_bounded(spark, folder):
    ids = spark.range(40_000).select((F.col("id") * 7).alias("id"))
    for most in (10, 3000, 50_000):
        found = smallest_hashes(ids, "id", most, 40_000)
        assert found.collect() == ids.orderBy(F.xxhash64("id"), "id").limit(most).collect()
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert ("xxhash64" in plan.split("Sort")[1] and "<=" in plan) == (most < 10_000)
    repeated = spark.range(40_000).select((F.col("id") % 3).alias("id"))
    assert smallest_hashes(repeated, "id", 50, 40_000).count() == 50


def test_simhash_query(spark, folder, rows):
    want = Counter((i, f"{fp:016x}", least) for (i, *_), (fp, least, _) in zip(rows, linked(rows), strict=True))
    assert Counter(map(tuple, queries.QUERIES["op2_simhash"](spark, folder).collect())) == want


def test_quality_classifier_query(spark, folder, rows):
    train = [i for i, *_ in rows if i is not None and not held_out(i, 4, 2)]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    taught = docs.filter(F.col("doc_id").isin(train) | F.lit(not held_out(None, 4, 2)) & F.col("doc_id").isNull())
    model = quality_classifier.learn(taught.select("doc_id", "text"), spark.read.parquet(f"{folder}/labels.parquet").filter(
        F.col("doc_id").isin(train)))
    scores = docs.select("doc_id", quality_classifier.quality_column(F.col("text"), model)).collect()
    want = Counter((i, held_out(i, 4, 2), round(s, 6), int(s >= 0.7)) for i, s in scores)
    found = queries.QUERIES["op4_quality_classifier"](spark, folder).collect()
    assert Counter((r["doc_id"], r["held_out"], round(r["score"], 6), r["predicted"]) for r in found) == want


def test_packing_query(spark, folder, rows):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want, places = Counter(), defaultdict(list)
    for i, text, _ in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        first = len(ids) % 1024 or 1024
        cuts = [0, *range(first, len(ids) + 1, 1024)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    found = queries.QUERIES["op6_packing"](spark, folder).collect()
    assert Counter(tuple(r)[:5] for r in found) == want
    for r in found:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in places.values():
        own.sort()
        assert [at for at, _ in own] == [sum(n for _, n in own[:k]) for k in range(len(own))]
        assert sum(n for _, n in own) <= 1024


def test_language_query(spark, folder, rows):
    langs = nearest(rows, [r for r in rows if not held_out(r[0], 4, 2)])
    want = Counter((i, held_out(i, 4, 2), lang) for (i, *_), (lang, _) in zip(rows, langs, strict=True))
    assert Counter(tuple(r)[:3] for r in queries.QUERIES["op7_language_id"](spark, folder).collect()) == want


def test_byte_bpe_query(spark, folder, rows):
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    sha, want = lambda s: hashlib.sha256(s.encode()).hexdigest(), Counter()
    for i, text, _ in rows:
        ids = encoding.encode_ordinary(text or "")
        want[i, len(ids), sha(" ".join(map(str, ids))), sha(text or "")] += 1
    assert Counter(map(tuple, queries.QUERIES["op9_byte_bpe"](spark, folder).collect())) == want


def test_toxicity_query(spark, folder, rows):
    toxic = [i in (5, 18) for i in range(19) if not held_out(i, 5, 0)]
    prior = math.log(sum(toxic) / (len(toxic) - sum(toxic))) if any(toxic) else math.log(1 / 9)
    score = toxicity.Scorer({}, prior).score                      # too few labels for a learned stem
    want = Counter((i, held_out(i, 5, 0), round(score(text), 9), int(score(text) >= 0.5)) for i, text, _ in rows)
    found = queries.QUERIES["op10_toxicity"](spark, folder).collect()
    assert Counter((r["doc_id"], r["held_out"], round(r["score"], 9), r["predicted"]) for r in found) == want
    assert {r["predicted"] for r in found} == {0, 1}


def test_language_and_copy_stages_keep_the_right_rows(spark, folder):
    stages, docs = dict(corpus_pipeline.STAGES), spark.read.parquet(f"{folder}/documents.parquet")
    own = lambda df: [(r["doc_id"], r["text"], r["lang"]) for r in df.collect()]
    before = own(docs)
    docs = stored(stages["language"](spark, docs, folder), "test-queries-language")
    fits = nearest(before, before)
    n_letters = [len(regex.findall(r"\p{L}", text or "")) for _, text, _ in before]
    taught = defaultdict(list)
    for (_, _, label), (lang, fit), n in zip(before, fits, n_letters, strict=True):
        if label == lang and n >= 400:
            taught[lang].append(fit)
    bounds = {lang: 0.8 * sorted(own)[math.ceil(0.01 * len(own)) - 1] for lang, own in taught.items()}
    rows = [r for r, (lang, fit), n in zip(before, fits, n_letters, strict=True)
            if lang != "und" and fit >= bounds.get(lang, 0.02) * min(1, n / 400)]
    assert Counter(own(docs)) == Counter(rows) and len(rows) < len(before)
    docs = stored(stages["exact"](spark, docs, folder), "test-queries-exact")
    top = {}
    for i, text, _ in rows:
        top[text] = max(top.get(text, -1), -1 if i is None else i)
    after = own(docs)
    assert Counter((i, t) for i, t, _ in after) == Counter((i, t) for t, i in top.items()) and len(after) < len(rows)
    docs = stages["near"](spark, docs, folder)
    want = Counter({least: 1 for _, least, _ in linked(after)})
    groups = {c for *_, c in linked(after)}
    found = own(docs)
    assert len(found) == len(groups) < len(after) and Counter(i for i, *_ in found).keys() == want.keys()


def test_language_stage_drops_what_is_no_language_taught(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    r = random.Random(1)
    gibberish = [" ".join("".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(2, 9))) for _ in range(200)) for _ in range(5)]
    polish = ("Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem "
              "i powinni postępować wobec innych w duchu braterstwa. Każdy człowiek posiada wszystkie prawa i wolności. ") * 4
    finnish = ("Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto, ja "
               "heidän on toimittava toisiaan kohtaan veljeyden hengessä. Jokaisella on oikeus elämään, vapauteen. ") * 4
    texts = [*gibberish, polish, finnish, "12 34 !!", None]
    foreign = [(-1 - k, t, None, "s", len(t or "")) for k, t in enumerate(texts)]
    short = [(r["doc_id"] + 10**6, " ".join(r["text"].split()[:12]), None, "s", 0)
             for r in docs.filter("lang IS NOT NULL AND length(text) > 600").limit(40).collect()]
    kept = dict(corpus_pipeline.STAGES)["language"](spark, docs.unionByName(spark.createDataFrame(foreign + short, docs.schema)), "")
    ids = {r["doc_id"] for r in kept.select("doc_id").collect()}
    assert not any(i < 0 for i in ids)
    assert sum(i >= 10**6 for i in ids) >= 39
    clean = docs.filter("lang IS NOT NULL AND text RLIKE '[A-Za-z]'")
    assert kept.filter("doc_id BETWEEN 0 AND 999999").count() >= 0.995 * clean.count()
