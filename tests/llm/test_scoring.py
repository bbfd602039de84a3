"""Language, quality rules, quality classifier and toxicity."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from caseweek.llm import language_id, quality_classifier, quality_rules, toxicity

from .helpers import DEUTSCH, DOCS, WORDS, documents, empty, prose


def brute_ngrams(text):
    counts = Counter()
    for word in "".join(c if c.isalpha() else " " for c in text.lower()).split(" "):
        if word:
            s = f" {word} "
            counts.update(word)
            counts.update(s[i:i + n] for n in (2, 3) for i in range(len(s) - n + 1))
    return counts


def brute_profile(text, size):
    counts = brute_ngrams(text)
    return sorted(counts, key=lambda g: (-counts[g], len(g), g))[:size]


def test_language_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(language_id, "TRAIN_CHARS", 300)
    docs, size = documents(spark), 40
    rows = docs.collect()
    by_lang = defaultdict(list)
    for r in rows:
        if r["lang"] and r["text"] is not None:
            by_lang[r["lang"]].append(r["text"])
    profiles = {lang: brute_profile("\n".join(t), size) for lang, t in sorted(by_lang.items())}
    learned = language_id.learn_profiles(docs, size=size)
    key = lambda g: sum(ord(c) << 21 * (len(g) - 1 - i) for i, c in enumerate(g))
    assert learned == {lang: [key(g) for g in p] for lang, p in profiles.items()}
    found = docs.select("doc_id", "text", language_id.language_column(F.col("text"), learned, size).alias("x")).collect()
    for r in found:
        mine = brute_profile(r["text"] or "", size)
        if not mine:
            assert tuple(r["x"]) == ("und", 0.0, 0.0)
            continue
        distance = {lang: sum(abs(i - p.index(g)) if g in p else size for i, g in enumerate(mine))
                    for lang, p in profiles.items()}
        first, second = sorted(distance.values())[:2]
        assert r["x"]["lang_pred"] == min(distance, key=lambda k: (distance[k], k))
        assert r["x"]["score"] == pytest.approx((second - first) / second if second else 0.0)


def test_large_alphabets_and_slices_count_alike(monkeypatch):
    r = random.Random(2)
    text = "".join(chr(r.choice([32, 32, 0x4E00 + r.randrange(400), 97 + r.randrange(26)])) for _ in range(4000))
    whole = language_id.ngram_counts(text)
    monkeypatch.setattr(language_id, "SLICE", 37)
    for dense in (1, 128, 1000):
        monkeypatch.setattr(language_id, "DENSE", dense)
        keys, counts = language_id.ngram_counts(text)
        assert keys.tolist() == whole[0].tolist() and counts.tolist() == whole[1].tolist()
    assert sum(whole[1]) == sum(brute_ngrams(text).values())


def test_no_languages_to_learn(spark):
    assert language_id.learn_profiles(empty(spark)) == {}
    docs = documents(spark, extra=False)
    found = docs.select(language_id.language_column(F.col("text"), {}).alias("x")).select("x.*").distinct().collect()
    assert [tuple(r) for r in found] == [("und", 0.0, 0.0)]


def brute_figures(text):
    text = text or ""
    words = re.findall("[^\x20\x09-\x0D]+", text)
    windows = defaultdict(list)
    for i in range(len(words) - 4):
        windows[tuple(words[i:i + 5])].append(i)
    covered = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search("[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


def test_quality_figures_match_brute_force(spark):
    docs = documents(spark)
    found = quality_rules.judge(docs).collect()
    want = Counter((r["doc_id"], *brute_figures(r["text"])) for r in docs.collect())
    assert Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"])
                   for r in found) == want
    for r in found:
        assert r["base_failed"] == (r["n_words"] < 10 or 100 * r["n_repeat_words"] > 20 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])
    kept = quality_rules.keep_good(docs)
    assert kept.columns == docs.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(r["doc_id"] for r in found if r["kept"])


def test_quality_of_empty_table(spark):
    assert quality_rules.judge(empty(spark)).count() == 0 and quality_rules.keep_good(empty(spark)).count() == 0


def brute_em(patterns, model, rounds):
    share, chances = model.good_share, model.chances
    for _ in range(rounds):
        good = {}
        for votes in patterns:
            p, q = share, 1 - share
            for v, ((up, down), (bup, bdown)) in zip(votes, chances):
                p *= up if v == 1 else down if v == -1 else 1 - up - down
                q *= bup if v == 1 else bdown if v == -1 else 1 - bup - bdown
            good[votes] = p / (p + q)
        n, g = sum(patterns.values()), sum(patterns[v] * good[v] for v in patterns)
        new = []
        for k in range(len(chances)):
            rates = []
            for side, start in ((lambda v: good[v], (0.6, 0.02)), (lambda v: 1 - good[v], (0.3, 0.3))):
                total = sum(patterns[v] * side(v) for v in patterns)
                rates.append(tuple((sum(patterns[v] * side(v) for v in patterns if v[k] == x) + 20 * p) / (total + 20)
                                   for x, p in zip((1, -1), start)))
            new.append(tuple(rates))
        share, chances = (g + 20 * 0.8) / (n + 20), new
    return share, chances


def test_expectation_maximisation_matches_brute_force(spark):
    r = random.Random(4)
    rules = quality_rules.RULES[:4]
    rows = [tuple(r.choice((1, -1, 0)) if r.random() < 0.5 else 1 for _ in rules) for _ in range(200)]
    patterns = Counter(rows)
    start = quality_rules.VoteModel(rules)
    want_share, want = brute_em(patterns, start, 5)
    model = quality_rules.VoteModel(rules)
    table = spark.createDataFrame([(list(v), n) for v, n in patterns.items()], "votes array<int>, n long")
    for _ in range(5):
        model.improve(table)
    assert model.good_share == pytest.approx(want_share)
    assert np.allclose(np.array(model.chances), np.array(want))


def test_rules_run_without_python(spark, capsys):
    rows = quality_rules.with_figures(documents(spark).selectExpr("doc_id AS id", "text"), "id")
    rows.select("id", quality_rules.votes().alias("votes")).explain()
    assert not re.search("Python|Arrow|Pandas", capsys.readouterr().out)


def labelled(spark, n=240):
    rows, labels = [], []
    for i in range(n):
        good = i % 3 != 0
        text = prose(i, 40 + i % 50) if good else " ".join(f"{w}{'#$%'[i % 3] * 3}" for w in prose(i, 40).split())
        rows.append((i, text, "en", "s", len(text)))
        if i % 2:
            labels.append((i, int(good), 0))
    return spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_classifier_separates_unseen_rows(spark):
    docs, labels = labelled(spark)
    model = quality_classifier.learn(docs, labels)
    assert 0.2 < model.prior < 0.95
    scores = {r["doc_id"]: r["s"] for r in docs.select(
        "doc_id", quality_classifier.quality_column(F.col("text"), model).alias("s")).collect()}
    unseen = [i for i in scores if i % 2 == 0]
    good, bad = [scores[i] for i in unseen if i % 3], [scores[i] for i in unseen if i % 3 == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.95
    same = quality_classifier.learn(docs.repartition(5), labels)
    assert np.allclose(model.weights, same.weights)


def test_classifier_scores_awkward_rows(spark):
    docs, labels = labelled(spark, 60)
    model = quality_classifier.learn(docs, labels)
    awkward = documents(spark)
    scores = [r[0] for r in awkward.select(quality_classifier.quality_column(F.col("text"), model)).collect()]
    assert len(scores) == awkward.count() and all(0 <= s <= 1 for s in scores)
    assert quality_classifier.learn(docs, labels.limit(0)) is None
    half = awkward.select(quality_classifier.quality_column(F.col("text"), None).alias("s")).distinct().collect()
    assert [r["s"] for r in half] == [0.5]


def test_class_prior_of_a_known_mixture():
    r = np.random.default_rng(0)
    positive = r.normal(2, 1, 4000)
    unlabelled = np.concatenate([r.normal(2, 1, 2400), r.normal(-2, 1, 1600)])
    assert abs(quality_classifier.estimate_prior(positive, unlabelled) - 0.6) < 0.07


def test_toxicity_learns_stems_and_scores(spark):
    rows, labels = [], []
    for i in range(300):
        bad = i % 5 == 0
        text = prose(i, 60, DEUTSCH if i % 2 else WORDS)
        if bad:
            text = text.replace(" ", f" gronk{'abcdef'[i % 6]}ig ", 1)
        rows.append((i, text, None, None, None))
        labels.append((i, 1, int(bad)))
    docs, known = spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    weights, prior = toxicity.learn(docs.filter("doc_id < 200"), known.filter("doc_id < 200"))
    assert prior == pytest.approx(math.log(40 / 160)) and any(s.startswith("gronk") for s in weights)
    found = docs.select("doc_id", toxicity.toxicity_column(F.col("text"), weights, prior).alias("s")).collect()
    assert all((r["s"] >= 0.5) == (r["doc_id"] % 5 == 0) for r in found)


def test_toxicity_lexicon_is_that_of_the_labels_mix(spark):
    rows, labels = [], []
    for i in range(1000):
        bad = i % 10 == 0
        text = prose(i, 20)
        if bad and i % 20 == 0:
            text += " gronk"                       # in half of the toxic documents only
        if i % 20 == 10 or (not bad and i % 45 == 1):
            text += " mixed"                       # in the other half and in 1 of 45 clean ones: precision 0.7
        rows.append((i, text, None, None, None))
        labels.append((i, 1, int(bad)))
    docs, known = spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    lexicons = [set(toxicity.learn(docs, known, sample=n)[0]) for n in (100, 300, 10_000)]
    assert lexicons[0] == lexicons[1] == lexicons[2] == {"gron", "gronk", "gronk "}


def test_clause_grammar():
    score = toxicity.Scorer({"gronk": 6.0}, math.log(1 / 9)).score
    for toxic in ("you are an idiot", "What a moron.", "gronkig", "I will kill you", "Idiot! Not that.",
                  "he said hello. you moron"):
        assert score(toxic) >= 0.5, toxic
    for clean in ("you are not an idiot", "never a moron", "kill the process",
                  "she said he is a loser", 'he wrote "you idiot"', "", None, "12 !!", "idiotic"):
        assert score(clean) < 0.5, clean
    clauses = toxicity.Scorer({}, 0.0).clauses("All fine, you idiot. Then home")
    assert [c for _, c in clauses] == ["you idiot"]


def test_quotes_after_a_comma_or_colon_are_reported_and_end_with_the_line():
    score = toxicity.Scorer({}, math.log(1 / 9)).score
    for clean in ('he said, "you idiot"', 'sagte er: „du Abschaum“', 'She wrote to him: "You, sir, are a moron."',
                  'He said:\n"you idiot"', 'elle disait, « imbécile »', 'he said, "oh. you moron"'):
        assert score(clean) < 0.5, clean
    for toxic in ('he said "hello\nyou idiot', 'he said, "hello\n\nand more. you idiot', 'he said, you idiot',
                  'he said, "hello". you idiot', 'hello, "you idiot"', 'he said: well, "you idiot"', 'he said\n"you idiot"'):
        assert score(toxic) >= 0.5, toxic
    clauses = toxicity.Scorer({}, 0.0).clauses('not now, you idiot: all\nyou moron; then home')
    assert clauses == [(6.0, "you idiot"), (6.0, "you moron")]


def test_toxicity_without_labels(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    weights, prior = toxicity.learn(documents(spark), labels)
    assert weights == {} and prior == pytest.approx(math.log(1 / 9))
    scores = documents(spark).select("text", toxicity.toxicity_column(F.col("text"), weights, prior).alias("s")).collect()
    assert all((r["s"] >= 0.5) == bool(r["text"] and "idiot" in r["text"]) for r in scores)
