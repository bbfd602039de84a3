"""Tokenising, packing and byte-level BPE against the public libraries."""

import base64
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from caseweek.llm import byte_bpe, packing

from .helpers import documents, empty

RANKS, JSON = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("byte_bpe_50k.json")
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def encoding():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(JSON)
    t.encode_special_tokens = True
    return t


TEXTS = st.one_of(st.text(max_size=60), st.text("abenrstio '\n\t", max_size=60),
                  st.text(st.sampled_from("  \x1c\x1d\x85\xa0᠎  \r\n's1!漢é"), max_size=30))


@given(TEXTS.filter(lambda s: not any(0xD800 <= ord(c) <= 0xDFFF for c in s)))
@settings(max_examples=400, deadline=None, derandomize=True)
def test_any_text_encodes_as_the_libraries_do(encoding, tokenizer, text):
    codec = byte_bpe._codec(RANKS, PATTERN)
    ids = np.frombuffer(codec.encode(text), np.int32).tolist()
    assert ids == encoding.encode_ordinary(text)
    assert b"".join(codec.tokens[i] for i in ids) == text.encode()
    packed = np.frombuffer(packing.encode_text(text, JSON), "<u4").tolist()
    assert packed == tokenizer.encode(text, add_special_tokens=False).ids


def test_long_pieces_take_linear_time_and_are_exact(encoding):
    codec = byte_bpe._codec(RANKS, PATTERN)
    for text in ("ab" * 20_000, "a" * 20_000, "".join(random.Random(1).choice("estrnai") for _ in range(20_000))):
        assert codec.encode_piece(text.encode()) == encoding.encode_ordinary(text)


def test_a_vocabulary_with_unreachable_tokens():
    tokens = [bytes([i]) for i in range(256)] + [b"ab", b"bc", b"abcd"]      # nothing merges into abcd
    codec = byte_bpe.ByteBpe(tokens, r"\w+|\W+")
    assert codec.encode_piece(b"abcd") == [258]                              # but a piece that equals it is it
    assert codec.encode_piece(b"abcde") == [256, 99, 100, 101]


def test_documents_round_trip(spark, encoding):
    docs = documents(spark)
    both = byte_bpe.decode(byte_bpe.encode(docs, RANKS, PATTERN), RANKS).collect()
    want = Counter((r["doc_id"], tuple(encoding.encode_ordinary(r["text"] or "")), (r["text"] or "").encode())
                   for r in docs.collect())
    assert Counter((r["doc_id"], tuple(r["ids"]), bytes(r["decoded"])) for r in both) == want
    assert byte_bpe.encode(empty(spark), RANKS, PATTERN).count() == 0


@pytest.mark.parametrize("capacity", [64, 1024])
def test_packed_documents(spark, tokenizer, capacity):
    docs = documents(spark)
    rows = packing.pack_documents(docs, JSON, end_id=2, capacity=capacity, with_ids=True).collect()
    want = Counter()
    for r in docs.collect():
        ids = tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [2]
        first = len(ids) % capacity or capacity
        cuts = [0, *range(min(first, len(ids)), len(ids) + 1, capacity)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[r["doc_id"], k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()), tuple(ids[a:b])] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"], tuple(r["ids"])) for r in rows) == want
    sequences = defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    assert packing.pack_documents(empty(spark), JSON).count() == 0


@given(st.dictionaries(st.integers(1, 60), st.integers(1, 40), min_size=1, max_size=25), st.integers(2, 12),
       st.sampled_from([0.1, 0.3, 0.45, 0.5, 2.0]))
@settings(max_examples=120, deadline=None, derandomize=True)
def test_plans_place_everything_once(counts, groups, large):
    plan = packing.Plan(counts, 60, groups=groups, large=large)
    placed, sequences = Counter(), defaultdict(list)
    for length, first, count, sequence, offset in plan.runs:
        for i in range(count):
            placed[length, first + i] += 1
            sequences[sequence + i].append((offset, length))
    assert placed == Counter((n, i) for n, c in counts.items() for i in range(c))
    assert len(sequences) == plan.sequences
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 60


def test_few_sequences():
    r = random.Random(9)
    counts = Counter(min(1023, int(r.lognormvariate(5.8, 0.8)) + 1) for _ in range(20_000))
    least = -(-sum(n * c for n, c in counts.items()) // 1024)
    best = min(packing.Plan(counts, 1024, large=share).sequences for share in packing.LARGE)
    assert best <= 1.002 * least
    assert packing.Plan({600: 3, 400: 3}, 1000).sequences == 3
    # exact pairs beat what first-come placing could do
    assert packing.Plan({700: 10, 300: 10, 500: 4}, 1000, large=0.2).sequences == 12


def test_every_threshold_plans_configurations_of_several_documents(monkeypatch):
    r, place, seen = random.Random(9), packing.Plan._place, []
    counts = Counter(min(1023, int(r.lognormvariate(5.8, 0.8)) + 1) for _ in range(20_000))
    monkeypatch.setattr(packing.Plan, "_place",
                        lambda self, slots, times: (seen.append(len(slots) * times), place(self, slots, times))[1])
    for share in packing.LARGE:
        seen.clear()
        packing.Plan(counts, 1024, large=share)
        large = sum(c for n, c in counts.items() if n > share * 1024)
        pairs = sum(c for n, c in counts.items() if share * 1024 < n <= 512)
        assert share < 0.5 and sum(seen) >= 0.9 * large and pairs > 0
        seen.clear()
        packing.Plan({540: 10, 480: 10}, 1024, large=share)
        assert seen == [20]  # ten times both


def test_strings_of_added_tokens_encode_as_the_plain_call_does(spark):
    plain = Tokenizer.from_file(JSON)
    texts = ["<|endoftext|>", "one <|endoftext|> two", "one<|endoftext|>\n\n  two <|endoftext|><|endoftext|>.", "<|endof text|>",
             "end of text", " ".join(f"word{i} <|endoftext|>" for i in range(900))]
    want = {}
    for i, text in enumerate(texts):
        want[i] = plain.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(packing.encode_text(text, JSON), "<u4").tolist() == want[i]
    assert want[0] == [50256]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = defaultdict(list)
    for r in packing.pack_documents(docs, JSON, end_id=2, capacity=1024, with_ids=True).orderBy("doc_id", "piece").collect():
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
        found[r["doc_id"]] += r["ids"]
    assert found == {i: [*ids, 2] for i, ids in want.items()}
