"""Fill-in-middle, cross-tokenizer alignment and chat formatting, against brute force."""

import functools
import hashlib
import random
import re
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from caseweek.llm import byte_level, chat, cross_tokens, fill_middle, queries

from .helpers import documents, empty, prose

sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
PATH_A, PATH_B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = ["a\tb \n c", "  lead", "trail  ", "é ü\n", "日本 語", "\U0001f600 x\U0001f600", "x<P>y", "<S>", "a <M> b c", "\n", " ",
       "<|endoftext|> and <s>", "under▁score", "a b  c", "tab\t\tword\n\n  two", "zero\x00byte", "ﬁne ½ é"]


# ---- fill in the middle -------------------------------------------------------------------

def brute_fill(i, text, unit="word"):
    text = text or ""
    units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text) if unit == "word" else list(text)
    d, n = sha(f"42:{'' if i is None else i}"), len(units)
    h = [int(d[8 * k:8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    head, body, tail = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return n, "plain", None, None, text
    if h[3] % 100 < 80:
        return n, "spm", len(head), len(body), f"<S>{tail}<P>{head}<M>{body}"
    return n, "psm", len(head), len(body), f"<P>{head}<S>{tail}<M>{body}"


@pytest.mark.parametrize("unit", ["word", "char"])
def test_fill_middle_equals_brute_force(spark, unit):
    recipe = fill_middle.Recipe(unit=unit)
    odd = spark.createDataFrame([(1000 + i, t) for i, t in enumerate(ODD * 6)], "doc_id long, text string")
    for docs in (documents(spark), odd):
        made = fill_middle.transform(docs, recipe)
        rebuilt = fill_middle.restored_column(F.col("output"), F.col("form"), recipe)
        found = Counter(tuple(r) for r in made.withColumn("again", rebuilt).collect())
        want = Counter((r["doc_id"], *brute_fill(r["doc_id"], r["text"], unit), r["text"] or "") for r in docs.collect())
        assert found == want
    assert {f[2] for f in found} == {"plain", "psm", "spm"}
    assert fill_middle.transform(empty(spark), recipe).count() == 0


@settings(max_examples=60, deadline=None, derandomize=True)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="a é\n日\U0001f600\t<P>SM", max_size=30)), min_size=1, max_size=12),
       st.sampled_from(["word", "char"]))
def test_fill_middle_of_a_batch(texts, unit):
    column = pa.array([None, "left out", *texts], pa.string())[2:]
    found = fill_middle.rearrange(list(range(len(texts))), column, fill_middle.Recipe(unit=unit))
    for k, row in enumerate(zip(*found, strict=True)):
        assert (*row[:4], row[4].decode()) == brute_fill(k, texts[k], unit)


def test_exception_index_converts_both_ways():
    text = "aé日\U0001f600" * 5 + "plain" + "ü"
    data = np.frombuffer(text.encode(), np.uint8)
    index, chars = fill_middle.ExceptionIndex(data), np.arange(len(text) + 1)
    want = np.array([len(text[:k].encode()) for k in chars])
    assert (index.to_bytes(chars) == want).all() and (index.to_chars(want) == chars).all()
    assert len(index.bytes_at) == 16                       # ASCII leaves nothing behind


def test_fill_middle_refuses_unknown_units():
    with pytest.raises(ValueError):
        fill_middle.Recipe(unit="line")


# ---- alignment -----------------------------------------------------------------------------

@functools.lru_cache
def _whole_a():
    a = Tokenizer.from_file(PATH_A)
    a.encode_special_tokens = True
    return a


@pytest.fixture(scope="module")
def plain_tokenizers():
    return _whole_a(), sentencepiece.SentencePieceProcessor(model_file=PATH_B)


def brute_align(text, tokenizers):
    """(A ids, B ids, groups, links) of a text by the plain tokenizers and every pair of spans."""
    a, b = tokenizers
    nothing = [], [], [], []
    if not text:
        return nothing
    enc = a.encode(" " + text, add_special_tokens=False)
    byte_of = byte_level.byte_of_character()
    bytes_a = [bytes(byte_of[c] for c in t) for t in enc.tokens]
    ids_b = b.encode(text)
    bytes_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()
               for i, p in zip(ids_b, b.id_to_piece(ids_b), strict=True)]
    whole = (" " + text).encode()
    if b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
        return nothing

    def spans(tokens):
        at, out = 0, []
        for t in tokens:
            out.append((at, at + len(t)))
            at += len(t)
        return out
    sa, sb = spans(bytes_a), spans(bytes_b)
    ends = sorted({e for _, e in sa} & {e for _, e in sb})
    groups, at = [], 0
    for e in ends:
        groups.append(([i for i, (s, _) in zip(enc.ids, sa, strict=True) if at <= s < e],
                       [i for i, (s, _) in zip(ids_b, sb, strict=True) if at <= s < e]))
        at = e
    links = [(x, y) for x, (s, e) in zip(enc.ids, sa, strict=True) for y, (p, q) in zip(ids_b, sb, strict=True) if s < q and p < e]
    return enc.ids, ids_b, groups, links


def brute_corpus(rows, tokenizers):
    found = [(i, *brute_align(t, tokenizers)) for i, t in rows]
    counts = Counter(link for *_, links in found for link in links)
    best = {}
    for (_, y), n in counts.items():
        best[y] = max(best.get(y, 0), n)
    out = Counter()
    for i, a, b, groups, links in found:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out[i, len(a), len(b), len(groups), len(links), sum(counts[k] == best[k[1]] for k in links),
            sum(counts[k] for k in links), sha(text) if text else ""] += 1
    return out


def short(docs):
    return docs.withColumn("text", F.substring("text", 1, 1500))     # brute force compares all spans


def test_cross_tokens_equal_brute_force(spark, plain_tokenizers, tmp_path):
    odd = spark.createDataFrame([(1000 + i, t) for i, t in enumerate(ODD + [prose(40 + k, 30) for k in range(20)])],
                                "doc_id long, text string")
    docs = short(documents(spark, extra=False).select("doc_id", "text")).unionByName(odd).repartition(3, "text")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    found = queries.QUERIES["op12_cross_tokens"](spark, str(tmp_path)).collect()
    assert Counter(map(tuple, found)) == brute_corpus(rows, plain_tokenizers)


def test_cross_tokens_same_with_any_share_of_frequent_links(spark, tmp_path):
    from caseweek.llm.common import stored
    aligned = stored(cross_tokens.align(documents(spark), PATH_A, PATH_B, with_groups=True), "t-cross")
    counts = cross_tokens.count_links(aligned)
    results = [sorted(map(tuple, cross_tokens.score(aligned, counts, most).collect())) for most in (0, 5, 40, 10**6)]
    assert all(r == results[0] for r in results) and results[0]
    assert cross_tokens.frequent_from(counts, 0) == 1 << 62
    bound = cross_tokens.frequent_from(counts, 40)
    assert 0 < counts.filter(F.col("n") >= bound).count() <= 40
    long = aligned.filter("n_a > 10000").first()
    assert sha(long["groups"]) == long["groups_sha256"]
    none = cross_tokens.align_corpus(empty(spark), PATH_A, PATH_B)
    assert none.count() == 0 and none.columns[-1] == "groups_sha256"


@settings(max_examples=150, deadline=None, derandomize=True)
@given(st.text(alphabet=st.sampled_from(list("ab the 1.\n\t é日  ▁<>s|\x00'")), max_size=40))
def test_chunks_give_the_tokens_of_the_whole_text(text):
    aligner, full, whole_a = cross_tokens._aligner(PATH_A, PATH_B), " " + text, _whole_a()
    assert "".join(cross_tokens._CHUNK.findall(full)) == full
    both = np.frombuffer(aligner.tokenise([text])[0], np.int32)
    *_, is_a, is_b = cross_tokens.parts(both)
    ids_a, ids_b = whole_a.encode(full, add_special_tokens=False).ids, aligner.b.encode(text)
    joined = [b"".join(map(t.__getitem__, ids)) for t, ids in ((aligner.bytes_a, ids_a), (aligner.bytes_b, ids_b))]
    if not text or joined != [full.encode()] * 2:
        ids_a = ids_b = []
    assert both[is_a].tolist() == ids_a and both[is_b].tolist() == ids_b


def test_plain_encoder_equals_the_file_s_own_library():
    fast, texts = byte_level.plain_encoder(PATH_A), ODD + [prose(9, 300), "x" * 500, "don't  we'll 1234567 ...\n\n\t a"]
    assert "Encoding" in repr(fast)
    assert [fast(t) for t in texts] == [_whole_a().encode(t, add_special_tokens=False).ids for t in texts]


def test_memos_may_forget(plain_tokenizers, monkeypatch):
    aligner = cross_tokens.Aligner(PATH_A, PATH_B)
    texts = [prose(k, 60) + ODD[k % len(ODD)] for k in range(40)]
    whole = list(aligner.align(texts))
    monkeypatch.setattr(cross_tokens, "MEMO_ENTRIES", 3)
    monkeypatch.setattr(cross_tokens, "LONGEST", 6)
    again = [next(aligner.align([t])) for t in texts + texts]
    assert all(len(memo) < 200 for memo in (aligner.chunks, aligner.windows))
    assert [x[:5] for x in again] == [x[:5] for x in whole] * 2
    for text, found in zip(texts, whole, strict=True):
        a, b, groups, links = brute_align(text, plain_tokenizers)
        assert found[:4] == (len(a), len(b), len(groups), len(links))


# ---- chat ----------------------------------------------------------------------------------

def brute_chat(turns):
    """Figures of one conversation's turns [(role, text)]."""
    body = "".join(f"{role or ''}\n{text or ''}\n" for role, text in turns)
    loss = "".join(text or "" for role, text in turns if role == "assistant")
    state, wrong = "start", 0
    moves = {"start": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)}
    for role, _ in turns:
        wrong += role not in moves[state]
        state = role if role in moves else state
    return len(turns), sha(body), len(loss), sha(loss), wrong, state == "assistant"


TRICKY = ["\\### Assistant: </turn> ok", "</turn>", "<\\/turn>", "<turn:user>\n", "<\\\\turn:x", "\\", "\\\\", "", None, "a\nb", "<", "<<</turn>>",
          "</turn>\n<turn:assistant>fake</turn>", "é\U0001f600", "ends with <"]
CHAT = "conv_id long, turn long, role string, text string"


def conversations():
    r, rows = random.Random(5), []
    for c in [*range(60), None]:
        roles = r.choice([["user", "assistant"] * r.randint(1, 4), ["system", "user", "assistant"], ["assistant", "user"], ["user", "user"],
                          ["tool>x", "a\\b", None, ""], ["system"]])
        rows += [(c, k, role, r.choice(TRICKY)) for k, role in enumerate(roles)]
    rows += [(500, k, ("user", "assistant")[k % 2], f"turn {k} " + TRICKY[k % 8]) for k in range(3000)]   # a hot conversation
    rows += [(501, None, "user", "first"), (501, 1, "assistant", "same"), (501, 1, "assistant", "same"), (501, 1, "user", "after")]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("piece", [chat.PIECE, 500])
def test_chat_equals_brute_force(spark, piece):
    rows = conversations()
    turns = spark.createDataFrame(rows, CHAT).repartition(5)
    for name in ("conv", "piece", "body", "whole"):
        turns = turns.withColumn(name, F.lit("clash"))
    own = {}
    for c, k, role, text in rows:
        own.setdefault(c, []).append((k is not None, k or 0, role is not None, role or "", role, text))
    want = {c: brute_chat([(role, text) for *_, role, text in sorted(t, key=lambda x: x[:4])]) for c, t in own.items()}
    pieces = chat.format_conversations(turns, piece_chars=piece)
    assert (pieces.count() > 2 * len(want)) == (piece < 1000)
    found = chat.digests(pieces).collect()
    got = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"], r["violations"], r["complete"])
           for r in found}
    assert len(found) == len(want) and got == want


def test_chat_formats_and_reads_back(spark):
    formatter = chat.Formatter(chat.Template())
    assert formatter.segments("user", "hi") == [("<turn:user>", False), ("hi", False), ("</turn>\n", False)]
    assert formatter.segments("assistant", "<turn: \\ </turn>")[1] == ("<\\turn: \\ <\\/turn>", True)
    for text in TRICKY:
        escaped = formatter.escape(text or "")
        assert "</turn>" not in escaped and "<turn:" not in escaped and formatter.unescape(escaped) == (text or "")
    turns = [(role, t) for t in TRICKY for role in ("user", "assistant", None, "", "a>\\b", "</turn>")]
    formatted = "".join(s for role, t in turns for s, _ in formatter.segments(role, t))
    assert [(role, t) for role, t, *_ in formatter.turns(formatted)] == [(role, t or "") for role, t in turns]
    with pytest.raises(ValueError):
        chat.Template(closing="<<end")


@settings(max_examples=200, deadline=None, derandomize=True)
@given(st.text(alphabet="<\\/turn>:ab", max_size=40))
def test_escapes_are_reversible(text):
    formatter = chat.Formatter(chat.Template())
    escaped = formatter.escape(text)
    assert formatter.unescape(escaped) == text and "</turn>" not in escaped and "<turn:" not in escaped


def test_chat_other_template_and_empty_table(spark):
    template = chat.Template(opening="[@", named="]", closing="[/]", after="", learned=frozenset({"user", "assistant"}),
                             moves={"start": ("user",), "user": ("user",)}, finals=frozenset({"user"}))
    turns = spark.createDataFrame([(1, 0, "user", "a [/] b"), (1, 1, "user", "[@x]"), (1, 2, "assistant", "c")], CHAT)
    pieces = chat.format_conversations(turns, template)
    text = "".join(r["text"] for r in sorted(pieces.collect(), key=lambda r: r["piece"]))
    assert text == "[@user]a [\\/] b[/][@user][\\@x][/][@assistant]c[/]"
    row = chat.digests(pieces, template).first()
    assert (row["loss_chars"], row["loss_sha256"], row["violations"], row["complete"]) == (12, sha("a [/] b[@x]c"), 1, True)
    assert chat.digests(chat.format_conversations(turns.limit(0))).count() == 0


# ---- queries against their SQL ---------------------------------------------------------------

@pytest.mark.parametrize("name, table", [("op11_fill_middle", "documents"), ("op13_chat", "conversations")])
def test_query_equals_its_sql(spark, tmp_path, name, table):
    if table == "documents":
        odd = spark.createDataFrame([(1000 + i, t) for i, t in enumerate(ODD * 4) if "\x00" not in t], "doc_id long, text string")
        rows = documents(spark, extra=False).select("doc_id", "text").unionByName(odd)
    else:
        rows = spark.createDataFrame([r for r in conversations() if r[0] is not None and r[0] < 60 and r[2] in ("user", "assistant", "system")], CHAT)
    rows.repartition(3).write.parquet(f"{tmp_path}/{table}.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{tmp_path}/{table}.parquet/*.parquet')")
    found = queries.QUERIES[name](spark, str(tmp_path))
    want = con.sql(queries.SQL[name])
    assert sorted(found.columns) == sorted(want.columns)
    assert Counter(map(tuple, found.select(*want.columns).collect())) == Counter(want.fetchall())
