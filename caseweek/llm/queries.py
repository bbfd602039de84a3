"""The registered queries of the numbered operators, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (byte_bpe, chat, cross_tokens, exact_dedup, fill_middle, language_id, line_dedup, packing,
               quality_classifier, quality_rules, simhash, toxicity, warc_fixity)
from .common import documents, in_fold, labels, on_workers, stored


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base figures of every document, and whether the rules' votes keep it."""
    return quality_rules.judge(documents(spark, sf_dir))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    found = simhash.near_duplicates(documents(spark, sf_dir), shingle_words=3, max_bits=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                        F.col("component").alias("component_id"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which document of each group of equal texts stays."""
    verdicts, _ = exact_dedup.deduplicate(documents(spark, sf_dir), carry=False)
    return verdicts.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


OP3_SQL = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learned from positive and unlabelled rows that are not held out."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    held_out = in_fold(F.col("doc_id"), 4, 2)
    model = quality_classifier.learn(docs.filter(~held_out), labels(spark, sf_dir).filter(~held_out))
    scored = docs.select("doc_id", held_out.alias("held_out"),
                         quality_classifier.quality_column(F.col("text"), model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


def _damaged_copy(replica: DataFrame) -> DataFrame:
    """Stand-in input: a second copy of a replica in which some records are lost, cut short or altered."""
    digest = F.sha2(F.concat(F.lit("damage"), F.sha2("payload", 256)).cast("binary"), 256)
    chance, n = F.conv(F.substring(digest, 1, 4), 16, 10).cast("int"), F.length("payload")
    altered = F.concat(F.expr("substring(payload, 1, length(payload) - 5)"), F.lit("~").cast("binary"),
                       F.expr("substring(payload, length(payload) - 3, 4)"))
    payload = (F.when(chance % 40 == 1, F.expr("substring(payload, 1, length(payload) div 2)"))
               .when((chance % 40 == 2) & (n > 5), altered).otherwise(F.col("payload")))
    return replica.filter(chance % 40 != 0).withColumn("payload", payload)


def op5_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of all pages whose second copy is damaged, found by comparing hash trees."""
    first = stored(warc_fixity.archive(spark.read.parquet(f"{sf_dir}/pages.parquet")), "warc-first")
    second = stored(_damaged_copy(first), "warc-second")
    tree = warc_fixity.FixityTree(first)
    found = warc_fixity.audit(tree, warc_fixity.FixityTree(second))
    owners = tree.records.select("file", "offset", F.col("record_id").alias("page_id"), "length")
    return found.join(owners, ["file", "offset"]).select(
        "page_id", "length", "status", F.col("digest_a").alias("sha256"), F.col("digest_b").alias("found_sha256"))


OP5_SQL = r"""
WITH parts AS (
  SELECT page_id, encode('WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10)
           || 'WARC-Record-ID: <urn:page:' || coalesce(page_id::VARCHAR, '') || '>' || chr(13) || chr(10)
           || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10)
           || 'Content-Type: text/html' || chr(13) || chr(10)
           || 'Content-Length: ' || octet_length(encode(coalesce(html, '')))::VARCHAR
           || chr(13) || chr(10) || chr(13) || chr(10)
           || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10)) AS payload
  FROM pages
), hashed AS (
  SELECT *, octet_length(payload) AS length, hex(payload) AS digits, sha256(payload) AS sha256 FROM parts
), chosen AS (
  SELECT *, ('0x' || substr(sha256('damage' || sha256), 1, 4))::INTEGER % 40 AS chance FROM hashed
), copied AS (
  SELECT *, CASE chance WHEN 0 THEN NULL WHEN 1 THEN sha256(unhex(substr(digits, 1, 2 * (length // 2))))
            WHEN 2 THEN sha256(unhex(substr(digits, 1, 2 * (length - 5)) || '7E' || right(digits, 8)))
            ELSE sha256 END AS found_sha256 FROM chosen
)
SELECT page_id, length, CASE WHEN found_sha256 IS NULL THEN 'missing' ELSE 'changed' END AS status, sha256,
       found_sha256
FROM copied WHERE found_sha256 IS DISTINCT FROM sha256
"""


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens packed into sequences of 1024."""
    import public_tokenizers

    packed = packing.pack_documents(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"),
                                    end_id=2, capacity=1024)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, from profiles learned on the rows that are not held out."""
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    held_out = in_fold(F.col("doc_id"), 4, 2)
    profiles = language_id.learn_profiles(docs.filter(~held_out))
    found = docs.select("doc_id", held_out.alias("held_out"),
                        language_id.language_column(F.col("text"), profiles).alias("found"))
    return found.select("doc_id", "held_out", "found.lang_pred", "found.score")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that many documents share, as digests."""
    kept = line_dedup.drop_common_lines(documents(spark, sf_dir), least_docs=3, least_chars=20)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


OP8_SQL = """
WITH texts AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS own FROM documents
), lines AS (
  SELECT doc_id, unnest(own) AS line, unnest(range(len(own))) AS pos FROM texts
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines
), common AS (
  SELECT key, max(doc_id) AS top FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), marked AS (
  SELECT k.*, c.key IS NOT NULL AND k.doc_id <> c.top AS gone FROM keyed k LEFT JOIN common c USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded, as digests."""
    import public_tokenizers

    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    both = byte_bpe.encode(documents(spark, sf_dir), path, pattern, with_decoded=True)
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, by a grammar whose insults are learned on the rows that are not held out."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    held_out = in_fold(F.col("doc_id"), 5, 0)
    weights, prior = toxicity.learn(docs, labels(spark, sf_dir).filter(~held_out))
    scored = docs.select("doc_id", held_out.alias("held_out"),
                         toxicity.toxicity_column(F.col("text"), weights, prior).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document rearranged for filling in the middle, and rebuilt, as digests."""
    recipe = fill_middle.Recipe(seed=42, rearranged=50, suffix_first=80, unit="word")
    made = fill_middle.transform(documents(spark, sf_dir), recipe)
    rebuilt = fill_middle.restored_column(F.col("output"), F.col("form"), recipe)
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                       F.sha2("output", 256).alias("output_sha256"), F.sha2(rebuilt, 256).alias("restored_sha256"))


OP11_SQL = r"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS digest,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units
  FROM documents
), drawn AS (
  SELECT *, len(units) AS n, ('0x' || substr(digest, 1, 8))::BIGINT AS h1, ('0x' || substr(digest, 9, 8))::BIGINT AS h2,
         ('0x' || substr(digest, 17, 8))::BIGINT AS h3, ('0x' || substr(digest, 25, 8))::BIGINT AS h4
  FROM texts
), cut AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
              OR h3 % 100 >= 50 THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn
), parts AS (
  SELECT *, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle,
         array_to_string(units[b + 1:], '') AS suffix
  FROM cut
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""


def op12_cross_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens by two tokenizers, aligned, with figures over the whole corpus."""
    import public_tokenizers

    return cross_tokens.align_corpus(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"),
                                     public_tokenizers.path("piece_bpe_32k.model"))


def op13_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation and a made-up one formatted, and read back from the output as digests."""
    template, says = chat.Template(), r"\### Assistant: </turn> ok"
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    own = spark.createDataFrame([(-7, 0, "user", says), (-7, 1, "assistant", says)], turns.schema)
    return chat.digests(chat.format_conversations(turns.unionByName(own), template), template)


OP13_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')
), written AS (
  SELECT *, '<turn:' || coalesce(replace(replace(role, '\', '\\'), '>', '\g'), '\0') || '>'
            || regexp_replace(text, '<(\\*)(turn:|/turn>)', '<\\\1\2', 'g') || '</turn>' || chr(10) AS formatted,
         lag(role, 1, 'start') OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST) AS before
  FROM turns
), joined AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(coalesce(role, '') || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role NULLS FIRST) AS body,
         coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST) FILTER (WHERE role = 'assistant'), '') AS loss,
         sum(length(formatted))::BIGINT AS formatted_chars,
         count(*) FILTER (WHERE (before, role) NOT IN (('start', 'system'), ('start', 'user'), ('system', 'user'),
                                                       ('user', 'assistant'), ('assistant', 'user'))) AS violations,
         arg_max(role, turn) = 'assistant' AS complete
  FROM written GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(body) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
       formatted_chars, violations, complete
FROM joined
"""


QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_simhash": op2_simhash,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_warc_fixity": op5_warc_fixity,
    "op6_packing": op6_packing,
    "op7_language_id": op7_language_id,
    "op8_line_dedup": op8_line_dedup,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_toxicity": op10_toxicity,
    "op11_fill_middle": op11_fill_middle,
    "op12_cross_tokens": op12_cross_tokens,
    "op13_chat": op13_chat,
}
QUERIES = {name: on_workers(query) for name, query in QUERIES.items()}

SQL: dict[str, str] = {
    "op3_exact_dedup": OP3_SQL,
    "op5_warc_fixity": OP5_SQL,
    "op8_line_dedup": OP8_SQL,
    "op11_fill_middle": OP11_SQL,
    "op13_chat": OP13_SQL,
}
