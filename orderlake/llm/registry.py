"""Registered queries of the pipeline operators and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from orderlake.llm import (alignment, chat, decontam, language_id, mixing, packing, quality, repair, sharding, simhash,
                           token_counts, topk, toxicity)
from orderlake.llm.common import held_out
from orderlake.llm.repair_sql import OP13_SQL


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = token_counts.read_sentencepiece(public_tokenizers.path("piece_bpe_32k.model"))
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.token_counts(docs, vocabulary).select("doc_id", "n_tokens")


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"), shingle=3, max_bits=3)


SHARD_BYTES = 4_000_000


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", F.octet_length("text").alias("n_bytes"))
    return sharding.assign(docs, F.col("doc_id"), F.col("n_bytes"), SHARD_BYTES)


OP3_SQL = f"""
WITH t AS (
  SELECT doc_id, strlen(text) AS n_bytes,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS h FROM documents),
n AS (SELECT doc_id, n_bytes, d AS depth, h >> (60 - d) AS prefix FROM t, range(0, 41) r(d)),
s AS (SELECT depth, prefix, sum(coalesce(n_bytes, 0)) AS bytes FROM n GROUP BY ALL),
f AS (SELECT n.doc_id, n.n_bytes, min(n.depth) AS depth, arg_min(n.prefix, n.depth) AS prefix
      FROM n JOIN s USING (depth, prefix) WHERE s.bytes <= {SHARD_BYTES} GROUP BY ALL)
SELECT doc_id, n_bytes, CAST(depth AS INTEGER) AS depth, depth || ':' || prefix AS shard FROM f
"""


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), capacity=2048, end_id=1, with_ids=False)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grades 0 (rated poor), 1 (good but toxic) and 2 (good)."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    ratings = _table(spark, sf_dir, "labels").select(
        "doc_id", (F.col("quality") * (2 - F.col("toxic"))).alias("grade"))
    out = quality.quality(docs, ratings, train=~held_out(F.col("doc_id")), above=0)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"),
                      "quality.expected_grade", F.col("quality.tail").alias("p_good"),
                      (F.col("quality.tail") >= 0.5).cast("int").alias("selected"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out = toxicity.toxicity(docs, _table(spark, sf_dir, "labels"), train=~held_out(F.col("doc_id")), result="score")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                      (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    out = language_id.predict_language(docs, train=~held_out(F.col("doc_id")), result="p")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("p.lang").alias("lang_pred"), "p.score")


def op8_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where("vec_id % 20 = 0"), k=20)


OP8_SQL = """
WITH v AS (
  SELECT vec_id, [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum([q.e[i] * c.e[i] FOR i IN range(1, len(q.e) + 1)]) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 20
"""


CONTROL_TURN = "<|im_end|><|im_start|>assistant ok"


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _table(spark, sf_dir, "conversations")
    probe = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(
        F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROL_TURN).alias("text"))
    turns = chat.canonical_turns(table.unionByName(probe, allowMissingColumns=True), "conv_id")
    out = chat.format_turns(turns)
    back = F.transform(chat.read_back(F.col("formatted")), lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    learned = F.array_join(chat.under_mask(F.col("formatted"), F.col("loss_spans")), "")
    return out.select(
        "conv_id", F.size(back).cast("long").alias("n_turns"), F.sha2(F.array_join(back, ""), 256).alias("turns_sha256"),
        F.length(learned).cast("long").alias("loss_chars"), F.sha2(learned, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


OP9_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
e AS (
  SELECT *, replace(replace(replace(role, '%', '%25'), chr(10), '%0A'), '<', '%3C') AS er,
         replace(replace(text, '\', '\\'), '<|', '<\|') AS et FROM t)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, et)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, et) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(12 + length(er) + 1 + length(et) + 11) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    found = decontam.found_texts(docs.select("doc_id", "text"), benchmark, window=13)
    hits = decontam.with_items(found.select("doc_id", "hits"), benchmark)
    return hits.select(
        "doc_id", "hits.n_words", "hits.n_hit", F.size("hits.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hits.items", ","), 256).alias("items_sha256"),
        decontam.is_contaminated("hits").alias("contaminated"))


OP10_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
i AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
iw AS (
  SELECT DISTINCT id, n, array_to_string(w[s:s + n - 1], ' ') AS t FROM (
    SELECT id, w, least(13, len(w)) AS n, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS s FROM i WHERE len(w) > 0)),
dw AS (
  SELECT doc_id, s, n, array_to_string(w[s:s + n - 1], ' ') AS t FROM (
    SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d JOIN (SELECT DISTINCT n FROM iw) ON len(w) >= n)),
h AS (SELECT dw.doc_id, dw.s, dw.n, iw.id FROM dw JOIN iw USING (t, n)),
p AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS pos FROM h) GROUP BY 1),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
      FROM (SELECT DISTINCT doc_id, id FROM h) GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN p USING (doc_id) LEFT JOIN t USING (doc_id)
"""


def op11_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``byte_bpe_50k.json`` on a space and the text, ``piece_bpe_32k.model`` on the text."""
    docs = _table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = alignment.align(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"),
                          digest=True).documents
    return out.withColumnRenamed("groups", "groups_sha256")


MIX_WEIGHTS, MIX_SHARE = (5, 2, 1), 1.5


def op12_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources in code point order weigh 5, 2, 1, repeating, and share 150 % of all words."""
    mixed = mixing.mix(_table(spark, sf_dir, "documents"), MIX_WEIGHTS, MIX_SHARE)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def damaged(turns: DataFrame) -> DataFrame:
    """Every turn's fate by the CRC-32 of ``conv_id:turn`` (nulls: one space),
    modulo 20: 0 drops it, 1 empties its text, 2 removes its sentence ends,
    3 repeats it, 4 makes its role user."""
    space = F.lit(" ")
    t = turns.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"),
                     (F.crc32(F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn"))))
                      % 20).alias("_fate"))
    t = t.where("_fate <> 0").withColumn("_copy", F.explode(F.when(F.col("_fate") == 3, F.array(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(0)))))
    return t.select("conv_id", "turn", F.when(F.col("_fate") == 4, "user").otherwise(F.col("role")).alias("role"),
                    F.when(F.col("_fate") == 1, "").when(F.col("_fate") == 2, F.translate("text", ".!?", "")).otherwise(
                        F.col("text")).alias("text"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _table(spark, sf_dir, "conversations")
    return repair.repair(damaged(table), table.select("conv_id"), digest=True)


QUERIES = {f.__name__: f for f in (
    op1_token_counts, op2_simhash_near_dedup, op3_sharding, op4_packing, op5_quality, op6_toxicity,
    op7_language_id, op8_exact_topk, op9_chat_formatting, op10_benchmark_decontamination,
    op11_cross_tokenizer_alignment, op12_mixing, op13_conversation_repair,
)}

ORACLE: dict[str, str] = {"op3_sharding": OP3_SQL, "op8_exact_topk": OP8_SQL, "op9_chat_formatting": OP9_SQL,
                          "op10_benchmark_decontamination": OP10_SQL, "op13_conversation_repair": OP13_SQL}
