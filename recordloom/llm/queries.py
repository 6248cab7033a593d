"""The operators' queries over whole tables, with production parameters, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from recordloom.llm import decontaminate, length_histogram, line_dedup, mixing, near_dup, quality, secrets, sharding, token_orc, toxicity


def tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    rows = sharding.placed(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "hilbert")


def op2_token_orc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_orc.round_trip(table(spark, sf_dir, "documents"), tokenizer())


def op3_secret_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(table(spark, sf_dir, "documents"))


def op4_weighted_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.labelled(table(spark, sf_dir, "documents"))


def op5_subword_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.scored(docs, toxicity.trained(docs, table(spark, sf_dir, "labels")))


def op6_knapsack_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.digest(table(spark, sf_dir, "documents"))


def op7_seeded_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matched(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return length_histogram.histogram(table(spark, sf_dir, "documents"), tokenizer())


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digest(table(spark, sf_dir, "documents"))


def op10_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.digest(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_hilbert_shards, op2_token_orc, op3_secret_entropy, op4_weighted_minhash, op5_subword_toxicity, op6_knapsack_mix, op7_seeded_alignment, op8_length_histogram, op9_line_dedup, op10_rule_ledger)
}

OP9 = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key, min(doc_id) AS first_doc FROM k WHERE length(key) >= 10 GROUP BY key)
SELECT k.doc_id, count(*)::BIGINT AS n_lines,
       count(*) FILTER (WHERE f.first_doc < k.doc_id)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE f.first_doc IS NULL OR f.first_doc = k.doc_id), '')) AS kept_sha256
FROM k LEFT JOIN f ON k.key = f.key GROUP BY k.doc_id
"""

OP10 = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
u AS (SELECT doc_id, unnest(w) AS a, generate_subscripts(w, 1) AS i FROM d),
t AS (SELECT doc_id, i, a, lead(a, 1) OVER o AS b, lead(a, 2) OVER o AS c FROM u WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
g AS (SELECT doc_id, i, c IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, a, b, c) > 1 AS twice FROM t),
r AS (SELECT doc_id, i, twice OR coalesce(lag(twice, 1) OVER o, false) OR coalesce(lag(twice, 2) OVER o, false) AS rep
      FROM g WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
n AS (SELECT doc_id, count(*) FILTER (WHERE rep) AS n_repeat_words FROM r GROUP BY doc_id),
l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d),
m AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
      FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
x AS (SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda s: length(s))), 0)::BIGINT AS word_chars,
             (length(text) - length(translate(text, '#*$%&|<>', '')))::BIGINT AS n_symbols,
             coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
             coalesce(n_lines, 0) AS n_lines,
             len(list_filter(w, lambda s: s LIKE '%!' AND upper(s) = s AND lower(s) <> s)) AS n_shouts
      FROM d LEFT JOIN n USING (doc_id) LEFT JOIN m USING (doc_id)),
b AS (SELECT *, (CASE WHEN n_words < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
             + CASE WHEN 100 * n_symbols > 30 * n_words THEN 4 ELSE 0 END + CASE WHEN 100 * n_dup_lines > 50 * n_lines THEN 8 ELSE 0 END
             + CASE WHEN word_chars > 16 * n_words THEN 16 ELSE 0 END + CASE WHEN 10 * word_chars < 20 * n_words THEN 32 ELSE 0 END
             + CASE WHEN 100 * n_shouts > 50 * n_words THEN 64 ELSE 0 END)::BIGINT AS failed FROM x)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed & 3 <> 0 AS base_failed, failed = 0 AS kept, failed FROM b
"""

#: The others need an encoder, a curve, a model or hashes that SQL hasn't; tests/llm holds them against brute force.
ORACLE_SQL: dict[str, str] = {"op9_line_dedup": OP9, "op10_rule_ledger": OP10}
