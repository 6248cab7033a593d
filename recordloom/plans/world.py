"""The records world over the driver's tables: documents as noisy records, equal texts as the truth."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.operators import blocking, learn, normalize
from recordloom.sources.artifacts import saved

_KEPT: dict[tuple[str, str, str], DataFrame] = {}


def once(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """A stage's result, written as Parquet by the first query of an application that needs it: later stages start from a scan."""
    key = spark.sparkContext.applicationId, sf_dir, name
    if key not in _KEPT:
        _KEPT[key] = saved(build(), name)
    return _KEPT[key]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as records: a name is the whole first line."""
    d = table(spark, sf_dir, "documents")
    source = (F.col("doc_id") % 3 + 1).cast("int")
    first = F.btrim(F.split_part("text", F.lit("\n"), F.lit(1)))
    return d.select(F.concat(F.lit("S"), source, F.lit("-"), "doc_id").alias("entity_id"), source.alias("source"), F.col("lang").alias("country"), first.alias("name_raw"), F.concat_ws(" ", "n_chars", "source").alias("addr_raw"))


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return once(spark, sf_dir, "records", lambda: normalize.build_records(raw_records(spark, sf_dir)))


def truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """s1_id, match_id: records of equal text and country; of several S1 records the least id. Hashes are joined, not texts."""
    return once(spark, sf_dir, "truth", lambda: _truth(table(spark, sf_dir, "documents")))


def _truth(documents: DataFrame) -> DataFrame:
    d = documents.select((F.col("doc_id") % 3 + 1).alias("s"), F.concat(F.lit("S"), F.col("doc_id") % 3 + 1, F.lit("-"), "doc_id").alias("id"), "lang", F.sha2(F.encode("text", "UTF-8"), 256).alias("h"))
    first = d.filter("s = 1").groupBy("lang", "h").agg(F.min("id").alias("s1_id"))
    return d.filter("s <> 1").join(first, ["lang", "h"]).select("s1_id", F.col("id").alias("match_id"))


def merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return once(spark, sf_dir, "merged", lambda: blocking.merge_passes(saved(blocking.Index(records(spark, sf_dir)).passes(), "hits")))


def ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merged pairs in the order of their block scores alone."""
    return blocking.rank_per_cand(merged(spark, sf_dir).withColumn("rank_score", F.col("block_score")), 5)


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lambda: blocking.cap_per_s1(ranked(spark, sf_dir).filter("rank_in_cand <= 2"), 50)
    return once(spark, sf_dir, "pairs", kept).select("s1_id", "cand_id", "country", "block_mask", "rank_in_cand", "block_score", "rank_score")


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs with a stand-in for a probability: the share of passes' greatest scores."""
    return pairs(spark, sf_dir).select("s1_id", "cand_id", "block_score", F.round(F.col("block_score") / 4, 9).alias("p"))


def s1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_records(spark, sf_dir).filter("source = 1").select(F.col("entity_id").alias("s1_id"), "country")


def folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return learn.make_folds(s1(spark, sf_dir), truth(spark, sf_dir))
