"""The corpus pipeline: quality rules, near-duplicates, benchmark decontamination, mixing, token files.

Every stage works on what the one before kept, written as Parquet and read again. All but the last return the columns of
documents; the last returns a digest of the token files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from recordloom.llm import decontaminate, mixing, near_dup, quality, token_orc
from recordloom.llm._common import new_path
from recordloom.llm.queries import table, tokenizer


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.filtered(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dup.deduplicated(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.apply(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return token_orc.round_trip(docs, tokenizer())


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("source_mix", source_mix),
    ("token_files", token_files),
]

#: Sampling, alignment and encoding aren't SQL; tests/llm runs the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = new_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
