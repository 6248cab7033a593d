"""Exact token-length histogram: documents by encoded length, and suffix sums that answer every context limit.

The histogram has a row for each length that occurs. From it and its suffix sums come, without reading a document again,
totals, quantiles, and for any limit the tokens kept and cut, the documents that fit, and the tokens of those.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recordloom.llm._common import saved, slices

#: Lengths of one block of the suffix sums.
BLOCK = 1024


def encoded_lengths(docs: DataFrame, tokenizer: str) -> DataFrame:
    """n_tokens of each row (null and empty texts: 0), and nothing else."""

    def counted(batches):
        from recordloom.llm._encoder import encoder

        for b in slices(batches, 16_000_000):
            yield pa.RecordBatch.from_arrays([pa.array(encoder(tokenizer).count(b.column("text")), pa.int64())], names=["n_tokens"])

    return docs.select("text").mapInArrow(counted, "n_tokens long")


def histogram(docs: DataFrame, tokenizer: str) -> DataFrame:
    """A row for each length: n_tokens, n_docs; docs_longer and tokens_longer (suffix sums: documents above that length, and
    their tokens); tokens_at_limit (what is left if texts are cut at n_tokens) and tokens_cut; docs_within and
    tokens_within (documents of that length at most); total_docs, total_tokens. An empty table gives no rows.

    Repeated rows count as rows of their own, long texts are encoded whole, and only text is read, so other columns may have
    any name. Suffix sums run in blocks of lengths, so no task holds more than BLOCK lengths of them or one row a block.
    """
    counts = saved(encoded_lengths(docs, tokenizer).groupBy("n_tokens").agg(F.count("*").alias("n_docs")), "lengths")
    counts = counts.withColumn("_block", F.expr(f"n_tokens div {BLOCK}"))
    blocks = counts.groupBy("_block").agg(F.sum("n_docs").alias("_d"), F.sum(F.col("n_docs") * F.col("n_tokens")).alias("_t"))
    above = Window.orderBy(F.col("_block").desc())
    blocks = blocks.select("_block", *(F.sum(c).over(above.rowsBetween(Window.unboundedPreceding, 0)).alias(f"_to{c}") for c in ("_d", "_t")), *(F.sum(c).over(Window.partitionBy()).alias(f"_all{c}") for c in ("_d", "_t")), "_d", "_t")
    inside = Window.partitionBy("_block").orderBy(F.col("n_tokens").desc()).rowsBetween(Window.unboundedPreceding, -1)
    longer = [F.coalesce(F.sum(v).over(inside), F.lit(0)) + F.col(f"_to{c}") - F.col(c) for c, v in (("_d", F.col("n_docs")), ("_t", F.col("n_docs") * F.col("n_tokens")))]
    rows = counts.join(blocks, "_block").withColumns({"docs_longer": longer[0], "tokens_longer": longer[1], "total_docs": F.col("_all_d"), "total_tokens": F.col("_all_t")})
    cut = F.col("tokens_longer") - F.col("docs_longer") * F.col("n_tokens")
    return rows.select("n_tokens", "n_docs", "docs_longer", "tokens_longer", cut.alias("tokens_cut"), (F.col("total_tokens") - cut).alias("tokens_at_limit"), (F.col("total_docs") - F.col("docs_longer")).alias("docs_within"), (F.col("total_tokens") - F.col("tokens_longer")).alias("tokens_within"), "total_docs", "total_tokens")


def at_limit(table: DataFrame, limit: int) -> dict:
    """For a histogram(): the tokens left and cut, and the documents cut, at any context limit (between lengths too)."""
    r = table.filter(F.col("n_tokens") > limit).agg(F.sum("n_docs").alias("docs_cut"), F.sum(F.col("n_docs") * (F.col("n_tokens") - limit)).alias("tokens_cut")).first()
    total = table.agg(F.max("total_tokens")).first()[0] or 0
    return {"docs_cut": r["docs_cut"] or 0, "tokens_cut": r["tokens_cut"] or 0, "tokens_at_limit": total - (r["tokens_cut"] or 0)}


def quantile(table: DataFrame, q: float) -> int | None:
    """The smallest length that at least the share q of documents doesn't exceed."""
    return table.filter(F.col("docs_within") >= F.ceil(q * F.col("total_docs"))).agg(F.min("n_tokens")).first()[0]
