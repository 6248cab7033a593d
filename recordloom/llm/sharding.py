"""Shards cut from a Hilbert curve over quantised metadata.

Every dimension is quantised to 2**bits cells of about equal row counts. The cells of a row give its index on a Hilbert
curve; rows are ranked by (index, doc_id, text_crc32) and cut into runs whose row counts differ by one at most, so each run
covers a compact box of the dimensions and its min/max statistics prune well on each of them.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordloom.llm._common import ranked, text_bytes

#: Steps of an octave for numbers; the most different strings that the driver counts one by one.
OCTAVE, MAX_VALUES = 64, 4096


def curve_index(cells: Sequence[np.ndarray], bits: int) -> np.ndarray:
    """Skilling's transform (AIP 2004) from cell coordinates to the Hilbert index, on whole arrays."""
    x = [np.array(c, dtype=np.int64) for c in cells]
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(len(x)):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] ^= np.where(high, p, swap)
            if i:
                x[i] ^= swap
        q >>= 1
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    fix, q = np.zeros_like(x[0]), 1 << (bits - 1)
    while q > 1:
        fix ^= np.where((x[-1] & q) != 0, q - 1, 0)
        q >>= 1
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for c in x:
            out = (out << 1) | (((c ^ fix) >> b) & 1)
    return out


def _cuts(docs: DataFrame, d: str, n: int) -> list[str]:
    """At most n - 1 strings that cut the whole values of d into parts of about equal row counts, in byte order: exact where
    there are few different ones, else where a range partitioning cuts them. The driver gets MAX_VALUES + 1 rows at most."""
    values = docs.select(F.col(d).alias("v")).filter("v IS NOT NULL").groupBy("v").count()
    own = values.limit(MAX_VALUES + 1).collect()
    if len(own) > MAX_VALUES:
        parts = values.select("v").repartitionByRange(n, "v").groupBy(F.spark_partition_id()).agg(F.min("v").alias("v"))
        return sorted((r["v"] for r in parts.collect()), key=str.encode)[1:]
    own = sorted(((r["v"], r["count"]) for r in own), key=lambda x: x[0].encode())
    at = np.cumsum([c for _, c in own])
    return sorted({own[int(np.searchsorted(at, at[-1] * k / n, "right"))][0] for k in range(1, n)} if own else (), key=str.encode)


def _slots(docs: DataFrame, dims: Sequence[str], bits: int) -> list[Column]:
    """For each dimension a column of few distinct whole numbers, in the order of the values; null: -1."""
    kinds, out = dict(docs.dtypes), []
    for d in dims:
        if kinds[d] == "string":
            slot = F.when(F.col(d).isNotNull(), sum(((F.col(d) >= c).cast("long") for c in _cuts(docs, d, 1 << bits)), F.lit(0).cast("long")))
        else:
            v = F.col(d).cast("double")
            slot = (F.signum(v) * F.floor(F.log2(1 + F.abs(v)) * OCTAVE)).cast("long")
        out.append(F.coalesce(slot, F.lit(-1).cast("long")))
    return out


def _bounds(slots: DataFrame, n_dims: int, bits: int) -> list[list[int]]:
    """The slots at which cells 1, 2, ... begin. A string has 2**bits slots at most, a number OCTAVE for each power of two."""
    each = F.explode(F.array(*(F.struct(F.lit(i).alias("dim"), F.col(f"_s{i}").alias("slot")) for i in range(n_dims))))
    counts = slots.select(each.alias("e")).groupBy("e.dim", "e.slot").count().collect()
    out = []
    for i in range(n_dims):
        own = sorted((r["slot"], r["count"]) for r in counts if r["dim"] == i)
        at = np.cumsum([n for _, n in own])
        cuts = {own[int(np.searchsorted(at, at[-1] * k / (1 << bits), "right"))][0] for k in range(1, 1 << bits)} if own else set()
        out.append(sorted(cuts))
    return out


def placed(docs: DataFrame, dims: Sequence[str] = ("lang", "source", "n_chars"), bits: int = 5, n_shards: int = 16, payload: Sequence[str] = ()) -> DataFrame:
    """A row of docs: doc_id, size, text_crc32, hilbert, shard, slot, and the columns in payload.

    Null texts have size 1 and the crc of an empty text, null metadata the first cell, null ids come first in their cell.
    Repeated rows get a slot each, long texts one like all others. An empty table gives no rows. Only the named columns are
    read.
    """
    cells_of = [c.alias(f"_s{i}") for i, c in enumerate(_slots(docs, dims, bits))]
    base = docs.select("doc_id", *(c for c in payload if c != "doc_id"), (text_bytes() + 1).alias("size"), F.crc32(F.encode(F.coalesce(F.col("text"), F.lit("")), "UTF-8")).alias("text_crc32"), *cells_of)
    bounds = _bounds(docs.select(*cells_of), len(dims), bits)

    def index(cells: pd.DataFrame) -> pd.Series:
        return pd.Series(curve_index([np.searchsorted(b, cells[c].to_numpy(), "right") for b, c in zip(bounds, cells)], bits))

    curve = F.pandas_udf(index, "long")
    cells = F.struct(*(F.col(f"_s{i}") for i in range(len(dims))))
    rows = base.withColumn("hilbert", curve(cells)).drop(*(f"_s{i}" for i in range(len(dims))))
    rows, n = ranked(rows, ["hilbert", "doc_id", "text_crc32"], "hilbert")
    shard = F.expr(f"rank * {n_shards}L div {max(n, 1)}L")
    rows = rows.withColumn("shard", shard.cast("int"))
    return rows.withColumn("slot", F.expr(f"rank - (shard * {max(n, 1)}L + {n_shards - 1}L) div {n_shards}L")).drop("rank")


def write_shards(docs: DataFrame, path: str, dims: Sequence[str] = ("lang", "source", "n_chars"), **options) -> DataFrame:
    """Writes all columns of docs, a folder for each shard in curve order, and returns the manifest: min and max of each dimension."""
    taken = {"size", "text_crc32", "hilbert", "shard", "slot", "rank"}
    kept = [c for c in docs.columns if c not in taken]
    out = placed(docs, dims, payload=kept, **options)
    out.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
    back = docs.sparkSession.read.parquet(path)
    return back.groupBy("shard").agg(F.count("*").alias("rows"), *(f(d).alias(f"{n}_{d}") for d in dims for n, f in (("min", F.min), ("max", F.max))))


def shards_for(manifest: DataFrame, **equal) -> list[int]:
    """The shards that may hold rows with these values (manifest has a row for each shard)."""
    for d, v in equal.items():
        manifest = manifest.filter(F.lit(v).between(F.col(f"min_{d}"), F.col(f"max_{d}")))
    return sorted(r["shard"] for r in manifest.select("shard").collect())
