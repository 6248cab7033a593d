"""Token ids in ORC: run-length encoded integers, row indexes, and Bloom filters on document ids.

Files hold rows in ascending document id, file after file. Stripes are read in parallel; row indexes and Bloom filters let
a lookup by document id skip whole stripes and row groups.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recordloom.llm._common import new_path, partitions, saved, slices

SCHEMA = "doc_id long, pos long, n_tokens int, ids array<int>"
OPTIONS = {
    "compression": "zstd", "orc.create.index": "true", "orc.row.index.stride": "1000", "orc.stripe.size": str(16 << 20),
    "orc.bloom.filter.columns": "doc_id", "orc.bloom.filter.fpp": "0.01",
}


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1) -> None:
    """Writes a row for each row of docs: doc_id, pos (its place in the file), n_tokens and ids, which end_id ends.

    Null and empty texts have end_id alone. Null ids come first; rows of one id are ordered by text. An empty table writes
    files without rows. Texts are dealt by ranges of (doc_id, hash of text), so repeated ids are split as well.
    """

    def encoded(batches):
        from recordloom.llm._encoder import encoder

        own, pos = encoder(tokenizer), 0
        for b in slices(batches, 16_000_000):
            flat, n = own.encode(b.column("text"))
            n = n.astype(np.int64)
            ends = np.cumsum(n + 1)
            ids = np.full(int(ends[-1]), end_id, np.int32)
            inside = np.ones(len(ids), bool)
            inside[ends - 1] = False
            ids[inside] = flat
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(ids, pa.int32()))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(np.arange(pos, pos + len(n)), pa.int64()), pa.array(n + 1, pa.int32()), lists], names=["doc_id", "pos", "n_tokens", "ids"])
            pos += len(n)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("_h"))
    rows = rows.repartitionByRange(partitions(docs.sparkSession), "doc_id", "_h").sortWithinPartitions("doc_id", "_h", "text").drop("_h")
    rows.mapInArrow(encoded, SCHEMA).write.options(**OPTIONS).orc(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The rows, with the file of each (the numbers in the names ascend with the ids)."""
    return spark.read.schema(SCHEMA).orc(path).withColumn("file", F.col("_metadata.file_name"))


def lookup(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """The token rows of these documents: the filter reaches the row indexes and Bloom filters."""
    return read_tokens(spark, path).filter(F.col("doc_id").isin(doc_ids))


def digest(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of each row, all from the ids in the files."""

    def summed(batches):
        for b in batches:
            ids = b.column("ids")
            flat, offsets = ids.flatten().to_numpy(zero_copy_only=False).astype("<u4"), ids.offsets.to_numpy() - ids.offsets[0].as_py()
            crc = [zlib.crc32(flat[a:z]) for a, z in zip(offsets, offsets[1:])]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("file"), b.column("pos"), pa.array(np.diff(offsets), pa.int64()), pa.array(crc, pa.int64())], names=["doc_id", "file", "pos", "n_tokens", "ids_crc32"])

    rows = read_tokens(spark, path).select("doc_id", "file", "pos", "ids").mapInArrow(summed, "doc_id long, file string, pos long, n_tokens long, ids_crc32 long")
    rows = saved(rows, "token-digest")
    before, starts = 0, []
    number = lambda r: (int(r[0].split("-")[1]), r[0])  # noqa: E731  part-99999 comes before part-100000
    for file, n in sorted(rows.groupBy("file").agg(F.sum("n_tokens")).collect(), key=number):  # a row for each file
        starts.append((file, before))
        before += n
    offsets = spark.createDataFrame(starts, "file string, _start long")
    so_far = F.sum("n_tokens").over(Window.partitionBy("file").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.join(F.broadcast(offsets), "file").withColumn("start", F.col("_start") + F.coalesce(so_far, F.lit(0)))
    return rows.select("doc_id", "start", "n_tokens", "ids_crc32")


def round_trip(docs: DataFrame, tokenizer: str, end_id: int = 1) -> DataFrame:
    """Writes the token files of docs into the shared folder and returns digest() of what is read back."""
    path = new_path(docs.sparkSession, "tokens")
    write_tokens(docs, path, tokenizer, end_id)
    return digest(docs.sparkSession, path)
