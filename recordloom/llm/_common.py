"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space of every word rule here: \x20 and \x09-\x0D.
SPACES = "\t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or one of our own where it is unset and all runs on one
    machine (tests)."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        at = "file://" + tempfile.mkdtemp(prefix="recordloom-")
        spark.conf.set("spark.checkpoint.dir", at) if spark.conf.isModifiable("spark.checkpoint.dir") else None
    return at.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """Writes df as Parquet into the shared folder and reads it again: lineage ends there, and lost executors lose nothing."""
    spark, path = df.sparkSession, new_path(df.sparkSession, name)
    df.write.option("compression", "snappy").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ranked(df: DataFrame, keys: list[str], name: str = "ranked") -> tuple[DataFrame, int]:
    """df with rank (0 and up, gapless, by keys) and the number of rows.

    Rows are dealt by ranges of all keys, so no key lands in one task; only one count a partition reaches the driver.
    """
    spark = df.sparkSession
    at = F.monotonically_increasing_id()
    rows = df.repartitionByRange(partitions(spark), *keys).sortWithinPartitions(*keys).withColumn("_at", at)
    rows = saved(rows.withColumn("_part", F.shiftright("_at", 33).cast("int")), name)
    start, starts = 0, []
    for part, n in sorted(rows.groupBy("_part").agg(F.count("*")).collect()):
        starts.append((part, start))
        start += n
    offsets = spark.createDataFrame(starts, "_part int, _start long")  # a row for each partition
    out = rows.join(F.broadcast(offsets), "_part").withColumn("rank", F.col("_start") + F.col("_at").bitwiseAND((1 << 33) - 1))
    return out.drop("_part", "_at", "_start"), start


def text_bytes(text: str = "text") -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def words_of(text: str | None) -> list[str]:
    """The runs of characters other than SPACES and \\x20."""
    if not text:
        return []
    for c in SPACES:
        if c in text:
            text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def slices(batches: Iterator, most: int = 2_000_000) -> Iterator[tuple]:
    """The Arrow batches in slices of about so many bytes of their "text" column: lists of Python words stay small."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    for b in batches:
        if not b.num_rows:
            continue
        size = np.cumsum(pc.fill_null(pc.binary_length(b.column("text")), 0).to_numpy(zero_copy_only=False) + 8) // most
        cuts = [0, *(np.flatnonzero(np.diff(size)) + 1).tolist(), b.num_rows]
        for a, z in zip(cuts, cuts[1:]):
            yield b.slice(a, z - a)
    pa.default_memory_pool().release_unused()  # a worker lives on after its task
