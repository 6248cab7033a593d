"""Stage results as Parquet, and the folder that driver and executors share."""

from __future__ import annotations

import atexit
import functools
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir, or a folder of our own where it is unset and all runs on one machine (tests)."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        at = _own_dir()
    return at.rstrip("/")


@functools.cache
def _own_dir() -> str:
    at = tempfile.mkdtemp(prefix="recordloom-")
    atexit.register(shutil.rmtree, at, ignore_errors=True)
    return f"file://{at}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """Writes df into the shared folder and reads it again; later stages don't compute it anew, and lost executors lose nothing."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "snappy").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Artifacts:
    """Named results of a run, one Parquet folder for each (name, split), with _sw for a sub-world."""

    def __init__(self, spark: SparkSession, root: str, subworld: bool = False):
        self.spark, self.root, self.subworld = spark, root.rstrip("/"), subworld

    def path(self, name: str, split: str) -> str:
        return f"{self.root}/{name}_{split}{'_sw' if self.subworld else ''}"

    def read(self, name: str, split: str) -> DataFrame:
        from pyspark.errors import AnalysisException

        try:
            return self.spark.read.parquet(self.path(name, split))
        except AnalysisException as e:
            raise FileNotFoundError(f"{self.path(name, split)} is missing: run the stage that writes {name!r} first") from e

    def write(self, df: DataFrame, name: str, split: str, by: str | None = None) -> DataFrame:
        writer = df.write.mode("overwrite").option("compression", "zstd")
        (writer.partitionBy(by) if by else writer).parquet(self.path(name, split))
        return self.read(name, split)
