"""Tab-separated input and output with every rule checked before a file counts as read or is written."""

from __future__ import annotations

import csv
import hashlib
import os
import subprocess
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.operators.evaluate import gt_long

RECORD_COLUMNS = ("entity_id", "business_name", "business_address", "country")
TRUTH_COLUMNS = ("source1_entity_id", "matched_entity_ids")


def read_tsv(spark: SparkSession, path: str, columns: tuple[str, ...] = RECORD_COLUMNS) -> DataFrame:
    """All strings; doubled quotes inside quotes; empty cells are empty strings, and NA or null are words like others."""
    schema = ", ".join(f"`{c}` string" for c in columns)
    df = spark.read.schema(schema).options(sep="\t", header=True, quote='"', escape='"', emptyValue="", nullValue="\x00", enforceSchema=False, multiLine=False, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    return df.select(*(F.coalesce(c, F.lit("")).alias(c) for c in columns))


def with_position(df: DataFrame) -> DataFrame:
    """A frame read straight from files, with position: a string that sorts rows as they stand there, file after file by name.

    A task may read its parts of files in any order, so a row's place is its file, its part's offset, and its place in the task.
    """
    places = ("_metadata.file_name", F.lpad(F.col("_metadata.file_block_start").cast("string"), 20, "0"), F.lpad(F.monotonically_increasing_id().cast("string"), 20, "0"))
    return df.withColumn("position", F.concat_ws("|", *places))


class InputError(ValueError):
    pass


def second_reading(spark: SparkSession, path: str, columns: tuple[str, ...], every: int = 1000) -> tuple[int, DataFrame]:
    """The rows of a file by another parser (Python's csv, line by line): their number, and a sample of about one in every rows,
    by the hash of a line."""

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [next(csv.reader([line.rstrip("\r")], delimiter="\t"), [""]) for line in b.column(0).to_pylist()]
            rows = [[*r, *[""] * len(columns)][: len(columns)] if len(r) <= len(columns) else [None] * len(columns) for r in rows]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows)], names=list(columns)) if rows else pa.RecordBatch.from_pylist([], pa.schema([(c, pa.string()) for c in columns]))

    header = "\t".join(columns)
    lines = spark.read.text(path).filter(F.rtrim("value", F.lit("\r")) != header).filter("value <> ''")
    sample = lines.filter(F.pmod(F.xxhash64("value"), F.lit(every)) == 0)
    return lines.count(), sample.mapInArrow(parsed, ", ".join(f"`{c}` string" for c in columns))


def check_readings(spark: SparkSession, path: str, df: DataFrame, every: int = 1000) -> None:
    """Raises unless both parsers agree on the number of rows and on the sampled rows."""
    columns = tuple(df.columns)
    n, sample = second_reading(spark, path, columns, every)
    if n != (own := df.count()):
        raise InputError(f"{path}: {own} rows, {n} by the second reading")
    if not (other := sample.join(df, list(columns), "left_anti")).isEmpty():
        raise InputError(f"{path}: read in two ways: {other.first()}")


def checks(df: DataFrame) -> DataFrame:
    """rows, nulls, and rows with a carriage return in the last column."""
    return df.agg(F.count("*").alias("rows"), F.coalesce(F.sum(sum((F.col(c).isNull().cast("int") for c in df.columns), F.lit(0))), F.lit(0)).alias("nulls"), F.count_if(F.contains(F.col(df.columns[-1]), F.lit("\r"))).alias("carriage_returns"))


def check_table(df: DataFrame, expected: int | None = None) -> int:
    r = checks(df).first()
    if expected is not None and r["rows"] != expected:
        raise InputError(f"{r['rows']} rows, expected {expected}")
    if r["nulls"] or r["carriage_returns"]:
        raise InputError(f"{r['nulls']} nulls, {r['carriage_returns']} carriage returns")
    return r["rows"]


def to_records(df: DataFrame, source: int) -> DataFrame:
    return with_position(df).select("entity_id", F.lit(source).alias("source"), "country", F.col("business_name").alias("name_raw"), F.col("business_address").alias("addr_raw"), "position")


def ingest(spark: SparkSession, folder: str, split: str, expected: dict[str, int] | None = None) -> tuple[DataFrame, DataFrame | None]:
    """Raw records of the three sources with their position in the file, and for "train" the true pairs, whose S1 ids must be
    source 1's."""
    records = None
    for s in (1, 2, 3):
        path = f"{folder}/{split}_source{s}.tsv"
        df = read_tsv(spark, path)
        check_table(df, (expected or {}).get(f"source{s}"))
        check_readings(spark, path, df)
        part = to_records(df, s)
        records = part if records is None else records.unionByName(part)
    if split != "train":
        return records, None
    wide = read_tsv(spark, f"{folder}/{split}_ground_truth.tsv", TRUTH_COLUMNS)
    a, b = wide.select(F.col("source1_entity_id").alias("entity_id")), records.filter("source = 1").select("entity_id")
    if not a.join(b, "entity_id", "left_anti").isEmpty() or not b.join(a, "entity_id", "left_anti").isEmpty():
        raise InputError("the S1 ids of the ground truth are not those of source 1")
    return records, gt_long(wide)


class SubmissionError(AssertionError):
    pass


def submission_faults(matches: DataFrame, candidates: DataFrame, s1_ids: DataFrame, valid_ids: DataFrame) -> DataFrame:
    """rule, rows: for each rule the pairs that break it. s1_ids: s1_id; valid_ids: cand_id."""
    out = None
    for name, df in (("matches", matches), ("candidates", candidates)):
        pairs = df.select("s1_id", "cand_id")
        bad = {
            "repeated pairs": pairs.groupBy("s1_id", "cand_id").count().filter("count > 1"),
            "ids of another form": pairs.filter(~F.col("cand_id").rlike(r"^S[23]-[^\s,]+$")),
            "unknown S1 ids": pairs.join(s1_ids.select("s1_id"), "s1_id", "left_anti"),
            "unknown candidate ids": pairs.join(valid_ids.select("cand_id"), "cand_id", "left_anti"),
        }
        if name == "matches":
            bad["not among candidates"] = pairs.join(candidates.select("s1_id", "cand_id"), ["s1_id", "cand_id"], "left_anti")
        for rule, rows in bad.items():
            part = rows.agg(F.lit(f"{name}: {rule}").alias("rule"), F.count("*").alias("rows"))
            out = part if out is None else out.unionByName(part)
    return out


def check_submission(matches: DataFrame, candidates: DataFrame, s1_ids: DataFrame, valid_ids: DataFrame) -> None:
    faults = submission_faults(matches, candidates, s1_ids, valid_ids).filter("rows > 0").collect()  # ten rows at most
    if faults:
        raise SubmissionError("; ".join(f"{r['rule']} ({r['rows']})" for r in faults))


def id_lists(pairs: DataFrame, s1_ids: DataFrame) -> DataFrame:
    """s1_ids' rows with ids: the sorted candidates joined by commas, "" without any."""
    lists = pairs.groupBy("s1_id").agg(F.array_join(F.array_sort(F.collect_list("cand_id")), ",").alias("ids"))
    return s1_ids.join(lists, "s1_id", "left").withColumn("ids", F.coalesce("ids", F.lit("")))


def write_tsv(rows: DataFrame, path: str, header: tuple[str, str], order: str) -> str:
    """Two columns without quotes, LF, in the given order, streamed through the driver as the file's order is a contract; returns its SHA-256."""
    digest = hashlib.sha256()
    with open(path, "wb") as f:
        for line in [header, *()]:
            data = ("\t".join(line) + "\n").encode()
            f.write(data)
            digest.update(data)
        for r in rows.orderBy(order).select("s1_id", "ids").toLocalIterator():
            data = f"{r['s1_id']}\t{r['ids']}\n".encode()
            f.write(data)
            digest.update(data)
    return digest.hexdigest()


def write_submission(matches: DataFrame, candidates: DataFrame, s1_ids: DataFrame, valid_ids: DataFrame, folder: str) -> dict[str, str]:
    """Checks every rule, then writes matches and candidates. s1_ids: s1_id and position, its place in the file."""
    check_submission(matches, candidates, s1_ids, valid_ids)
    return {name: write_tsv(id_lists(df, s1_ids), f"{folder}/{name}.tsv", ("source1_entity_id", "matched_entity_ids"), "position") for name, df in (("matching", matches), ("candidates", candidates))}


def validate(script: str, folder: str, inputs: str, passed: str = "PASS", ran: str = "valid S2/S3 match IDs") -> str:
    """Runs a validator script on a written submission and returns what it says; raises unless it ends well, says passed, and
    shows that it looked up the ids (ran), which such a script may leave out silently when files are missing."""
    args = [sys.executable, script, "--matching", f"{folder}/matching.tsv", "--candidate", f"{folder}/candidates.tsv", "--test-dir", inputs, "--check-ids"]
    done = subprocess.run(args, capture_output=True, encoding="utf-8", env=os.environ | {"PYTHONIOENCODING": "utf-8"})
    said = done.stdout + done.stderr
    if done.returncode or passed not in done.stdout or ran not in done.stdout:
        raise SubmissionError(f"the validator did not pass it (exit {done.returncode}): {said}")
    return said


def markdown(rows: DataFrame, limit: int = 50) -> str:
    """The first rows as a table; cells are escaped."""
    cell = lambda v: "" if v is None else f"{v:.4f}" if isinstance(v, float) else str(v).replace("|", "\\|").replace("\n", " ")
    lines = ["| " + " | ".join(rows.columns) + " |", "|" + "---|" * len(rows.columns)]
    return "\n".join(lines + ["| " + " | ".join(map(cell, r)) + " |" for r in rows.limit(limit).collect()])
