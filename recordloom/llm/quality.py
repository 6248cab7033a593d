"""Quality rules as a ledger: every rule is evaluated once, its failure is a bit, and the measurements stay beside it.

A policy is a version and the rules it switches on. Applying one, comparing several, or asking what a rule alone costs reads
only the ledger: bits are masked and counted, texts are never read again.
"""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordloom.llm._common import slices, words_of

SYMBOLS = "#*$%&|<>"
SPACE = " \t\n\x0b\x0c\r"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_shouts")

#: Rule i has bit i; it fails where its expression over the measurements holds. Order is a format: append only.
RULES = (
    ("too_short", "n_words < 50"),
    ("repeats_itself", "100 * n_repeat_words > 50 * n_words"),
    ("many_symbols", "100 * n_symbols > 30 * n_words"),
    ("repeated_lines", "100 * n_dup_lines > 50 * n_lines"),
    ("long_words", "word_chars > 16 * n_words"),
    ("short_words", "10 * word_chars < 20 * n_words"),
    ("shouting", "100 * n_shouts > 50 * n_words"),
)
POLICIES = {"base": ("too_short", "repeats_itself"), "v1": tuple(name for name, _ in RULES)}


def bits(rules: Iterable[str]) -> int:
    at = {name: 1 << i for i, (name, _) in enumerate(RULES)}
    return sum(at[r] for r in set(rules))


def measure(text: str | None) -> tuple[int, ...]:
    """MEASURES of a text; null is an empty text. n_lines: lines with a word. n_shouts: words of capitals that end in "!"."""
    words = words_of(text)
    if not words:
        return (0,) * len(MEASURES)
    n = len(words)
    lines, seen = [x for x in text.split("\n") if x.strip(SPACE)], set()
    repeated = 0
    if n > 3 and len(windows := set(zip(words, words[1:], words[2:]))) < n - 2:
        del windows
        once, twice = set(), set()
        for w in zip(words, words[1:], words[2:]):
            (twice if w in once else once).add(w)
        until = 0
        for i, w in enumerate(zip(words, words[1:], words[2:])):
            if w in twice:
                repeated += i + 3 - max(i, until)
                until = i + 3
    duplicates = 0
    for x in lines:
        duplicates += x in seen
        seen.add(x)
    shouts = sum(w[-1] == "!" and w.isupper() for w in words) if "!" in text else 0
    return n, sum(map(len, words)), sum(map(text.count, SYMBOLS)), duplicates, repeated, len(lines), shouts


def ledger(docs: DataFrame) -> DataFrame:
    """doc_id, the measurements, and failed: a long with bit i set where rule i fails. A row for each row of docs, repeated ones
    too; long texts are measured whole. Only doc_id and text are read, so other columns may have any name."""
    rows = measured(docs.select("doc_id", "text"), [])
    return rows.select("doc_id", *MEASURES, failures().alias("failed"))


def measured(docs: DataFrame, carried: list[str]) -> DataFrame:
    """doc_id, the columns in carried, and the measurements of text."""
    names = ["doc_id", *carried]
    kinds = docs.select(*names).schema

    def run(batches):
        for b in slices(batches):
            found = zip(*map(measure, b.column("text").to_pylist()))
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), *(pa.array(x, pa.int64()) for x in found)], names=[*names, *MEASURES])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in kinds), *(f"{m} long" for m in MEASURES)])
    return docs.select(*dict.fromkeys([*names, "text"])).mapInArrow(run, schema)


def failures() -> Column:
    return F.expr(" | ".join(f"if({rule}, {1 << i}L, 0L)" for i, (_, rule) in enumerate(RULES)))


def applied(rows: DataFrame, policy: str = "v1") -> DataFrame:
    """A ledger with kept: no rule of the policy fails."""
    return rows.withColumn("kept", F.col("failed").bitwiseAND(F.lit(bits(POLICIES[policy])).cast("long")) == 0)


def ablation(rows: DataFrame, policy: str = "v1") -> DataFrame:
    """For each rule of the policy: rows that fail it, and rows that fail it alone, so that dropping the rule would keep them."""
    mask = F.col("failed").bitwiseAND(F.lit(bits(POLICIES[policy])).cast("long"))
    names = sorted(POLICIES[policy])
    counts = [F.struct(F.lit(r).alias("rule"), F.count(F.when(mask.bitwiseAND(F.lit(bits([r])).cast("long")) != 0, 1)).alias("fails"), F.count(F.when(mask == bits([r]), 1)).alias("fails_alone"), F.count(F.when(mask == 0, 1)).alias("kept")) for r in names]
    return rows.agg(F.array(*counts).alias("x")).select(F.explode("x").alias("x")).select(F.lit(policy).alias("policy"), "x.*")


def filtered(docs: DataFrame, policy: str = "v1") -> DataFrame:
    """The rows of docs that the policy keeps, with their columns."""
    inner = [f"_c{i}" for i in range(len(docs.columns))]
    rows = docs.toDF(*inner)
    rows = rows.withColumns({"doc_id": F.lit(0), "text": rows[inner[docs.columns.index("text")]]})
    rows = measured(rows, inner)
    mask = F.lit(bits(POLICIES[policy])).cast("long")
    return rows.filter(failures().bitwiseAND(mask) == 0).select(*inner).toDF(*docs.columns)


def digest(docs: DataFrame, policy: str = "v1") -> DataFrame:
    rows = applied(ledger(docs), policy)
    base = F.col("failed").bitwiseAND(F.lit(bits(POLICIES["base"])).cast("long")) != 0
    return rows.select("doc_id", *MEASURES[:5], base.alias("base_failed"), "kept", "failed")
