"""Benchmark decontamination: n-gram seeds find places, Smith-Waterman alignment judges them.

The benchmark is read in blocks of bounded size. Every n-gram of an item is a seed, however many documents hold it: a common
phrase only costs alignments. Where a seed occurs in a document, the passage
around it is aligned with the whole item, word by word, so copies with words changed, added or left out score high too.
Documents are never shuffled: what a task needs of the benchmark is broadcast, and its size is that of a block.
"""

from __future__ import annotations

import functools
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.llm._common import slices

WORD = re.compile(r"\w+")
GRAM, MIN_WORDS = 3, 5
MATCH, MISMATCH, GAP = 2, -1, 1
#: The least score of an alignment, as a share of that of the item with itself.
THRESHOLD = 0.5
#: The most words of a block of the benchmark.
BLOCK_WORDS = 1_000_000


def words(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def span(item: np.ndarray, passage: np.ndarray) -> tuple[int, int]:
    """Where in the passage the best alignment begins and ends: what ends best, read backwards, ends where it begins."""
    end = align(item, passage)[1]
    return end - align(item[::-1], passage[:end][::-1])[1], end


def align(item: np.ndarray, passage: np.ndarray) -> tuple[float, int]:
    """The best local alignment's score, as a share of the item's own, and where in the passage it ends.

    A row of the matrix is made from the one above at once; gaps along the row come from a running maximum.
    """
    steps = np.arange(len(passage) + 1) * GAP
    above, best, end = np.zeros(len(passage) + 1, np.int64), 0, 0
    for w in item:
        row = np.maximum(above - GAP, 0)
        np.maximum(row[1:], above[:-1] + np.where(passage == w, MATCH, MISMATCH), out=row[1:])
        row = np.maximum.accumulate(row + steps) - steps
        if (top := int(row.max())) > best:
            best, end = top, int(row.argmax())
        above = row
    return best / (MATCH * len(item)), end


class Index:
    """Of a block: word numbers (0: not in the block), items, and each n-gram's code with where it stands in items."""

    def __init__(self, items: list[tuple[int, str | None]]):
        self.number: dict[str, int] = {}
        split = [(i, words(t)) for i, t in items]
        self.short = defaultdict(list)
        for i, x in split:
            if 0 < len(x) < MIN_WORDS:
                self.short[tuple(x)].append(i)
        self.items = [(i, np.array([self.number.setdefault(w, len(self.number) + 1) for w in x], np.int64)) for i, x in split if len(x) >= MIN_WORDS]
        self.base = len(self.number) + 1
        places = defaultdict(list)
        for k, (_, x) in enumerate(self.items):
            for at, code in enumerate(self.codes(x).tolist()):
                places[code].append((k, at))
        self.grams = np.array(sorted(places), np.int64)
        self.places = [places[g] for g in self.grams.tolist()]

    def codes(self, x: np.ndarray) -> np.ndarray:
        """The code of each n-gram, -1 where a word isn't in the block."""
        n = len(x) - GRAM + 1
        if n <= 0:
            return np.empty(0, np.int64)
        out, known = np.zeros(n, np.int64), np.ones(n, bool)
        for k in range(GRAM):
            out = out * self.base + x[k : n + k]
            known &= x[k : n + k] > 0
        return np.where(known, out, -1)

    def found(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where in x the block's n-grams stand, and which they are."""
        c = self.codes(x)
        at = np.flatnonzero(c >= 0)
        if not len(at) or not len(self.grams):
            return at[:0], at[:0]
        g = np.minimum(np.searchsorted(self.grams, c[at]), len(self.grams) - 1)
        hit = self.grams[g] == c[at]
        return at[hit], g[hit]

    def matches(self, text: str | None, threshold: float) -> list[tuple[int, float, int, int]]:
        """item_id, score, and the aligned passage [from, to) in words, for each item that reaches the threshold."""
        whole = words(text)
        x = np.fromiter((self.number.get(w, 0) for w in whole), np.int64, len(whole))
        out = [(i, 1.0, 0, len(whole)) for i in self.short.get(tuple(whole), ())] if len(whole) < MIN_WORDS else []
        at, grams = self.found(x)
        starts = defaultdict(list)
        for p, g in zip(at.tolist(), grams.tolist()):
            for k, q in self.places[g]:
                starts[k].append(p - q)
        for k, own in starts.items():
            i, item = self.items[k]
            slack, best = max(8, len(item) // 4), (0.0, 0, 0)
            own = np.unique(own)
            cuts = np.flatnonzero(np.diff(own) > len(item) + 2 * slack) + 1  # windows that touch are one
            for first, last in zip(own[np.concatenate([[0], cuts])].tolist(), own[np.concatenate([cuts - 1, [-1]])].tolist()):
                a, z = max(0, first - slack), min(len(x), last + len(item) + slack)
                best = max(best, (align(item, x[a:z])[0], a, z))
            if best[0] >= threshold:
                score, a, z = best
                first, last = span(item, x[a:z])
                out.append((i, score, a + first, a + last))
        return sorted(out)


def blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of BLOCK_WORDS words at most (or one longer item); the driver holds one block at a time."""
    block, n = [], 0
    for r in benchmark.filter(F.col("text").isNotNull()).select("item_id", "text").toLocalIterator():
        size = len(r["text"].split())
        if block and n + size > BLOCK_WORDS:
            yield block
            block, n = [], 0
        block.append((r["item_id"], r["text"]))
        n += size
    if block:
        yield block


@functools.lru_cache(4)
def _index(key: int, sent) -> Index:
    return Index(sent.value)


def matched(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """A row for each document row and item of which the document holds a copy: doc_id, item_id, score, first_word, last_word
    (the passage that is aligned, end exclusive).

    Words are runs of letters and digits, lower-cased. Items of fewer than MIN_WORDS words say too little inside a text: they
    match documents that have just their words. Items and texts without words match nothing. Items with equal texts each
    match. Repeated rows each give their rows; long texts are read whole. Only doc_id and text are read. The benchmark has a
    scan of the documents for each block of BLOCK_WORDS words.
    """
    schema, out = "doc_id long, item_id long, score double, first_word long, last_word long", None
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    for items in blocks(benchmark):
        sent = docs.sparkSession.sparkContext.broadcast(items)
        part = rows.mapInArrow(functools.partial(_matches, sent._jbroadcast.id(), sent, threshold), schema)
        out = part if out is None else out.unionAll(part)
    return docs.sparkSession.createDataFrame([], schema) if out is None else out


def _matches(key, sent, threshold, batches):
    own = _index(key, sent)
    for b in slices(batches):
        found = [(d, *m) for d, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()) for m in own.matches(t, threshold)]
        if found:
            d, i, s, a, z = zip(*found)
            yield pa.RecordBatch.from_arrays([pa.array(d, pa.int64()), pa.array(i, pa.int64()), pa.array(s, pa.float64()), pa.array(a, pa.int64()), pa.array(z, pa.int64())], names=["doc_id", "item_id", "score", "first_word", "last_word"])


def clean(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs that hold no copy of an item, with their columns and without a shuffle."""
    names, at = [f"_c{i}" for i in range(len(docs.columns))], docs.columns.index("text")
    rows = docs.toDF(*names).withColumn("text", F.col(f"_c{at}"))
    for items in blocks(benchmark):
        sent = docs.sparkSession.sparkContext.broadcast(items)
        rows = rows.mapInArrow(functools.partial(_cleaned, sent._jbroadcast.id(), sent, threshold), rows.schema)
    return rows.select(*names).toDF(*docs.columns)


def _cleaned(key, sent, threshold, batches):
    own = _index(key, sent)
    for b in slices(batches):
        yield b.filter(pa.array([not own.matches(t, threshold) for t in b.column("text").to_pylist()], pa.bool_()))
