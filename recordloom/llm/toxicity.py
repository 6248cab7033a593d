"""Toxicity from subword-bag embeddings averaged into a linear softmax, both trained together in numpy.

A word is the bag of its character n-grams, with marks at its ends, and itself; each is a row of one embedding table, by
hash. A word's vector is their mean, a text's vector the mean over its words, and a softmax over two classes reads it. An
unseen misspelling shares most n-grams, and so most of its vector, with the word it stands for.
"""

from __future__ import annotations

import functools
import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.llm._common import slices

WORD = re.compile(r"\w+")
#: n-gram lengths, rows and width of the table, weight on the rows' squares, epochs, step size.
NGRAMS, ROWS, WIDTH, DECAY, EPOCHS, STEP = (3, 4, 5, 6, 7), 1 << 19, 8, 1e-6, 100, 0.05
#: The labelled rows that a model is fitted on: all of them, or the so many with the least hash of their id.
MAX_ROWS = 5000
THRESHOLD = 0.7
#: Words without meaning that every text has besides its own: a short text's few words then decide less.
PAD = 100
#: What the mean over words is multiplied by before the softmax: a few words in a hundred must be able to decide.
SCALE = 100.0
#: What a table row loses of its length in each epoch.
SHRINK = 0.04
#: How far the classes' weights in the loss go from equal for all rows (0) to equal sums for both classes (1).
BALANCE = 0.5
#: Parts of the sample that the scores are calibrated on, each by a model of the others.
FOLDS = 2
PRIME = np.uint64(1099511628211)


def subwords(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """For all words in a row: the index of the word, and the table row, of each n-gram and of each whole word."""
    marked = [f"<{w}>" for w in words]
    codes = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    n = np.fromiter(map(len, marked), np.int64, len(marked))
    ends, of = np.cumsum(n), np.repeat(np.arange(len(n)), n)
    left = ends[of] - np.arange(len(codes))  # characters from here to the word's end
    h, at, rows = np.zeros(len(codes), np.uint64), [], []
    with np.errstate(over="ignore"):
        for k in range(1, max(NGRAMS) + 1):
            h[: len(codes) - k + 1] = h[: len(codes) - k + 1] * PRIME + codes[k - 1 :] + np.uint64(1)
            if k in NGRAMS:
                i = np.flatnonzero((left >= k))
                x = h[i] ^ (h[i] >> np.uint64(29))
                at.append(of[i])
                rows.append(((x * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)) % np.uint64(ROWS))
    whole = np.fromiter((zlib.crc32(w.encode("utf-8", "surrogatepass")) % ROWS for w in marked), np.int64, len(marked))
    return np.concatenate([*at, np.arange(len(words))]), np.concatenate([*(r.astype(np.int64) for r in rows), whole])


def tokens(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


class Model:
    """table: ROWS x WIDTH; output: WIDTH x 2; bias: 2. All arrays of float32."""

    def __init__(self, table: np.ndarray, output: np.ndarray, bias: np.ndarray):
        self.table, self.output, self.bias = table, output, bias
        #: What a table row adds to the log odds of class 1: the product is linear, so it is made once.
        self.odds = (table @ (output[:, 1] - output[:, 0])).astype(np.float32)
        self.known: dict[str, float] = {}

    def learn(self, words: list[str]) -> None:
        new = list({w for w in words if w not in self.known})
        if new:
            if len(self.known) > 400_000:
                self.known.clear()
                new = list(set(words))
            of, rows = subwords(new)
            odds = np.bincount(of, self.odds[rows], len(new)) / np.bincount(of, minlength=len(new))
            self.known.update(zip(new, odds.tolist()))

    def log_odds(self, texts: list[str | None]) -> np.ndarray:
        split = [tokens(t) for t in texts]
        self.learn([w for x in split for w in x])
        return np.array([SCALE * sum(map(self.known.__getitem__, x)) / (len(x) + PAD) for x in split]) + float(self.bias[1] - self.bias[0])

    def scores(self, texts: list[str | None]) -> list[float]:
        """The probability of class 1; a text without words has that of the bias alone."""
        odds = self.log_odds(texts)
        return (1 / (1 + np.exp(-np.clip(odds, -60, 60)))).tolist()


def calibration(odds: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Platt's a, b of the log odds a * odds + b that fit labels best, by Newton's method on his smoothed targets. Rows of one
    class only, or odds that don't rise with the labels, leave the odds as they are."""
    n1 = int(y.sum())
    if not 0 < n1 < len(y):
        return 1.0, 0.0
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (len(y) - n1 + 2))
    x, at = np.stack([odds, np.ones(len(odds))], 1), np.array([1.0, 0.0])
    loss = lambda w: float(np.sum(np.logaddexp(0, x @ w) - target * (x @ w)))
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -60, 60)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-9 * np.eye(2), x.T @ (p - target))
        scale = 1.0
        while scale > 1e-6 and loss(at - scale * step) > loss(at):
            scale /= 2
        at = at - scale * step
        if np.abs(scale * step).max() < 1e-9:
            break
    return (float(at[0]), float(at[1])) if at[0] > 0 else (1.0, 0.0)


def fit_calibrated(texts: list[str | None], labels: list[int], folds: int = FOLDS) -> Model:
    """fit() on all rows, its scores made probabilities by what models of the other folds say of each fold's rows: on the rows
    that it was fitted on a model is surer than on any others."""
    y, odds = np.array(labels, np.int64), np.zeros(len(texts))
    of = np.arange(len(texts)) % folds
    for k in range(folds if len(texts) >= folds else 0):
        others, own = np.flatnonzero(of != k), np.flatnonzero(of == k)
        odds[own] = fit([texts[i] for i in others], y[others].tolist()).log_odds([texts[i] for i in own])
    a, b = calibration(odds, y)
    model = fit(texts, labels)
    model.odds *= np.float32(a)
    model.bias = np.array([0, a * float(model.bias[1] - model.bias[0]) + b], np.float32)
    return model


def fit(texts: list[str | None], labels: list[int], seed: int = 5, epochs: int = EPOCHS) -> Model:
    """Full-batch Adam on the softmax's cross-entropy, for table and output together.

    A table row's gradient is a number times the difference of the output's columns, so what is scattered is one number,
    whatever WIDTH is.
    """
    rng = np.random.default_rng(seed)
    table = rng.uniform(-0.5, 0.5, (ROWS, WIDTH)).astype(np.float32) / WIDTH
    output, y = rng.normal(0, 0.5, (WIDTH, 2)).astype(np.float32), np.array(labels, np.int64)
    bias = np.log(np.maximum(np.bincount(y, minlength=2), 1) / max(len(y), 1)).astype(np.float32)
    places: dict[str, int] = {}
    words, lengths = array("q"), []
    for t in texts:
        own = tokens(t)
        words.extend(places.setdefault(w, len(places)) for w in own)
        lengths.append(len(own))
    if not words:
        return Model(table * 0, output, bias)
    lengths, n = np.array(lengths), len(places)
    pair, counts = np.unique(np.repeat(np.arange(len(lengths)) * n, lengths) + np.frombuffer(words, np.int64), return_counts=True)
    doc, word = (pair // n).astype(np.int32), (pair % n).astype(np.int32)
    share = (SCALE * counts / (lengths[doc] + PAD)).astype(np.float32)
    del pair, counts
    different, grams, used = list(places), [], np.zeros(ROWS, bool)
    for i in range(0, n, 20_000):  # the n-grams of so many words at once, each word's in a row: all would take the driver's memory
        of, rows = subwords(different[i : i + 20_000])
        size = np.bincount(of)
        grams.append((rows[np.argsort(of, kind="stable")].astype(np.int32), np.concatenate([[0], np.cumsum(size)[:-1]]), size))
        used[rows] = True
    number = np.cumsum(used) - 1
    grams = [(number[rows].astype(np.int32), starts, size) for rows, starts, size in grams]
    e, moments, steps = table[used], {}, 0
    weight = ((len(y) / 2 / np.maximum(np.bincount(y, minlength=2), 1)) ** BALANCE)[y] / len(y)

    def adam(key: str, x: np.ndarray, g: np.ndarray) -> None:
        m, v = moments.setdefault(key, (np.zeros_like(x), np.zeros_like(x)))
        m += 0.1 * (g - m)
        v += 0.001 * (g * g - v)
        x -= STEP * (m / (1 - 0.9**steps)) / (np.sqrt(v / (1 - 0.999**steps)) + 1e-8)

    for steps in range(1, epochs + 1):
        apart = output[:, 1] - output[:, 0]  # of two classes, only the difference of the logits matters
        z = e @ apart
        words = np.concatenate([np.add.reduceat(z[rows], starts) / size for rows, starts, size in grams])
        odds = np.bincount(doc, words[word] * share, len(y)) + float(bias[1] - bias[0])
        d = (1 / (1 + np.exp(-np.clip(odds, -60, 60))) - y) * weight
        back = np.bincount(word, d[doc] * share, n)
        g, i = np.zeros(len(e)), 0
        for rows, _, size in grams:
            g += np.bincount(rows, np.repeat(back[i : i + len(size)] / size, size), len(e))
            i += len(size)
        g = g.astype(np.float32)
        toward = e.T @ g
        adam("o", output, np.stack([-toward, toward], 1))
        adam("e", e, g[:, None] * apart + DECAY * e)
        e *= np.maximum(0, 1 - SHRINK / np.maximum(np.sqrt((e * e).sum(1, keepdims=True)), 1e-9))  # rows that gain little go to zero
        adam("b", bias, np.array([-d.sum(), d.sum()], np.float32))
    table[:] = 0  # rows that no training word has carry nothing
    table[used] = e
    return Model(table, output, bias)


def held_out(doc_id: str = "doc_id"):
    """Whether labels of a document are never learned from; without an id it is false."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def trained(docs: DataFrame, labels: DataFrame, label: str = "toxic", max_rows: int = MAX_ROWS) -> Model:
    """A model of the labelled rows that aren't held out: at most max_rows of them, those whose ids have the least hashes.

    Several labels of a document count as the largest; null labels and labels without a document are not used.
    """
    known = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out()).groupBy("doc_id").agg(F.max(label).cast("int").alias("_y"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most max_rows rows of two numbers
    rows = rows.dropDuplicates(["doc_id"]) if max_rows else rows
    got = sorted(rows.select("doc_id", "_y", "text").collect(), key=lambda r: r["doc_id"])
    return fit_calibrated([r["text"] for r in got], [r["_y"] for r in got])


@functools.lru_cache(2)
def _held(odds: bytes, bias: bytes) -> Model:
    m = Model.__new__(Model)
    m.odds, m.bias, m.known = np.frombuffer(odds, np.float32), np.frombuffer(bias, np.float32), {}
    return m


def scored(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of each row of docs, repeated rows too. Only doc_id and text are read, so other columns
    may have any name; null texts count as empty, and long ones are read whole."""
    sent = docs.sparkSession.sparkContext.broadcast((model.odds.tobytes(), model.bias.tobytes()))  # 4 * ROWS bytes

    def run(batches):
        own = _held(*sent.value)
        for b in slices(batches):
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(own.scores(b.column("text").to_pylist()), pa.float64())], names=["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")
    return rows.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
