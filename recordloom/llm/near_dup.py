"""Near-duplicates by improved consistent weighted sampling (Ioffe, ICDM 2010) over TF-IDF shingles.

A text's shingles are its runs of five words; a shingle weighs its count times the mean idf of its words. Document
frequencies of words are counted exactly over all documents; a word in fewer than one document of RARE counts as one in so
many, so the table holds RARE words for each different word of a mean text at most, at every scale.
SAMPLES consistent samples make BANDS bands. Of the texts that share a band one is the centre, and the others are compared
with it by the exact weighted Jaccard similarity; connected components of the links are classes.

No link between texts of a band is lost, though most pairs are never formed: bands whose texts aren't of one class after
that go through an exact join by prefixes of their shingles, between classes only.

A shingle's own document frequency would punish large groups of copies: the copies make their shingles frequent, only what
differs stays rare and heavy, and near copies of a text with thousands of them would fall below the threshold.
"""

from __future__ import annotations

import functools
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordloom.llm._common import ranked, saved, slices, words_of

SHINGLE, THRESHOLD = 5, 0.8
BANDS, WIDTH = 16, 4
SAMPLES = BANDS * WIDTH
RARE, ORDER_ROWS = 4096, 1 << 17
#: Parts that the rows of a band are dealt to, one for each bit of a long.
SALTS = 64
#: Rows of random numbers for the sampling. Three numbers make a sample, and different bits of a shingle's hash choose the row
#: of each, so that shingles have RANDOM_ROWS ** 3 different samples.
RANDOM_ROWS = 1 << 14
ODD = np.uint64(0x9E3779B97F4A7C15)


class _Hashes(dict):
    def __missing__(self, word: str) -> int:
        h = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return h


_HASHES = _Hashes()


def hashes(text: str | None) -> np.ndarray:
    """The hashes of the words, lower-cased."""
    words = words_of(text.lower()) if text else []
    if len(_HASHES) > 150_000:
        _HASHES.clear()
    return np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * ODD
    return (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


class Idf:
    """Ascending hashes of common words with their idf, and that of all other words."""

    def __init__(self, words: np.ndarray, idf: np.ndarray, others: float):
        self.words, self.idf, self.others = words, idf, others

    def of(self, h: np.ndarray) -> np.ndarray:
        if not len(self.words):
            return np.full(len(h), self.others)
        at = np.minimum(np.searchsorted(self.words, h), len(self.words) - 1)
        return np.where(self.words[at] == h, self.idf[at], self.others)


def weighted(text: str | None, idf: Idf) -> tuple[np.ndarray, np.ndarray]:
    """The shingles of a text, in ascending order of their hashes, and their weights. A text of fewer words is one shingle."""
    h = hashes(text)
    n = len(h) - SHINGLE + 1
    if n <= 0:
        if not len(h):
            return h, np.empty(0)
        h = np.concatenate([h, np.zeros(SHINGLE - len(h), np.uint64)])
        n = 1
    own = idf.of(h)
    s, w = np.zeros(n, np.uint64), np.zeros(n)
    for k in range(SHINGLE):
        s = s * ODD + h[k : n + k]
        w += own[k : n + k]
    s = mixed(s)
    u, first, counts = np.unique(s, return_index=True, return_counts=True)
    return u, w[first] / SHINGLE * counts


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Sum of the lesser weights over sum of the greater ones."""
    total = a[1].sum() + b[1].sum()
    if len(a[0]) > len(b[0]):
        a, b = b, a
    at = np.minimum(np.searchsorted(b[0], a[0]), max(len(b[0]) - 1, 0))
    same = b[0][at] == a[0] if len(b[0]) else np.zeros(len(a[0]), bool)
    both = np.minimum(a[1][same], b[1][at[same]]).sum()
    return float(both / (total - both)) if total > both else float(total > 0)


@functools.lru_cache(1)
def _random() -> tuple[np.ndarray, ...]:
    rng = np.random.default_rng(1)
    shape = (RANDOM_ROWS, SAMPLES)
    r, c = rng.gamma(2, 1, shape), rng.gamma(2, 1, shape)
    return tuple(x.astype(np.float32) for x in (r, 1 / r, rng.random(shape), np.log(c)))


def bands(shingles: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The keys of BANDS bands; none for a text without words."""
    if not len(shingles):
        return np.empty(0, np.int64)
    r, inverse, beta, log_c = _random()
    least, shingle, level = np.full(SAMPLES, np.inf, np.float32), np.zeros(SAMPLES, np.uint64), np.zeros(SAMPLES, np.int64)
    columns = np.arange(SAMPLES)
    for i in range(0, len(shingles), 512):  # arrays of a slice stay in a core's cache, and are written in place
        s = shingles[i : i + 512]
        one, two, three = ((s >> np.uint64(k)).astype(np.int64) & (RANDOM_ROWS - 1) for k in (50, 36, 22))
        shift, t, a = beta.take(two, 0), inverse.take(one, 0), log_c.take(three, 0)
        t *= np.log(weights[i : i + 512]).astype(np.float32)[:, None]
        t += shift
        np.floor(t, out=t)
        np.subtract(t, shift, out=shift)
        shift += np.float32(1)
        shift *= r.take(one, 0)
        a -= shift
        k = a.argmin(0)
        lower = a[k, columns] < least
        least[lower], shingle[lower], level[lower] = a[k, columns][lower], s[k][lower], t[k, columns][lower]
    x = mixed(shingle + level.astype(np.uint64) * ODD).reshape(BANDS, WIDTH)
    keys = np.full(BANDS, 7, np.uint64) + np.arange(BANDS).astype(np.uint64)
    for k in range(WIDTH):
        keys = mixed(keys * ODD + x[:, k])
    return keys.view(np.int64)


def word_idf(docs: DataFrame) -> Idf:
    """1 + ln((1 + documents) / (1 + documents with the word)), with documents / RARE as the least count of a word.

    Every task counts its own words before the shuffle. The driver gets the words in one document of RARE or more: as each
    document counts for its different words alone, RARE times their mean number at most.
    """

    def counted(batches):
        counts: Counter[int] = Counter()
        for b in slices(batches):
            found = np.concatenate([np.empty(0, np.uint64), *(np.unique(hashes(t)) for t in b.column("text").to_pylist())])
            counts.update(dict(zip(*(x.tolist() for x in np.unique(found.view(np.int64), return_counts=True)))))
            if len(counts) > 500_000:
                yield batch(counts)
                counts.clear()
        yield batch(counts)

    def batch(counts):
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.int64()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    documents = docs.count()
    words = docs.select("text").mapInArrow(counted, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    got = words.filter(F.col("n") * RARE > documents).toPandas()
    keys, n = got["word"].to_numpy(np.int64).view(np.uint64), got["n"].to_numpy()
    order = np.argsort(keys)
    return Idf(keys[order], 1 + np.log((1 + documents) / (1 + n[order])), 1 + float(np.log((1 + documents) / (1 + documents / RARE))))


def sketched(docs: DataFrame, idf) -> DataFrame:
    """doc_id, two hashes of the text, and its bands."""

    def run(batches):
        own = idf.value
        for b in slices(batches):
            keys = [bands(*weighted(t, own)) for t in b.column("text").to_pylist()]
            ends = np.concatenate([[0], np.cumsum([len(k) for k in keys])])
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([np.empty(0, np.int64), *keys]), pa.int64()))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("x"), b.column("y"), lists], names=["doc_id", "x", "y", "keys"])

    return docs.mapInArrow(run, "doc_id long, x long, y long, keys array<long>")


def compared(pairs: DataFrame, texts: DataFrame, idf) -> DataFrame:
    """a, b, and j, their similarity, of pairs (a, b) of nodes; texts: node, text."""

    def run(batches):
        own, held, last = idf.value, None, None
        for batch in batches:
            for i in range(0, batch.num_rows, 200):
                b, found = batch.slice(i, 200), []
                for k, one, other in zip(b.column("b").to_pylist(), b.column("text_a").to_pylist(), b.column("text_b").to_pylist()):
                    if k != last:
                        held, last = weighted(other, own), k
                    found.append(similarity(weighted(one, own), held))
                yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b"), pa.array(found, pa.float64())], names=["a", "b", "j"])

    one, other = (texts.select(F.col("node").alias(c), F.col("text").alias(f"text_{c}")) for c in "ab")
    sides = pairs.join(one, "a").join(other, "b").select("a", "b", "text_a", "text_b")
    return sides.mapInArrow(run, "a long, b long, j double").distinct()


def with_totals(rows: DataFrame, *totals: Column, where: str = "true") -> DataFrame:
    """rows (key, node, ...) with totals over all rows of their key; rows of keys whose totals fail where go.

    Totals are aggregated before they are shuffled, and each key's are joined with its rows in up to SALTS parts by node, so
    that the band of a large group of copies is dealt to as many tasks. A bit for each part that has rows keeps the totals'
    side no larger than the rows'.
    """
    rows = rows.withColumn("_salt", F.pmod("node", F.lit(SALTS)).cast("int"))
    found = rows.groupBy("key").agg(*totals, F.expr("bit_or(shiftleft(1L, _salt))").alias("_salts")).filter(where)
    parts = found.withColumn("_salt", F.expr(f"explode(filter(sequence(0, {SALTS - 1}), i -> bit_get(_salts, i) = 1))")).drop("_salts")
    return rows.join(parts, ["key", "_salt"]).drop("_salt")


def linked(members: DataFrame, texts: DataFrame, idf, threshold: float) -> DataFrame:
    """a, b: links that hold together all that links between texts of a band hold together. members: key, node.

    First each band's most crowded text is compared with the others: what copies with different changes were made from has
    all their common bands, and so one comparison links each of them. Bands that then are of one class are done. Texts of the
    others are joined exactly, by prefixes.
    """
    crowd = with_totals(members, F.count("*").alias("_n")).groupBy("node").agg(F.sum("_n").alias("crowd"))
    rows = saved(members.join(crowd, "node"), "crowded")
    stars = with_totals(rows, F.max_by("node", F.struct("crowd", "node")).alias("c")).filter("node <> c")
    pairs = stars.select(F.greatest("node", "c").alias("a"), F.least("node", "c").alias("b")).distinct()
    tested = saved(compared(pairs, texts, idf), "compared")
    links = tested.filter(F.col("j") >= threshold).select("a", "b")
    rows = members.join(components(links), "node", "left").withColumn("root", F.coalesce("root", "node"))
    several = with_totals(rows, F.min("root").alias("lo"), F.max("root").alias("hi"), where="lo < hi")
    open_nodes = saved(several.select("node", "root").distinct(), "open")
    pairs = across(open_nodes, texts, idf, threshold).join(tested, ["a", "b"], "left_anti")
    found = saved(compared(pairs, texts, idf), "compared").filter(F.col("j") >= threshold)
    return links.unionAll(found.select("a", "b"))


def across(nodes: DataFrame, texts: DataFrame, idf, threshold: float) -> DataFrame:
    """a, b: all pairs of different roots that can reach the threshold, and some that can't. nodes: node, root.

    Texts whose similarity reaches t share at least t of either one's weight. With all shingles in one order, both then have
    their first common shingle among their first ones, those before the last t of their weight. The order is by how often a
    shingle occurs in these texts (counted in ORDER_ROWS hashed rows: where rows are shared, only time is lost) and then by
    hash, so what changes made unique comes first and joins with nothing. From their first common shingle on, both texts must
    have the weight that the threshold asks of what they share.
    """

    def counted(batches):
        own, counts = idf.value, np.zeros(ORDER_ROWS, np.int64)
        for b in slices(batches):
            for t in b.column("text").to_pylist():
                np.add.at(counts, (weighted(t, own)[0] & np.uint64(ORDER_ROWS - 1)).astype(np.int64), 1)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(counts[some], pa.int64())], names=["row", "n"])

    whole = saved(texts.join(nodes, "node"), "open-texts")
    order = np.zeros(ORDER_ROWS, np.int64)
    got = whole.select("text").mapInArrow(counted, "row long, n long").groupBy("row").agg(F.sum("n").alias("n")).toPandas()  # ORDER_ROWS rows at most
    order[got["row"].to_numpy()] = got["n"].to_numpy()
    sent = nodes.sparkSession.sparkContext.broadcast(order)

    def prefixes(batches):
        own, first = idf.value, sent.value
        for b in slices(batches):
            out, rest, total = [], [], []
            for t in b.column("text").to_pylist():
                s, w = weighted(t, own)
                by = np.lexsort((s, first[(s & np.uint64(ORDER_ROWS - 1)).astype(np.int64)]))
                left = w.sum() - np.cumsum(w[by]) + w[by]
                n = int(np.count_nonzero(left >= threshold * w.sum() - 1e-6))
                out.append(s[by[:n]])
                rest.append(left[:n])
                total.append(np.full(n, w.sum()))
            n = [len(x) for x in out]
            flat = np.concatenate([np.empty(0, np.uint64), *out]).view(np.int64)
            at = pa.array(np.repeat(np.arange(len(n)), n))
            yield pa.RecordBatch.from_arrays([pa.array(flat, pa.int64()), b.column("node").take(at), b.column("root").take(at), *(pa.array(np.concatenate([np.empty(0), *x]), pa.float64()) for x in (rest, total))], names=["shingle", "node", "root", "rest", "total"])

    rows = saved(whole.select("node", "root", "text").mapInArrow(prefixes, "shingle long, node long, root long, rest double, total double"), "prefixes")
    each = rows.groupBy("shingle", "root").agg(F.count("*").alias("n"))
    main = each.groupBy("shingle").agg(F.max_by("root", F.struct("n", "root")).alias("_main"), F.count("*").alias("_roots")).filter("_roots > 1").select("shingle", "_main")
    rows = rows.join(main, "shingle")
    few = rows.filter("root <> _main").select("shingle", F.col("node").alias("x"), F.col("root").alias("_x"), F.col("rest").alias("_rest"), F.col("total").alias("_total"))
    enough = F.least("rest", "_rest") >= threshold / (1 + threshold) * (F.col("total") + F.col("_total")) - 1e-6
    pairs = few.join(rows, "shingle").filter(F.col("root") != F.col("_x")).filter(enough)
    return pairs.select(F.greatest("node", "x").alias("a"), F.least("node", "x").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, root (the least node of its component), by alternating large-star and small-star steps (Kiveris et al., 2014).

    edges: a, b, longs. Minima are aggregated before they are shuffled, and joins on a hot node can be split.
    """
    state = None
    edges = saved(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "edges")
    while True:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        large = saved(large, "large-star")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(least, "a")
        small = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(least.select("a", F.col("m").alias("b")))
        edges = saved(small.filter("a <> b").distinct(), "small-star")
        now = edges.agg(F.count("*"), F.sum(F.col("a").cast("decimal(38,0)")), F.sum(F.col("b").cast("decimal(38,0)")), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = now


def _hashed(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.withColumns({"x": F.xxhash64(text), "y": F.xxhash64(F.lit(1), text)})


def classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """root (the class's own number), x, y (hashes of a text), class_id (the least doc_id of its class), doc_id (the least of this text), class_size (rows)
    and copies (rows of this text): a row for each different text.

    Equal texts always share a class; null counts as the empty text. Texts without words link to nothing else. A class whose
    rows have no ids has a null class_id.
    """
    spark = docs.sparkSession
    rows = _hashed(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    idf = spark.sparkContext.broadcast(word_idf(rows))  # RARE words for each of a mean text's at most
    sketches = saved(sketched(rows, idf), "sketches")
    texts = sketches.groupBy("x", "y").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"), F.first("keys").alias("keys"))
    texts, _ = ranked(texts, ["x", "y"], "texts")
    texts = texts.withColumnRenamed("rank", "node")
    keys = texts.select("node", F.explode("keys").alias("key"))
    several = with_totals(keys, F.min("node").alias("_a"), F.max("node").alias("_z"), where="_a < _z")
    members = saved(several.select("node", "key"), "members")
    wanted = texts.join(members.select("node").distinct(), "node").select("x", "y", "node", F.col("doc_id").alias("_d"))
    whole = rows.join(wanted, ["x", "y"]).filter(F.col("doc_id").eqNullSafe(F.col("_d"))).select("node", "text")
    whole = saved(whole.dropDuplicates(["node"]), "candidates")
    roots = components(linked(members, whole, idf, threshold))
    labelled = texts.select("x", "y", "node", "doc_id", "copies").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    groups = labelled.groupBy("root").agg(F.min("doc_id").alias("class_id"), F.sum("copies").alias("class_size"))
    return labelled.join(groups, "root").select("root", "x", "y", "class_id", "doc_id", "class_size", "copies")


def labelled(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, class_id, class_size, kept (it has the class's least id) of each row of docs."""
    own = saved(classes(docs, threshold), "classes").drop("root", "doc_id", "copies")
    rows = _hashed(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")).select("doc_id", "x", "y")
    return rows.join(own, ["x", "y"]).select("doc_id", "class_id", "class_size", F.col("doc_id").eqNullSafe(F.col("class_id")).alias("kept"))


def deduplicated(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row of each class of docs, with its columns: of the least doc_id, and of repeated rows any one."""
    own = saved(classes(docs, threshold), "classes").filter(F.col("doc_id").eqNullSafe(F.col("class_id")))
    # a doc_id with several texts in a class gives the text with the least hashes
    own = own.groupBy(F.col("class_id").alias("_d"), "root").agg(F.min(F.struct("x", "y", "copies")).alias("t"))
    own = own.select("_d", F.col("t.x").alias("_x"), F.col("t.y").alias("_y"), F.col("t.copies").alias("_n"))
    names = [f"_c{i}" for i in range(len(docs.columns))]
    d, t = (F.col(names[docs.columns.index(c)]) for c in ("doc_id", "text"))
    rows = docs.toDF(*names)
    text = F.coalesce(t, F.lit(""))
    rows = rows.withColumns({"_x": F.xxhash64(text), "_y": F.xxhash64(F.lit(1), text)}).join(own, ["_x", "_y"]).filter(d.cast("long").eqNullSafe(F.col("_d")))
    single, several = rows.filter("_n = 1"), rows.filter("_n > 1").dropDuplicates(["_x", "_y"])
    return single.unionAll(several).select(*names).toDF(*docs.columns)
