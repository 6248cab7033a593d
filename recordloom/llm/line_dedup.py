"""Line deduplication with DataFrame functions only.

Lines become (128-bit hash of the key, document, position). They are dealt by ranges of all three, so a line that a third of
all documents share spreads over many tasks, sorted inside each task, and written out. In each range, the first occurrences
are streamed in (document, position) order; a key that runs over the edge of a range takes its first document from a table
with at most one row a range. What goes back to the documents is a run-length coded bitmap for each, never text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recordloom.llm._common import partitions, saved

MIN_KEY = 10
LAST = (1 << 63) - 1
SPACES = "\\u0020\\u0009\\u000a\\u000b\\u000c\\u000d"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _numbered(docs: DataFrame) -> DataFrame:
    """doc_id, _doc (null ids last, as one document), _text (null: empty) and _h: rows of one id and text are alike."""
    rows = docs.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("_doc"), F.coalesce("text", F.lit("")).alias("_text"))
    return rows.withColumn("_h", F.xxhash64("_text"))


def dropped_lines(docs: DataFrame, min_key: int = MIN_KEY) -> DataFrame:
    """_doc, _h (hash of the text) and _bits: the positions that document loses, as runs [first, length] in ascending order.

    Documents that keep every line have no row. A key is the line without white space at its ends, A-Z lower-cased.
    """
    lines = _numbered(docs).select("_doc", "_h", F.posexplode(F.split("_text", "\n", -1)).alias("_pos", "_line"))
    key = F.expr(f"btrim(_line, '{SPACES}')")
    lines = lines.select("_doc", "_h", "_pos", key.alias("_key")).filter(F.char_length("_key") >= min_key)
    lines = lines.withColumn("_key", F.translate("_key", UPPER, LOWER))
    lines = lines.select(F.xxhash64("_key").alias("_a"), F.xxhash64(F.lit(1), F.col("_key")).alias("_b"), "_doc", "_h", "_pos")
    order = ["_a", "_b", "_doc", "_pos", "_h"]
    ranges = lines.repartitionByRange(partitions(docs.sparkSession), *order).sortWithinPartitions(*order)
    ranges = saved(ranges.withColumn("_part", F.spark_partition_id()), "lines")
    ends = ranges.groupBy("_part").agg(F.min(F.struct("_a", "_b")).alias("lo"), F.max(F.struct("_a", "_b")).alias("hi"))
    edges = ends.select(F.explode(F.array_distinct(F.array("lo", "hi"))).alias("e")).groupBy("e").count().filter("count > 1").select("e.*")  # keys at the edge of two ranges or more
    carried = ranges.join(F.broadcast(edges), ["_a", "_b"], "left_semi").groupBy("_a", "_b").agg(F.min("_doc").alias("_carried"))
    stream = Window.partitionBy("_part", "_a", "_b").orderBy("_doc", "_pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first = ranges.withColumn("_first", F.first("_doc").over(stream)).join(F.broadcast(carried), ["_a", "_b"], "left")
    lost = first.filter(F.col("_doc") > F.least("_first", "_carried")).select("_doc", "_h", F.col("_pos"))
    lists = lost.groupBy("_doc", "_h").agg(F.array_sort(F.collect_set("_pos")).alias("_p"))
    # a run ends where the next position isn't the next number
    at = "sequence(1, size(_p))"
    firsts = f"filter({at}, i -> i = 1 OR element_at(_p, i) <> get(_p, i - 2) + 1)"
    ends_ = f"filter({at}, i -> i = size(_p) OR get(_p, i) <> element_at(_p, i) + 1)"
    runs = f"zip_with({firsts}, {ends_}, (a, z) -> array(element_at(_p, a), z - a + 1))"
    return lists.select("_doc", "_h", F.expr(runs).alias("_bits"))


def deduplicated(docs: DataFrame, min_key: int = MIN_KEY) -> DataFrame:
    """doc_id, text (the lines that stay, joined), n_lines (before) and n_dropped of each row of docs.

    Null and empty texts have one empty line, which stays. Rows without a doc_id count as one document after all others.
    Repeated rows of one id are one document: they lose the same lines, and none to each other. Only doc_id and text are read.
    """
    rows = _numbered(docs).join(dropped_lines(docs, min_key), ["_doc", "_h"], "left")
    rows = rows.select("doc_id", "_text", "_bits", F.size(F.split("_text", "\n", -1)).cast("long").alias("n_lines"))
    n = F.expr("coalesce(aggregate(_bits, 0L, (n, r) -> n + r[1]), 0L)")
    return rows.select("doc_id", F.when(F.col("_bits").isNull(), F.col("_text")).otherwise(_kept()).alias("text"), "n_lines", n.alias("n_dropped"))


def _kept():
    """The lines between the runs of _bits, joined: a few slices, however many lines there are."""
    lines = "split(_text, '\\n', -1)"
    gaps = "zip_with(concat(array(0), transform(_bits, r -> r[0] + r[1])), concat(transform(_bits, r -> r[0]), array(n_lines)), (a, z) -> named_struct('a', a, 'z', z))"
    return F.expr(f"array_join(aggregate(array({lines}), array(''), (none, l) -> flatten(transform({gaps}, g -> slice(l, CAST(g.a AS int) + 1, CAST(g.z - g.a AS int))))), '\\n')")


def digest(docs: DataFrame) -> DataFrame:
    return deduplicated(docs).select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256"))
