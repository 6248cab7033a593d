"""Mixing sources to target weights: an exact subset of documents for each source's budget of words.

Documents are counted by exact length, and each may be taken as often as the limit says. Of each length the same share is
taken first; the words that then are missing are made up, as near as some subset comes on either side, by a bounded knapsack
over the copies that are left. Last, that many copies of each length are dealt evenly over its documents, those with one more
in the order of a seeded hash.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.llm._common import WORD, ranked, saved

WEIGHTS, SHARE, MOST = (3, 1, 2), 1.5, 2


def targets(sizes: dict[str | None, int], weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> dict[str | None, float]:
    """Words for each source: share of all words by weight (repeating, in the order of the names by code point, null last);
    what exceeds most times a source's size is dealt to the others again, until none exceeds it."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode("utf-32-be")) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    budget, out, free = share * sum(sizes.values()), {}, names
    while free:
        total = sum(weight[s] for s in free)
        over = [s for s in free if budget * weight[s] / total > most * sizes[s]]
        if not over:
            return {s: out[s] if s in out else budget * weight[s] / total for s in names}
        for s in over:
            out[s] = float(most * sizes[s])
            budget -= out[s]
        free = [s for s in free if s not in out]
    return out


def knapsack(lengths: list[int], counts: list[int], budget: int, over: int = 0) -> list[int]:
    """How many of each length to take, so that their sum is as near the budget as any subset's that exceeds it by over at
    most; for budgets of some hundred thousands. Bit s of a whole number says that sum s can be reached; counts are split
    into powers of two."""
    best, steps, most = 1, [], budget + over
    full = (1 << (most + 1)) - 1
    for k, (n, c) in enumerate(zip(lengths, counts)):
        part = 1
        while c > 0 and n <= most and not best >> budget & 1:
            part = min(part, c)
            if n * part <= most:
                steps.append((k, part, best))
                best |= best << (n * part) & full
            c -= part
            part *= 2
    below, above = (best & (1 << (budget + 1)) - 1).bit_length() - 1, best >> budget
    up = (above & -above).bit_length() - 1  # to the least sum from the budget on, -1 without one
    left, out = budget + up if above and up < budget - below else below, [0] * len(lengths)
    for k, part, before in reversed(steps):
        if not before >> left & 1:
            out[k] += part
            left -= part * lengths[k]
    return out


def plan(lengths: list[int], counts: list[int], budget: int) -> list[int]:
    """How many copies of each length to take, counts at most, for a total as near the budget as the knapsack finds on either
    side. lengths: above 0."""
    total = sum(n * c for n, c in zip(lengths, counts))
    if budget >= total:
        return list(counts)
    taken = [c * budget // total for c in counts]
    left = budget - sum(n * t for n, t in zip(lengths, taken))
    order = sorted(range(len(lengths)), key=lambda k: -lengths[k])
    longest = lengths[order[0]]
    for k in order:  # down to a remainder that the knapsack can make up, from the longest
        more = min(counts[k] - taken[k], max(0, left - 2 * longest) // lengths[k])
        taken[k] += more
        left -= more * lengths[k]
    rest = sorted(range(len(lengths)), key=lambda k: lengths[k])
    more = knapsack([lengths[k] for k in rest], [counts[k] - taken[k] for k in rest], left, longest)
    for k, m in zip(rest, more):
        taken[k] += m
    return taken


def mixed(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: int = MOST, seed: int = 17) -> DataFrame:
    """doc_id, source, size (words), source_size, target, copies and taken (words) of each row of docs.

    Null texts and texts without words have size 0 and are taken as often as the least (they cost nothing, so 0 is taken).
    A null source is one of its own, after all others. Repeated rows are mixed as rows of their own: which of them is taken
    doesn't matter. Long texts are counted whole. Only doc_id, text and source are read. Sources' totals, one row each, are
    the only rows the driver gets.
    """
    rows = docs.select("doc_id", "source", F.xxhash64("text").alias("_h"), F.coalesce(F.expr(f"regexp_count(text, '{WORD.replace(chr(92), chr(92) * 2)}')"), F.lit(0)).cast("long").alias("size"))
    rows, _ = ranked(rows.withColumn("_o", F.xxhash64(F.lit(seed), "doc_id", "_h")), ["source", "size", "_o", "doc_id", "_h"], "mix")
    spark = docs.sparkSession
    groups = saved(rows.groupBy("source", "size").agg(F.count("*").alias("n"), F.min("rank").alias("_from")), "lengths")
    sizes = {r["source"]: r["size"] for r in groups.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("size")).collect()}
    goal = targets(sizes, weights, share, most)
    schema = "source string, size long, n long, _from long, target double, source_size long, _every long, _more long"

    def planned(key, histogram: pd.DataFrame) -> pd.DataFrame:
        source = None if pd.isna(key[0]) else key[0]
        size, target = sizes[source], goal[source]
        real = histogram[histogram["size"] > 0].sort_values("size")
        taken = plan(real["size"].tolist(), (real["n"] * most).tolist(), round(target)) if len(real) else []
        copies = dict(zip(real["size"], taken))
        histogram = histogram.assign(target=target, source_size=size, _copies=[copies.get(s, 0) for s in histogram["size"]])
        return histogram.assign(_every=histogram["_copies"] // histogram["n"], _more=histogram["_copies"] % histogram["n"])[[x.split()[0] for x in schema.split(", ")]]

    plans = saved(groups.groupBy("source").applyInPandas(planned, schema), "plans").drop("n")
    rows, plans = rows.alias("r"), plans.alias("p")
    out = rows.join(plans, F.col("r.source").eqNullSafe(F.col("p.source")) & (F.col("r.size") == F.col("p.size")))
    copies = F.when(F.col("r.size") == 0, F.lit(0)).otherwise(F.col("_every") + F.when(F.col("rank") < F.col("_from") + F.col("_more"), 1).otherwise(0)).cast("int")
    return out.select("doc_id", "r.source", "r.size", "source_size", "target", copies.alias("copies"), (F.col("r.size") * copies).alias("taken"), F.col("_h").alias("text_hash"))


def apply(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: rows of docs with their columns, each as often as it is taken.

    Repeated rows (of one id, source and text) are taken together: the first of them by a hash of all columns stands for all,
    as often as all are taken.
    """
    taken = mixed(docs, **options).groupBy("doc_id", "source", "text_hash").agg(F.sum("copies").alias("_n"), F.count("*").alias("_rows")).filter("_n > 0")
    names = [f"_c{i}" for i in range(len(docs.columns))]
    own = {c: F.col(names[docs.columns.index(c)]) for c in ("doc_id", "source", "text")}
    rows, keys = docs.toDF(*names).withColumn("_h", F.xxhash64(own["text"])).alias("r"), taken.toDF("_d", "_s", "_t", "_n", "_rows").alias("t")
    rows = rows.join(keys, (F.col("_h") == F.col("_t")) & own["doc_id"].eqNullSafe(F.col("_d")) & own["source"].eqNullSafe(F.col("_s")))
    row = F.struct(*names, "_d", "_s", "_t", "_n", "_rows")
    several = rows.filter("_rows > 1").groupBy("_d", "_s", "_t").agg(F.min_by(row, F.struct(F.xxhash64(*names), F.to_json(F.struct(*names)))).alias("_r")).select("_r.*")
    single = rows.filter("_rows = 1").select(*names, "_d", "_s", "_t", "_n", "_rows")
    rows = single.unionAll(several).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_n").cast("int"))))
    return rows.select(*names).toDF(*docs.columns)


def digest(docs: DataFrame) -> DataFrame:
    return mixed(docs).select("doc_id", "size", "source_size", "target", "taken")
