"""Scores of matches and of blocking: macro F0.5, recall, coverage, reduction, error classes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordloom.operators.features import house_relation

KINDS = ("TP", "FP", "FN_blocking", "FN_model")
#: Digits of the seeded order of samples.
SEED = 42


def seeded(column: str, seed: int = SEED) -> Column:
    """An order that looks random and that other engines reproduce."""
    return F.md5(F.concat(F.col(column), F.lit(f"|{seed}")))


def gt_long(wide: DataFrame) -> DataFrame:
    """s1_id, match_id from source1_entity_id and a comma list of matches; blanks around ids and empty ids go."""
    each = wide.select(F.col("source1_entity_id").alias("s1_id"), F.explode(F.split("matched_entity_ids", ",")).alias("match_id"))
    return each.withColumn("match_id", F.btrim("match_id")).filter("match_id <> ''")


def pairs_of(df: DataFrame) -> DataFrame:
    second = "cand_id" if "cand_id" in df.columns else "match_id"
    return df.select(F.col("s1_id").cast("string").alias("s1_id"), F.col(second).cast("string").alias("cand_id")).distinct()


def per_entity_f05(pred: DataFrame, gt: DataFrame, s1: DataFrame) -> DataFrame:
    """s1's rows with n_pred, n_gt, tp, f05. Both empty: 1; one empty or nothing hit: 0. Repeated pairs and S1 ids count once
    (of an id with several rows, the least of its other columns)."""
    p, t = pairs_of(pred), pairs_of(gt)
    both = p.withColumn("_p", F.lit(1)).join(t.withColumn("_t", F.lit(1)), ["s1_id", "cand_id"], "full")
    counts = both.groupBy("s1_id").agg(F.count("_p").alias("n_pred"), F.count("_t").alias("n_gt"), F.count(F.when(F.col("_p").isNotNull() & F.col("_t").isNotNull(), 1)).alias("tp"))
    others = [c for c in s1.columns if c != "s1_id"]
    once = s1.groupBy("s1_id").agg(F.min(F.struct(*others)).alias("_s")).select("s1_id", "_s.*") if others else s1.distinct()
    rows = once.join(counts, "s1_id", "left").na.fill(0, ["n_pred", "n_gt", "tp"])
    precision, recall = F.try_divide(F.col("tp"), F.col("n_pred")), F.try_divide(F.col("tp"), F.col("n_gt"))
    f05 = F.when((F.col("n_pred") == 0) & (F.col("n_gt") == 0), F.lit(1.0)).when(F.col("tp") == 0, F.lit(0.0)).otherwise(1.25 * precision * recall / (0.25 * precision + recall))
    return rows.withColumn("f05", f05)


def macro_f05(pred: DataFrame, gt: DataFrame, s1: DataFrame) -> DataFrame:
    return per_entity_f05(pred, gt, s1).agg(F.round(F.avg("f05"), 9).alias("macro_f05"), F.count("*").alias("n_s1"))


def macro_f05_by(pred: DataFrame, gt: DataFrame, s1: DataFrame, *by: str) -> DataFrame:
    rows = per_entity_f05(pred, gt, s1)
    return rows.groupBy(*by).agg(F.round(F.avg("f05"), 9).alias("macro_f05"), F.count("*").alias("n_s1"), F.round(F.avg((F.col("n_gt") == 0).cast("double")), 9).alias("singleton_share"))


def s1_groups(records: DataFrame, gt: DataFrame) -> DataFrame:
    """s1_id, country, script: "native" if a match has a non-Latin name, "latin" if all are Latin, "singleton" without matches."""
    matched = pairs_of(gt).groupBy("s1_id").agg(F.lit("latin").alias("_any"))
    foreign = records.filter(F.col("name_script") != "Latin").select(F.col("entity_id").alias("cand_id"))
    native = pairs_of(gt).join(foreign, "cand_id", "left_semi").select("s1_id", F.lit("native").alias("_native")).distinct()
    rows = records.filter("source = 1").select(F.col("entity_id").alias("s1_id"), "country").join(native, "s1_id", "left").join(matched, "s1_id", "left")
    return rows.select("s1_id", "country", F.coalesce("_native", "_any", F.lit("singleton")).alias("script"))


def found(candidates: DataFrame, gt: DataFrame) -> DataFrame:
    truth = gt.select("s1_id", "match_id").distinct()
    own = candidates.select("s1_id", F.col("cand_id").alias("match_id"), "block_mask")
    rows = truth.join(own, ["s1_id", "match_id"], "left")
    return rows.withColumns({"found": F.col("block_mask").isNotNull(), "block_mask": F.coalesce("block_mask", F.lit(0))})


def nearest(counts: DataFrame, q: float, name: str) -> DataFrame:
    """country (null: all) and the value at index round((n - 1) * q), half up, of n_cand, from counts of values: no list of rows is made."""
    order = Window.partitionBy("country").orderBy("n_cand")
    rows = counts.withColumns({"_upto": F.sum("n").over(order), "_n": F.sum("n").over(Window.partitionBy("country"))})
    return rows.filter(F.col("_upto") > F.floor((F.col("_n") - 1) * q + 0.5)).groupBy("country").agg(F.min("n_cand").cast("double").alias(name))


def blocking_summary(candidates: DataFrame, gt: DataFrame, records: DataFrame) -> DataFrame:
    """Each country and "ALL": S1 records, pairs, candidates for each (mean and nearest quantiles), recall, share of S1 records
    with all matches found, and the share of possible pairs that never were formed."""
    s1 = records.filter("source = 1").select(F.col("entity_id").alias("s1_id"), "country")
    own = s1.join(candidates.groupBy("s1_id").agg(F.count("*").alias("n_cand")), "s1_id", "left").na.fill(0, ["n_cand"])
    hit = found(candidates, gt).join(s1, "s1_id", "left")
    cover = hit.groupBy("s1_id", "country").agg(F.bool_and("found").alias("_all"))
    pool = records.groupBy("country").agg((F.count_if(F.col("source") == 1) * F.count_if(F.col("source") > 1)).alias("space"))
    both = lambda df: df.unionByName(df.withColumn("country", F.lit("ALL")))
    counts = both(own).groupBy("country", "n_cand").agg(F.count("*").alias("n"))
    out = both(own).groupBy("country").agg(F.count("*").alias("n_s1"), F.sum("n_cand").alias("pairs"), F.round(F.avg("n_cand"), 9).alias("cand_mean"))
    out = out.join(nearest(counts, 0.5, "cand_p50"), "country").join(nearest(counts, 0.95, "cand_p95"), "country")
    out = out.join(both(hit).groupBy("country").agg(F.count("*").alias("gt_pairs"), F.round(F.avg(F.col("found").cast("double")), 9).alias("pair_recall")), "country", "left")
    out = out.join(both(cover).groupBy("country").agg(F.round(F.avg(F.col("_all").cast("double")), 9).alias("full_gt_covered")), "country", "left")
    out = out.join(both(pool).groupBy("country").agg(F.sum("space").alias("space")), "country", "left")
    return out.withColumn("reduction_ratio", F.round(1 - F.try_divide(F.col("pairs"), F.col("space")), 9)).drop("space")


def blocking_by_script(candidates: DataFrame, gt: DataFrame, records: DataFrame) -> DataFrame:
    own = records.select(F.col("entity_id").alias("match_id"), "country", "name_script")
    return found(candidates, gt).join(own, "match_id", "left").groupBy("country", "name_script").agg(F.count("*").alias("gt_pairs"), F.round(F.avg(F.col("found").cast("double")), 9).alias("pair_recall"))


def blocking_by_pass(candidates: DataFrame, gt: DataFrame, names: dict[int, str]) -> DataFrame:
    """For each pass that occurs: its pairs, its recall, and the recall that only it gives."""
    bits = F.explode(F.array(*(F.struct(F.lit(b).alias("bit"), F.lit(n).alias("pass")) for b, n in names.items())))
    own = candidates.select("block_mask", bits.alias("x")).filter(F.expr("(block_mask & shiftleft(1, x.bit)) <> 0")).groupBy("x.bit", "x.pass").agg(F.count("*").alias("pairs"))
    hits = found(candidates, gt).filter("found").select("block_mask", bits.alias("x")).filter(F.expr("(block_mask & shiftleft(1, x.bit)) <> 0"))
    hits = hits.groupBy("x.bit").agg(F.count("*").alias("_h"), F.count(F.when(F.expr("block_mask = shiftleft(1, x.bit)"), 1)).alias("_u"))
    n = gt.select("s1_id", "match_id").distinct().agg(F.greatest(F.count("*"), F.lit(1)).alias("_n"))
    out = own.join(hits, "bit", "left").join(F.broadcast(n))  # one row
    return out.select("bit", "pass", "pairs", F.round(F.coalesce("_h", F.lit(0)) / F.col("_n"), 9).alias("recall"), F.round(F.coalesce("_u", F.lit(0)) / F.col("_n"), 9).alias("unique_recall"))


def recall_at(ranked: DataFrame, gt: DataFrame, ks: tuple[int, ...] = (1, 2, 3, 5)) -> DataFrame:
    """k, recall: the share of true pairs among the first k of each candidate, from one ranked frame."""
    truth = gt.select("s1_id", F.col("match_id").alias("cand_id")).distinct()
    rows = truth.join(ranked.select("s1_id", "cand_id", "rank_in_cand"), ["s1_id", "cand_id"], "left")
    each = F.array(*(F.struct(F.lit(k).alias("k"), F.round(F.avg((F.coalesce("rank_in_cand", F.lit(1 << 30)) <= k).cast("double")), 9).alias("recall")) for k in ks))
    return rows.agg(each.alias("x")).select(F.explode("x").alias("x")).select("x.*")


def decoy_load(kept: DataFrame, gt: DataFrame, records: DataFrame) -> DataFrame:
    """country, unmatched records, and the S1 records that each of them keeps on average."""
    lone = records.filter("source <> 1").select(F.col("entity_id").alias("cand_id"), "country").join(gt.select(F.col("match_id").alias("cand_id")), "cand_id", "left_anti")
    n = lone.join(kept.groupBy("cand_id").agg(F.count("*").alias("_n")), "cand_id", "left").na.fill(0, ["_n"])
    return n.groupBy("country").agg(F.count("*").alias("unmatched"), F.round(F.avg("_n"), 9).alias("s1_kept"))


def missed_pairs(candidates: DataFrame, uncapped: DataFrame, gt: DataFrame) -> DataFrame:
    """True pairs that candidates lack: "ranked out" if they were retrieved before the caps, else "not retrieved"."""
    lost = found(candidates, gt).filter(~F.col("found")).select("s1_id", "match_id")
    seen = uncapped.select("s1_id", F.col("cand_id").alias("match_id"), F.lit(True).alias("_s")).distinct()
    return lost.join(seen, ["s1_id", "match_id"], "left").select("s1_id", "match_id", F.when(F.col("_s"), "ranked out").otherwise("not retrieved").alias("reason"))


def classify(matches: DataFrame, scores: DataFrame, candidates: DataFrame, gt: DataFrame) -> DataFrame:
    """Every predicted or true pair: kind (TP, FP, FN_blocking, FN_model), p, the candidate's true owner and its assigned S1 record.
    Of several owners the least id counts."""
    pred, truth = pairs_of(matches), pairs_of(gt)
    rows = pred.withColumn("_p", F.lit(True)).join(truth.withColumn("_t", F.lit(True)), ["s1_id", "cand_id"], "full")
    rows = rows.join(pairs_of(candidates).withColumn("_c", F.lit(True)), ["s1_id", "cand_id"], "left").join(scores.select("s1_id", "cand_id", "p"), ["s1_id", "cand_id"], "left")
    rows = rows.join(truth.groupBy("cand_id").agg(F.min("s1_id").alias("gt_owner")), "cand_id", "left").join(pred.groupBy("cand_id").agg(F.min("s1_id").alias("assigned_to")), "cand_id", "left")
    kind = F.when(F.col("_p") & F.col("_t"), "TP").when(F.col("_p"), "FP").when(F.col("_c").isNull(), "FN_blocking").otherwise("FN_model")
    return rows.select("s1_id", "cand_id", "p", "gt_owner", "assigned_to", kind.alias("kind"))


def enrich(rows: DataFrame, records: DataFrame, gt: DataFrame) -> DataFrame:
    """Adds both records' raw strings, country, script, the relation of house numbers, and the S1 record's number of matches (4+ at most)."""
    one = records.select(F.col("entity_id").alias("s1_id"), F.col("name_raw").alias("s1_name"), F.col("addr_raw").alias("s1_addr"), "country", F.col("house_num").alias("_a"))
    other = records.select(F.col("entity_id").alias("cand_id"), F.col("name_raw").alias("cand_name"), F.col("addr_raw").alias("cand_addr"), "name_script", F.col("house_num").alias("_b"))
    n = pairs_of(gt).groupBy("s1_id").agg(F.count("*").alias("_n"))
    rel, diff = house_relation("_a", "_b")
    n_gt = F.coalesce("_n", F.lit(0))
    rows = rows.join(one, "s1_id", "left").join(other, "cand_id", "left").join(n, "s1_id", "left")
    return rows.withColumns({"hn_rel": rel, "hn_diff": diff, "s1_bucket": F.when(n_gt >= 4, F.lit("4+")).otherwise(n_gt.cast("string"))}).drop("_a", "_b", "_n")


def error_summary(enriched: DataFrame, by: str) -> DataFrame:
    out = enriched.groupBy(by).agg(*(F.count_if(F.col("kind") == k).alias(k) for k in KINDS))
    return out.withColumn("FN", F.col("FN_blocking") + F.col("FN_model"))


def error_worst(enriched: DataFrame, n: int = 50, seed: int = SEED) -> dict[str, DataFrame]:
    """The n false positives of the greatest p, and n false negatives: blocking misses (seeded order) and model misses (least p)
    by their shares."""
    columns = ["s1_id", "cand_id", "country", "name_script", "p", "hn_rel", "hn_diff", "s1_name", "cand_name", "s1_addr", "cand_addr"]
    blocked, missed = (enriched.filter(F.col("kind") == k) for k in ("FN_blocking", "FN_model"))
    a, b = blocked.count(), missed.count()
    n_a = min(a, round(n * a / max(a + b, 1)))
    mixed = F.md5(F.concat_ws("|", "s1_id", "cand_id", F.lit(str(seed))))
    return {
        "false positives": enriched.filter("kind = 'FP'").orderBy(F.col("p").desc_nulls_last(), "s1_id", "cand_id").limit(n).select(*columns, "gt_owner"),
        "blocking misses": blocked.orderBy(mixed, "s1_id", "cand_id").limit(n_a).select(*columns, "assigned_to"),
        "model misses": missed.orderBy(F.col("p").asc_nulls_last(), "s1_id", "cand_id").limit(n - n_a).select(*columns, "assigned_to"),
    }
