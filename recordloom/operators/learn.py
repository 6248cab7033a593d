"""Folds, sub-worlds, and scorers: boosted trees trained out of fold, calibrated by isotonic regression."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordloom.operators.blocking import sides
from recordloom.operators.evaluate import SEED, seeded
from recordloom.operators.features import KEYS, house_relation, length_ratio, legal_conflict
from recordloom.functions.similarity import scorer, scorers
from recordloom.sources.artifacts import saved

MATCH_CAP = 5


def match_counts(s1: DataFrame, gt: DataFrame) -> DataFrame:
    n = gt.groupBy("s1_id").agg(F.count("*").alias("n_matches"))
    return s1.select("s1_id", "country").dropDuplicates(["s1_id"]).join(n, "s1_id", "left").withColumn("n_matches", F.coalesce("n_matches", F.lit(0)).cast("int"))


def numbered(rows: DataFrame, strata: list[str], order: list[str]) -> DataFrame:
    """rows with _i, 1 and up in each stratum by order, and _n, the stratum's rows.

    Rows are dealt by ranges of strata and order, so a large stratum is many tasks' work; each range numbers its own part of
    a stratum, and a table with a row for each range and stratum edge says where the part begins.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = saved(rows.repartitionByRange(n, *strata, *order).withColumn("_part", F.spark_partition_id()), "ranges")
    sizes = rows.groupBy("_part", *strata).agg(F.count("*").alias("_size"))
    before = Window.partitionBy(*strata).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumns({"_start": F.coalesce(F.sum("_size").over(before), F.lit(0)), "_n": F.sum("_size").over(Window.partitionBy(*strata))})
    starts = starts.select(*(F.col(c).alias(f"_of{c}") for c in ("_part", *strata)), "_start", "_n")  # fewer rows than ranges and strata together
    names = [c for c in rows.columns if c != "_part"]
    rows = rows.withColumn("_in", F.row_number().over(Window.partitionBy("_part", *strata).orderBy(*order)))
    same = reduce(Column.__and__, (F.col(c).eqNullSafe(F.col(f"_of{c}")) for c in ("_part", *strata)))
    return rows.join(F.broadcast(starts), same).select(*names, (F.col("_in") + F.col("_start")).alias("_i"), "_n")


def make_folds(s1: DataFrame, gt: DataFrame, n_folds: int = 5, seed: int = SEED) -> DataFrame:
    """s1_id, fold, country, n_matches: in each stratum (country, matches up to MATCH_CAP) dealt in turn, in a seeded order."""
    rows = match_counts(s1, gt).withColumns({"_stratum": F.least("n_matches", F.lit(MATCH_CAP)), "_order": seeded("s1_id", seed)})
    return numbered(rows, ["country", "_stratum"], ["_order", "s1_id"]).select("s1_id", ((F.col("_i") - 1) % n_folds).cast("int").alias("fold"), "country", "n_matches")


def sample_subworld(s1: DataFrame, gt: DataFrame, candidates: DataFrame, frac: float = 0.1, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """A closed part of the world, (entity_id, source, role), and its candidates: a share of each country's S1 records, all their
    matches, and the unmatched records whose first S1 record is one of them."""
    base = s1.select("s1_id", "country").dropDuplicates(["s1_id"]).withColumn("_order", seeded("s1_id", seed))
    chosen = numbered(base, ["country"], ["_order", "s1_id"]).filter(F.col("_i") <= F.greatest(F.bround(F.col("_n") * frac), F.lit(1))).select("s1_id")
    chosen = saved(chosen, "sampled")
    within = lambda df: df.join(chosen, "s1_id", "left_semi")
    firsts = within(candidates.filter("rank_in_cand = 1")).join(gt.select(F.col("match_id").alias("cand_id")), "cand_id", "left_anti")
    # an id of several roles has the first of them
    members = {"0s1": chosen.select("s1_id"), "1match": within(gt).select("match_id"), "2decoy": firsts.select("cand_id")}
    every = reduce(DataFrame.unionAll, (df.toDF("entity_id").withColumn("_r", F.lit(r)) for r, df in members.items()))
    world = every.groupBy("entity_id").agg(F.min("_r").alias("_r")).select("entity_id", F.substring("entity_id", 2, 1).cast("int").alias("source"), F.substr("_r", F.lit(2)).alias("role"))
    others = world.filter("role <> 's1'").select(F.col("entity_id").alias("cand_id"))
    return world, within(candidates).join(others, "cand_id", "left_semi")


def density_report(world: DataFrame, records: DataFrame) -> DataFrame:
    """country, records of sources 2 and 3 for each S1 record in full and in the world, and the world's roles."""
    ratio = lambda name: F.round(F.try_divide(F.count_if(F.col("source") > 1), F.count_if(F.col("source") == 1)), 9).alias(name)
    own = world.join(records.select("entity_id", "country"), "entity_id", "left")
    roles = [F.count_if(F.col("role") == r).alias(f"world_{n}") for r, n in (("s1", "s1"), ("match", "matches"), ("decoy", "decoys"))]
    return records.groupBy("country").agg(ratio("full_s23_per_s1")).join(own.groupBy("country").agg(ratio("world_s23_per_s1"), *roles), "country", "left")


def fallback_features(candidates: DataFrame, records: DataFrame) -> DataFrame:
    """KEYS and eight plain features."""
    rows = sides(candidates, records, ("name_core", "addr_street", "house_num", "legal_form"))
    rel, diff = house_relation("a_house_num", "b_house_num")
    rows = rows.withColumn("_name", scorers(["tset", "tsort"], "a_name_core", "b_name_core"))
    return rows.select(
        *KEYS, F.col("block_score").cast("double").alias("block_score"), F.col("_name.tset").alias("name_tset"), F.col("_name.tsort").alias("name_tsort"),
        scorer("tset")("a_addr_street", "b_addr_street").alias("street_tset"), (rel == "equal").cast("double").alias("hn_equal"), F.log1p(F.coalesce(diff, F.lit(0)).cast("double")).alias("hn_diff"),
        legal_conflict("a_legal_form", "b_legal_form").alias("legal_conflict"), F.coalesce(length_ratio("a_name_core", "b_name_core"), F.lit(0.0)).alias("name_len_ratio"),
    )


def labelled(features: DataFrame, gt: DataFrame, folds: DataFrame) -> DataFrame:
    truth = gt.select("s1_id", F.col("match_id").alias("cand_id"), F.lit(1.0).alias("label")).distinct()
    return features.join(truth, KEYS, "left").withColumn("label", F.coalesce("label", F.lit(0.0))).join(folds.select("s1_id", "fold"), "s1_id")


def _assembler(names: list[str]):
    from pyspark.ml.feature import VectorAssembler

    return VectorAssembler(inputCols=names, outputCol="_x", handleInvalid="keep")


def _numbers(rows: DataFrame, names: list[str]) -> DataFrame:
    """Trees here know no missing values: they become -1, below all features."""
    return rows.withColumns({c: F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(-1.0)), F.lit(-1.0)) for c in names})


def fit(train: DataFrame, names: list[str], seed: int = SEED, rounds: int = 20, depth: int = 4):
    """A boosted-tree pipeline model on label. A tenth of S1 records, in a seeded order, stops it early."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import GBTClassifier

    rows = train.withColumn("_valid", F.conv(F.substring(seeded("s1_id", seed), 1, 4), 16, 10).cast("int") % 10 == 0)
    trees = GBTClassifier(featuresCol="_x", labelCol="label", maxIter=rounds, maxDepth=depth, stepSize=0.1, seed=seed, validationIndicatorCol="_valid", validationTol=1e-4)
    return Pipeline(stages=[_assembler(names), trees]).fit(_numbers(rows, names))


def scored(model, rows: DataFrame, names: list[str]) -> DataFrame:
    from pyspark.ml.functions import vector_to_array

    out = model.transform(_numbers(rows, names)).withColumn("raw", vector_to_array("probability")[1])
    return out.drop("_x", "rawPrediction", "probability", "prediction")


def cross_fit_isotonic(oof: DataFrame, folds: list[int]) -> DataFrame:
    """p: raw mapped, for each fold, by an isotonic regression on the others; within 0 and 1."""
    from pyspark.ml.regression import IsotonicRegression

    rows = oof.withColumn("raw", F.col("raw").cast("double"))
    out = None
    for k in folds:
        others, own = rows.filter(F.col("fold") != k), rows.filter(F.col("fold") == k)
        own = IsotonicRegression(featuresCol="raw", labelCol="label", predictionCol="p").fit(others).transform(own)
        out = own if out is None else out.unionByName(own)
    return out.withColumn("p", F.least(F.greatest("p", F.lit(0.0)), F.lit(1.0)))


def train_oof(features: DataFrame, gt: DataFrame, folds: DataFrame, n_folds: int = 5, seed: int = SEED, rounds: int = 20, max_train_s1: int = 300_000) -> tuple[DataFrame, object]:
    """Scores (s1_id, cand_id, fold, label, raw, p) of models that never saw the fold, and a model of all rows. Each model sees
    max_train_s1 S1 records at most, those first in a seeded order."""
    rows = saved(labelled(features, gt, folds), "training")
    names = [c for c in features.columns if c not in (*KEYS, "country")]

    def bounded(part: DataFrame) -> DataFrame:
        chosen = part.select("s1_id").distinct().orderBy(seeded("s1_id", seed), "s1_id").limit(max_train_s1)
        return part.join(chosen, "s1_id", "left_semi")

    out = None
    for k in range(n_folds):
        model = fit(bounded(rows.filter(F.col("fold") != k)), names, seed, rounds)
        part = scored(model, rows.filter(F.col("fold") == k), names).select(*KEYS, "fold", "label", "raw")
        out = part if out is None else out.unionByName(part)
    out = saved(out, "oof")
    return cross_fit_isotonic(out, list(range(n_folds))), fit(bounded(rows), names, seed, rounds)


def importance(model, names: list[str]) -> list[tuple[str, float]]:
    """Features by gain."""
    return sorted(zip(names, model.stages[-1].featureImportances.toArray().tolist()), key=lambda x: (-x[1], x[0]))


def report(oof: DataFrame) -> DataFrame:
    """mean_p, brier, auc (the share of pairs of a true and a false row that are in order; ties count half)."""
    counts = oof.groupBy("p").agg(F.sum("label").alias("_t"), F.count("*").alias("_n"))
    rows = counts.withColumn("_below", F.sum(F.col("_n") - F.col("_t")).over(Window.orderBy("p")) - (F.col("_n") - F.col("_t")))  # a row for each level of an isotonic step function
    auc = rows.agg((F.sum(F.col("_t") * (F.col("_below") + (F.col("_n") - F.col("_t")) / 2)) / (F.sum("_t") * F.sum(F.col("_n") - F.col("_t")))).alias("auc"))
    return oof.agg(F.avg("p").alias("mean_p"), F.avg((F.col("p") - F.col("label")) ** 2).alias("brier")).join(F.broadcast(auc))
