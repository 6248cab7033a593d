"""The record-linkage run as a chain of stages, each from Parquet to Parquet: python -m recordloom.plans.pipeline STAGE|all."""

from __future__ import annotations

import argparse
import logging
import time
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.operators import blocking, decide, evaluate, features, learn, normalize
from recordloom.plans.config import Config, load
from recordloom.sources import tsv
from recordloom.sources.artifacts import Artifacts

log = logging.getLogger("recordloom")
CHAIN = {
    ("train", "model"): ("ingest", "normalize", "block", "blocking_report", "folds", "featurize", "train", "decide", "errors"),
    ("train", "fallback"): ("ingest", "normalize", "block", "blocking_report", "folds", "fallback_train", "decide", "errors"),
    ("test", "model"): ("ingest", "normalize", "block", "featurize", "predict", "decide", "submit"),
    ("test", "fallback"): ("ingest", "normalize", "block", "fallback_predict", "decide", "submit"),
}


class Run:
    """What a stage works with: settings, artifacts, the split."""

    def __init__(self, spark: SparkSession, config: Config, split: str, subworld: bool = False):
        self.spark, self.config, self.split = spark, config, split
        self.store = Artifacts(spark, config.get("paths.artifacts"), subworld)

    def read(self, name: str, split: str | None = None) -> DataFrame:
        return self.store.read(name, split or self.split)

    def write(self, df: DataFrame, name: str, by: str | None = None) -> DataFrame:
        return self.store.write(df, name, self.split, by)

    def s1(self) -> DataFrame:
        return self.read("records").filter("source = 1").select(F.col("entity_id").alias("s1_id"), "country")

    def train_only(self) -> None:
        if self.split != "train":
            raise ValueError("this stage needs the true pairs: only for train")

    def limits(self) -> blocking.Limits:
        own = dict(self.config.get("block"))
        return blocking.Limits(**own)

    def model_path(self, name: str) -> str:
        return f"{self.config.get('paths.artifacts')}/model_{name}{'_sw' if self.store.subworld else ''}"


STAGES: dict[str, Callable[[Run], None]] = {}


def stage(f: Callable[[Run], None]) -> Callable[[Run], None]:
    STAGES[f.__name__] = f
    return f


@stage
def ingest(run: Run) -> None:
    records, gt = tsv.ingest(run.spark, run.config.get("paths.raw"), run.split)
    run.write(records, "raw")
    if gt is not None:
        run.write(gt, "gt")


@stage
def normalize_(run: Run) -> None:
    run.write(normalize.build_records(run.read("raw").drop("position")), "records", by="country")


STAGES["normalize"] = STAGES.pop("normalize_")


@stage
def block(run: Run) -> None:
    run.write(blocking.candidates(run.read("records"), run.limits()), "candidates")


@stage
def blocking_report(run: Run) -> None:
    run.train_only()
    c, gt, r = run.read("candidates"), run.read("gt"), run.read("records")
    for name, df in (("summary", evaluate.blocking_summary(c, gt, r)), ("by_script", evaluate.blocking_by_script(c, gt, r)), ("by_pass", evaluate.blocking_by_pass(c, gt, blocking.PASS_NAMES))):
        run.write(df, f"blocking_{name}")


@stage
def folds(run: Run) -> None:
    run.train_only()
    run.write(learn.make_folds(run.s1(), run.read("gt"), run.config.get("folds.n"), run.config.get("folds.seed")), "folds")


@stage
def subworld(run: Run) -> None:
    """Writes a closed sub-world's raw records, pairs and candidates as artifacts of their own."""
    run.train_only()
    world, cands = learn.sample_subworld(run.s1(), run.read("gt"), run.read("candidates"), run.config.get("subworld.frac"))
    small = Artifacts(run.spark, run.config.get("paths.artifacts"), True)
    world = small.write(world, "world", run.split)
    small.write(cands, "candidates", run.split)
    small.write(run.read("records").join(world.select("entity_id"), "entity_id", "left_semi"), "records", run.split)
    small.write(run.read("gt").join(world.select(F.col("entity_id").alias("s1_id")), "s1_id", "left_semi"), "gt", run.split)


@stage
def featurize(run: Run) -> None:
    full = Artifacts(run.spark, run.config.get("paths.artifacts"))
    run.write(features.build_features(run.read("candidates"), run.read("records"), full.read("records", run.split)), "features")


def _train(run: Run, feats: DataFrame, name: str) -> None:
    run.train_only()
    oof, model = learn.train_oof(feats, run.read("gt"), run.read("folds"), run.config.get("folds.n"), run.config.get("model.seed"), run.config.get("model.rounds"))
    oof = run.write(oof, name)
    names = [c for c in feats.columns if c not in (*features.KEYS, "country")]
    model.write().overwrite().save(run.model_path(name))
    from pyspark.ml.regression import IsotonicRegression

    IsotonicRegression(featuresCol="raw", labelCol="label", predictionCol="p").fit(oof.drop("p")).write().overwrite().save(run.model_path(f"{name}_isotonic"))
    run.write(run.spark.createDataFrame(learn.importance(model, names), "feature string, gain double"), f"{name}_importance")
    log.info("%s: %s", name, learn.report(oof).first())


def _predict(run: Run, feats: DataFrame, name: str) -> None:
    from pyspark.ml import PipelineModel
    from pyspark.ml.regression import IsotonicRegressionModel

    names = [c for c in feats.columns if c not in (*features.KEYS, "country")]
    rows = learn.scored(PipelineModel.load(run.model_path(name)), feats, names)
    run.write(IsotonicRegressionModel.load(run.model_path(f"{name}_isotonic")).transform(rows).select(*features.KEYS, "p"), name)


@stage
def train(run: Run) -> None:
    _train(run, run.read("features"), "scores")


@stage
def predict(run: Run) -> None:
    _predict(run, run.read("features"), "scores")


@stage
def fallback_train(run: Run) -> None:
    _train(run, learn.fallback_features(run.read("candidates"), run.read("records")), "scores_fallback")


@stage
def fallback_predict(run: Run) -> None:
    _predict(run, learn.fallback_features(run.read("candidates"), run.read("records")), "scores_fallback")


def _decide_options(run: Run) -> dict:
    return {k: run.config.get(f"decide.{k}") for k in ("method", "threshold", "topk", "miss_mass", "margin")}


@stage
def decide_(run: Run) -> None:
    assigned = decide.assign_one_to_one(run.read(run.config.get("decide.scores_name")), run.read("candidates"))
    matches = run.write(decide.select(assigned.select("s1_id", "cand_id", "p"), **_decide_options(run)), "matches")
    if run.split == "train":
        log.info("macro F0.5: %s", evaluate.macro_f05(matches, run.read("gt"), run.s1()).first())


STAGES["decide"] = STAGES.pop("decide_")


@stage
def compare_decide(run: Run) -> None:
    run.train_only()
    groups = evaluate.s1_groups(run.read("records"), run.read("gt"))
    options = _decide_options(run)
    del options["method"]
    known = {}
    for name in ("scores", "scores_fallback"):
        try:
            known[name] = run.read(name)
        except FileNotFoundError:
            log.info("compare_decide: no %s", name)
    if not known:
        raise FileNotFoundError("no scores: run train or fallback_train first")
    run.write(decide.compare(known, {m: options for m in decide.METHODS}, run.read("gt"), groups, run.read("candidates")), "compare")


@stage
def errors(run: Run) -> None:
    run.train_only()
    gt, records = run.read("gt"), run.read("records")
    rows = evaluate.enrich(evaluate.classify(run.read("matches"), run.read(run.config.get("decide.scores_name")), run.read("candidates"), gt), records, gt)
    rows = run.write(rows, "errors")
    parts = [f"## by {by}\n\n{tsv.markdown(evaluate.error_summary(rows, by).orderBy(by))}" for by in ("country", "name_script", "s1_bucket")]
    parts += [f"## {name}\n\n{tsv.markdown(df)}" for name, df in evaluate.error_worst(rows).items()]
    out = Path(run.config.get("paths.out"))
    out.mkdir(parents=True, exist_ok=True)
    (out / f"errors_{run.split}.md").write_text("# Errors\n\n" + "\n\n".join(parts) + "\n")


@stage
def submit(run: Run) -> None:
    _write(run, run.read("matches"), run.read("candidates"))


@stage
def empty_submission(run: Run) -> None:
    """A submission without a pair, which shows what records without matches are worth."""
    none = run.spark.createDataFrame([], "s1_id string, cand_id string")
    _write(run, none, none)


def _write(run: Run, matches: DataFrame, candidates: DataFrame) -> None:
    out = Path(run.config.get("paths.out"))
    out.mkdir(parents=True, exist_ok=True)
    raw = run.read("raw")
    ids = raw.filter("source = 1").select(F.col("entity_id").alias("s1_id"), "position")
    valid = raw.filter("source <> 1").select(F.col("entity_id").alias("cand_id"))
    log.info("written: %s", tsv.write_submission(matches, candidates, ids, valid, str(out)))
    if script := run.config.get("paths.validator", None):
        tsv.validate(script, str(out), run.config.get("paths.raw"))


def run(name: str, on: Run) -> None:
    if name not in STAGES:
        raise ValueError(f"no stage {name!r}; there are {', '.join(STAGES)}")
    began = time.time()
    STAGES[name](on)
    log.info("%s %s: %.1f s, settings %s", name, on.split, time.time() - began, on.config.hash)


def main(args: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("stage")
    p.add_argument("--split", default="train", choices=("train", "test"))
    p.add_argument("--scorer", default="model", choices=("model", "fallback"))
    p.add_argument("--config")
    p.add_argument("--set", action="append", default=[])
    p.add_argument("--subworld", action="store_true")
    a = p.parse_args(args)
    logging.basicConfig(level=logging.INFO)
    sets = ["decide.scores_name=scores_fallback"] * (a.scorer == "fallback") + a.set
    spark = SparkSession.builder.appName("recordloom").getOrCreate()
    on = Run(spark, load(a.config, sets), a.split, a.subworld)
    for name in CHAIN[a.split, a.scorer] if a.stage == "all" else (a.stage,):
        run(name, on)


if __name__ == "__main__":
    main()
