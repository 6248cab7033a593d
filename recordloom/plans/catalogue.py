"""The named queries over the driver's tables. Those that SQL can express have their SQL in oracle.py."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.functions import text
from recordloom.functions.similarity import scorer, scorers
from recordloom.operators import blocking as B
from recordloom.operators import decide as D
from recordloom.operators import evaluate as E
from recordloom.operators import features as X
from recordloom.operators import learn as L
from recordloom.operators import normalize as N
from recordloom.operators import profile as P
from recordloom.plans import world as W
from recordloom.plans.oracle import ORACLE_SQL
from recordloom.sources import tsv

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
GRID = D.threshold_grid(0.05, 0.95, 0.05)


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


# text and records


@query
def script_detect(s, d):
    return W.table(s, d, "conversations").select("conv_id", "turn", text.script(F.col("text")).alias("script"))


@query
def accent_fold(s, d):
    return W.table(s, d, "conversations").select("conv_id", "turn", text.fold_accents(F.col("text")).alias("folded"))


@query
def base_normalize(s, d):
    return W.raw_records(s, d).select("entity_id", text.base(F.col("name_raw")).alias("name_base"))


@query
def name_skeleton(s, d):
    return W.raw_records(s, d).select("entity_id", text.skeleton(text.base(F.col("name_raw"))).alias("skeleton"))


@query
def strip_handle(s, d):
    host = F.regexp_extract("url", "^[a-z]+://([^/]+)", 1)
    return W.table(s, d, "pages").select("page_id", text.strip_handle(host).alias("words"), text.is_handle(host).alias("handle"), text.handle_words(host).alias("cleaned"))


@query
def legal_form(s, d):
    return W.records(s, d).select("entity_id", "name_norm", "name_core", "legal_form")


@query
def house_number(s, d):
    return W.records(s, d).select("entity_id", "house_num")


@query
def addr_nums(s, d):
    return W.records(s, d).select("entity_id", F.array_join("addr_nums", ",").alias("addr_nums"))


@query
def area_tokens(s, d):
    return N.area_tokens(N.with_addresses(W.raw_records(s, d)))


@query
def area_token_removal(s, d):
    return W.records(s, d).select("entity_id", "addr_norm", "addr_street")


# blocking


@query
def token_df(s, d):
    return B.token_df(W.records(s, d), "name_core")


@query
def token_idf(s, d):
    return B.token_idf(W.records(s, d), "name_core").select("country", "token", F.round("idf", 9).alias("idf"))


@query
def name_freq(s, d):
    return X.name_frequency(W.records(s, d))


@query
def rarest_tokens(s, d):
    r = W.records(s, d)
    return B.rarest(r, text.words(F.col("name_core")), B.token_idf(r, "name_core"), 3, 2000).select("entity_id", "pos", "token", F.round("weight", 9).alias("weight"))


@query
def pair_keys(s, d):
    r = W.records(s, d)
    top = B.rarest(r, text.words(F.col("name_core")), B.token_idf(r, "name_core"), 3, None)
    return B.pair_keys(top, 20).select("entity_id", F.replace("key", F.lit("\x01"), F.lit("|")).alias("key"), F.round("weight", 9).alias("weight"))


def _pass(bit: int):
    return lambda s, d: B.Index(W.records(s, d)).run(bit)


for _name, _bit in (("block_name", B.NAME), ("block_address", B.ADDRESS), ("block_house", B.HOUSE), ("block_combo", B.COMBO)):
    QUERIES[_name] = _pass(_bit)


@query
def block_fuzzy(s, d):
    return B.Index(W.records(s, d)).run(B.FUZZY).select("country", "cand_id", "s1_id", F.round("score", 6).alias("score"))


@query
def merge_passes(s, d):
    return W.merged(s, d)


@query
def rank_per_cand(s, d):
    return W.ranked(s, d).select("s1_id", "cand_id", "rank_in_cand")


@query
def cap_per_s1(s, d):
    return B.cap_per_s1(W.ranked(s, d), 3).select("s1_id", "cand_id")


@query
def rank_score(s, d):
    return B.rank_scores(W.merged(s, d), W.records(s, d)).select("s1_id", "cand_id", "rank_score")


@query
def candidates(s, d):
    return B.candidates(W.records(s, d))


@query
def candidates_fuzzy(s, d):
    return B.candidates(W.records(s, d), B.Limits(fuzzy=True, pair_keys=True))


# features


def _sides(s, d):
    return X.joined(W.pairs(s, d), W.records(s, d))


@query
def feat_context(s, d):
    c = X.context(W.pairs(s, d)).drop("tfidf_name", "tfidf_full")
    return c.withColumns({k: F.round(k, 9) for k in ("gap_other_s1", "gap_to_s1_best")})


@query
def idf_stats(s, d):
    r = W.records(s, d)
    rows = _sides(s, d)
    return X.idf_stats(rows, {"x": X.tokens("a_name_core")}, X.idf_of(r, "name_core")).select(*X.KEYS, "x_sum", F.round("x_min", 9).alias("x_min"), "x_mean")


@query
def feat_token_diff(s, d):
    r = W.records(s, d)
    return X.token_difference(_sides(s, d), "a_name_core", "b_name_core", "name", X.idf_of(r, "name_core")).select(*X.KEYS, *(f"name_{c}" for c in ("only_a", "only_b", "extra_idf_a", "extra_idf_b", "one_extra")))


@query
def feat_house_relation(s, d):
    rel, diff, share = X.house_class("a_house_num", "b_house_num")
    return _sides(s, d).select(*X.KEYS, X.code(rel, X.HOUSE_CLASSES).alias("hn_rel"), rel.isin(*X.HOUSE_CONFLICTS).cast("int").alias("hn_conflict"), diff.alias("hn_diff"), F.round(share, 9).alias("hn_rel_diff"))


@query
def feat_legal_relation(s, d):
    return _sides(s, d).select(*X.KEYS, X.code(X.legal_relation("a_legal_form", "b_legal_form"), X.LEGAL_CLASSES).alias("legal_rel"))


@query
def feat_length_script(s, d):
    rows = X.lengths_and_scripts(_sides(s, d))
    return rows.select(*X.KEYS, "s1_script", "cand_script", "same_script", "is_s3", *(F.round(c, 9).alias(c) for c in ("name_len_ratio", "street_len_ratio")))


@query
def feat_rarity(s, d):
    r = W.records(s, d)
    rows = X.rarity(_sides(s, d), X.idf_of(r, "name_core"), X.name_frequency(r))
    return rows.select(*X.KEYS, F.round("shared_idf_min", 9).alias("shared_idf_min"), "shared_idf_mean", *(F.round(c, 9).alias(c) for c in ("a_name_freq_log", "b_name_freq_log")))


@query
def feat_structured(s, d):
    r = W.records(s, d)
    rows = X.structured(_sides(s, d), X.idf_of(r, "name_core"), X.idf_of(r, "addr_street"))
    return rows.select(*X.KEYS, *(f"street_{c}" for c in ("only_a", "only_b", "extra_idf_a", "extra_idf_b", "one_extra")), "street_missing", "hn_rel", "hn_conflict", F.round("hn_abs_diff_log", 9).alias("hn_abs_diff_log"), "legal_rel")


@query
def feat_skeleton_ratio(s, d):
    return _sides(s, d).select(*X.KEYS, F.round(scorer("ratio")("a_name_skeleton", "b_name_skeleton"), 9).alias("skel_ratio"))


@query
def feat_street_similarity(s, d):
    x = scorers(["ratio", "tset", "tsort", "jw"], "a_addr_street", "b_addr_street")
    return _sides(s, d).withColumn("x", x).select(*X.KEYS, *(F.round(F.col("x")[k], 9).alias(f"street_{k}") for k in ("ratio", "tset", "tsort", "jw")))


@query
def feat_interactions(s, d):
    r = W.records(s, d)
    x = scorers(["tset", "tsort"], "a_name_core", "b_name_core")
    rows = _sides(s, d).withColumn("x", x).withColumns({"name_tset": F.col("x.tset"), "name_tsort": F.col("x.tsort"), "hn_conflict": X.house_class("a_house_num", "b_house_num")[0].isin(*X.HOUSE_CONFLICTS).cast("int")})
    rows = X.interactions(X.rarity(rows, X.idf_of(r, "name_core"), X.name_frequency(r)))
    return rows.select(*X.KEYS, F.round("name_sim_x_rarity", 8).alias("name_sim_x_rarity"), "name_match_hn_conflict")


def _similar(kind: str):
    return lambda s, d: _sides(s, d).select(*X.KEYS, F.round(scorer(kind)("a_name_core", "b_name_core"), 9).alias("similarity"))


for _name, _kind in (("feat_ratio", "ratio"), ("feat_token_sort", "tsort"), ("feat_token_set", "tset"), ("feat_jaro_winkler", "jw"), ("feat_partial_ratio", "partial")):
    QUERIES[_name] = _similar(_kind)


@query
def features(s, d):
    return X.build_features(W.pairs(s, d), W.records(s, d))


# learning


@query
def folds(s, d):
    return W.folds(s, d)


@query
def subworld(s, d):
    return L.sample_subworld(W.s1(s, d), W.truth(s, d), W.pairs(s, d))[0]


@query
def subworld_candidates(s, d):
    return L.sample_subworld(W.s1(s, d), W.truth(s, d), W.pairs(s, d))[1].select("s1_id", "cand_id")


@query
def density(s, d):
    return L.density_report(L.sample_subworld(W.s1(s, d), W.truth(s, d), W.pairs(s, d))[0], W.raw_records(s, d))


@query
def train_oof(s, d):
    return L.train_oof(X.build_features(W.pairs(s, d), W.records(s, d)), W.truth(s, d), W.folds(s, d))[0].select(*X.KEYS, "fold", "raw", "p")


@query
def fallback_oof(s, d):
    return L.train_oof(L.fallback_features(W.pairs(s, d), W.records(s, d)), W.truth(s, d), W.folds(s, d))[0].select(*X.KEYS, "fold", "raw", "p")


@query
def isotonic_calibration(s, d):
    rows = L.labelled(W.scores(s, d).withColumnRenamed("p", "raw"), W.truth(s, d), W.folds(s, d))
    return L.cross_fit_isotonic(rows, list(range(5))).select(*X.KEYS, "fold", "raw", "p")


@query
def predict(s, d):
    """A model of folds 1 to 4 scores fold 0, which it never saw."""
    rows = L.labelled(L.fallback_features(W.pairs(s, d), W.records(s, d)), W.truth(s, d), W.folds(s, d))
    names = [c for c in rows.columns if c not in (*X.KEYS, "label", "fold")]
    return L.scored(L.fit(rows.filter("fold <> 0"), names), rows.filter("fold = 0"), names).select(*X.KEYS, F.col("raw").alias("p"))


# decisions


@query
def assign_one_to_one(s, d):
    return D.assign_one_to_one(W.scores(s, d)).select("s1_id", "cand_id", "p")


@query
def select_threshold(s, d):
    return D.select_threshold(D.assign_one_to_one(W.scores(s, d)), 0.5)


@query
def select_ef05_approx(s, d):
    return D.select_expected(D.assign_one_to_one(W.scores(s, d)), "approx")


@query
def select_ef05_exact(s, d):
    return D.select_expected(D.assign_one_to_one(W.scores(s, d)), "exact")


@query
def threshold_curve(s, d):
    return D.threshold_curve(W.scores(s, d), W.truth(s, d), W.s1(s, d), GRID)


@query
def best_threshold(s, d):
    curve = D.threshold_curve(W.scores(s, d), W.truth(s, d), W.s1(s, d), GRID).filter("country = 'ALL'")
    return curve.orderBy(F.col("macro_f05").desc(), F.col("t").desc()).limit(1).select("t", "macro_f05")


@query
def compare_decide(s, d):
    groups = E.s1_groups(W.records(s, d), W.truth(s, d))
    methods = {"threshold": {"threshold": 0.5}, "ef05_approx": {}, "ef05_exact": {}}
    return D.compare({"block_score": W.scores(s, d)}, methods, W.truth(s, d), groups)


# evaluation


def _matches(s, d):
    return D.select_threshold(D.assign_one_to_one(W.scores(s, d)), 0.5)


@query
def gt_long(s, d):
    wide = W.truth(s, d).groupBy(F.col("s1_id").alias("source1_entity_id")).agg(F.array_join(F.collect_list("match_id"), ", ").alias("matched_entity_ids"))
    return E.gt_long(wide)


@query
def per_entity_f05(s, d):
    return E.per_entity_f05(_matches(s, d), W.truth(s, d), W.s1(s, d)).withColumn("f05", F.round("f05", 9))


@query
def macro_f05(s, d):
    return E.macro_f05(_matches(s, d), W.truth(s, d), W.s1(s, d))


@query
def macro_f05_by(s, d):
    return E.macro_f05_by(_matches(s, d), W.truth(s, d), W.s1(s, d), "country")


@query
def s1_groups(s, d):
    return E.s1_groups(W.records(s, d), W.truth(s, d))


@query
def blocking_summary(s, d):
    return E.blocking_summary(W.pairs(s, d), W.truth(s, d), W.raw_records(s, d))


@query
def blocking_by_script(s, d):
    return E.blocking_by_script(W.pairs(s, d), W.truth(s, d), W.records(s, d))


@query
def blocking_by_pass(s, d):
    return E.blocking_by_pass(W.pairs(s, d), W.truth(s, d), B.PASS_NAMES)


@query
def recall_at_k(s, d):
    return E.recall_at(W.ranked(s, d), W.truth(s, d))


@query
def decoy_load(s, d):
    return E.decoy_load(W.pairs(s, d), W.truth(s, d), W.raw_records(s, d))


@query
def missed_pairs(s, d):
    return E.missed_pairs(B.cap_per_s1(W.ranked(s, d), 1), W.merged(s, d), W.truth(s, d))


def _errors(s, d):
    return E.enrich(E.classify(_matches(s, d), W.scores(s, d), W.pairs(s, d), W.truth(s, d)), W.records(s, d), W.truth(s, d))


@query
def error_classes(s, d):
    return _errors(s, d).select("s1_id", "cand_id", "kind", "p", "gt_owner", "assigned_to", "hn_rel", "hn_diff", "s1_bucket")


@query
def error_summary(s, d):
    return E.error_summary(_errors(s, d), "country")


@query
def error_worst(s, d):
    out = None
    for kind, rows in E.error_worst(_errors(s, d)).items():
        part = rows.select(F.lit(kind).alias("kind"), "s1_id", "cand_id", "p")
        out = part if out is None else out.unionByName(part)
    return out


# input and output


@query
def ingest_checks(s, d):
    return tsv.checks(W.raw_records(s, d).select("entity_id", "name_raw", "addr_raw", "country"))


@query
def submission_lists(s, d):
    return tsv.id_lists(_matches(s, d), W.s1(s, d).select("s1_id"))


@query
def submission_checks(s, d):
    valid = W.raw_records(s, d).filter("source <> 1").select(F.col("entity_id").alias("cand_id"))
    return tsv.submission_faults(_matches(s, d), W.pairs(s, d).filter("rank_in_cand = 1"), W.s1(s, d), valid)


# profiles


@query
def eda_profile(s, d):
    return P.profile(W.raw_records(s, d))


@query
def eda_top_tokens(s, d):
    return P.top_tokens(W.records(s, d), "name_norm", 10)


@query
def eda_match_histogram(s, d):
    return P.match_histogram(W.s1(s, d), W.truth(s, d))


@query
def eda_crosstab(s, d):
    return P.source_composition(W.s1(s, d), W.truth(s, d))


@query
def eda_one_to_one(s, d):
    return P.one_to_one(W.raw_records(s, d), W.truth(s, d))


@query
def eda_pair_noise(s, d):
    return P.pair_noise(W.truth(s, d), W.records(s, d))


@query
def eda_nn_scan(s, d):
    return P.nearest_names(W.records(s, d), W.truth(s, d))
