import random
import re

import pytest
from pyspark.sql import functions as F

from recordloom.functions import similarity, text
from recordloom.operators import blocking, features, normalize
from recordloom.plans import catalogue

RAW = "entity_id string, source int, country string, name_raw string, addr_raw string"


def raw(spark, rows):
    return spark.createDataFrame(rows, RAW)


def house_model(a, b):
    """The classes by trying every edit, for numbers of few digits."""
    a, b = ((x or "").strip().lower() for x in (a, b))
    if not a or not b:
        return "both_missing" if a == b else "one_missing"
    bare = lambda x: x.lstrip("0") or "0"
    split = lambda x: (bare(m[0]) if (m := re.match("[0-9]+", x)) else None, re.sub("[^0-9a-z]", "", re.sub("^[0-9]+", "", x)))
    (x, s), (y, t) = split(a), split(b)
    if a == b or (x is not None and x == y and s == t):
        return "equal"
    if x is None or y is None:
        return "different"
    if x == y:
        return "same_base_diff_suffix"
    if any(x[:i] + x[i + 1] + x[i] + x[i + 2 :] == y for i in range(len(x) - 1)):
        return "transposed"
    longer, shorter = (x, y) if len(x) > len(y) else (y, x)
    if any(bare(longer[:i] + longer[i + 1 :]) == shorter for i in range(len(longer))):
        return "digit_dropped"
    return "small_shift" if abs(int(x) - int(y)) <= 50 else "different"


def test_house_classes_equal_a_model_that_tries_all_edits(spark):
    rng = random.Random(1)
    number = lambda: "".join(rng.choices("0125", k=rng.randint(1, 4))) + rng.choice(["", "", "", "b", "-b", "/2"])
    cases = [(number(), number()) for _ in range(900)] + [(x, rng.choice([None, "", " ", "b7"])) for x in (number(), "", None) for _ in range(6)]
    for a, _ in cases[:300]:  # near ones
        d = list(a)
        i = rng.randrange(len(d))
        d[i : i + 1] = rng.choice([[], [d[i], "5"], d[i : i + 1][::-1]])
        cases.append((a, "".join(d)))
    df = spark.createDataFrame(cases, "a string, b string")
    rel, diff, share = features.house_class("a", "b")
    rows = df.select("a", "b", rel.alias("r"), diff.alias("d"), share.alias("s"), features.code(rel, features.HOUSE_CLASSES).alias("c"), rel.isin(*features.HOUSE_CONFLICTS).alias("x")).collect()
    assert [r["r"] for r in rows] == [house_model(r["a"], r["b"]) for r in rows]
    assert {r["r"] for r in rows} == set(features.HOUSE_CLASSES)
    assert all(features.HOUSE_CLASSES[r["c"]] == r["r"] and r["x"] == (r["r"] in ("small_shift", "different")) for r in rows)
    for r in rows:
        x, y = (re.match("[0-9]+", v or "") for v in (r["a"], r["b"]))
        assert r["d"] == (abs(int(x[0]) - int(y[0])) if x and y else None)
        assert r["s"] == (pytest.approx(r["d"] / max(int(x[0]), int(y[0]))) if x and y and max(int(x[0]), int(y[0])) else None)


def test_legal_codes(spark):
    cases = [("llc", "llc", 0), ("llc", "", 1), (None, "inc", 1), ("", None, 2), ("llc", "inc", 3)]
    df = spark.createDataFrame(cases, "a string, b string, w int")
    assert all(r["w"] == r["c"] for r in df.select("w", features.code(features.legal_relation("a", "b"), features.LEGAL_CLASSES).alias("c")).collect())


def test_house_numbers(spark):
    cases = {
        ("block 7 lucknow", "India"): "", ("88 ring road door 31", "India"): "31", ("h no 4-55-6 hill view", "India"): "4-55-6", ("21 bis avenue foch", "France"): "21bis", ("9 ter quai nord", "France"): "9ter",
        ("Riverton, 318 Willow Court", "US"): "318", ("64 Beech Ave Unit 12", "US"): "64", ("Suite 9, Beech Ave", "US"): "", ("2nd Main, 17 Park Road", "India"): "17", ("00052 Ash", "US"): "52", ("NULL", "US"): "", (" ", ""): "",
    }
    rows = normalize.with_addresses(raw(spark, [(str(i), 1, c, "", a) for i, (a, c) in enumerate(cases)])).collect()
    assert {(r["addr_raw"], r["country"]): r["house_num"] for r in rows} == cases
    assert next(r for r in rows if r["addr_raw"].startswith("21 bis"))["addr_nums"] == ["21bis"]


def test_base_and_names(spark):
    df = spark.createDataFrame([("12/3 MG Road, Shop 45-A", "12/3 mg road shop 45-a"), ("3rd Cross, 1st Main", "3rd cross 1st main"), ("--Foo & Bar", "foo and bar"), ("bu1kers", "bu 1 kers"), ("Société", "societe"), (None, "")], "x string, w string")
    assert all(r["b"] == r["w"] for r in df.select("w", text.base(F.col("x")).alias("b")).collect())
    names = {r["name_raw"]: r for r in normalize.with_names(raw(spark, [("1", 1, "India", "XYZ PRIVATE LIMITED", ""), ("2", 1, "US", "Foo LLC doing business as Bar", ""), ("3", 1, "x", "テスト", ""), ("4", 1, "India", "शर्मा", ""), ("5", 1, "x", "The Shri Foo", "")])).collect()}
    assert (names["XYZ PRIVATE LIMITED"]["legal_form"], names["XYZ PRIVATE LIMITED"]["name_core"]) == ("private limited", "xyz")
    assert names["テスト"]["name_script"] == "Other" and names["शर्मा"]["name_script"] == "Devanagari" and names["शर्मा"]["name_norm"].isascii()
    assert names["The Shri Foo"]["name_norm"] == "foo"


def test_handles(spark):
    df = spark.createDataFrame([("@@lakeside_tools", "lakeside_tools", True), ("mapleOptics", "maple Optics", True), ("Copperlamps.ORG ", "Copperlamps", True), ("two words.net", "two words", True), ("Plain Name", "Plain Name", False), ("plain", "plain", False)], "x string, w string, h boolean")
    assert all(r["s"] == r["w"] and r["i"] == r["h"] for r in df.select("w", "h", text.strip_handle(F.col("x")).alias("s"), text.is_handle(F.col("x")).alias("i")).collect())


def test_skeletons_keep_long_tokens_whole(spark):
    long = "b" + "ca" * 1500 + "z"
    assert spark.createDataFrame([(long,)], "x string").select(text.skeleton(F.col("x"))).first()[0] == "bcz"
    mixed = "".join("bcdfgjklmnpqrstwxz"[i % 18] for i in range(3000))
    assert len(spark.createDataFrame([(mixed,)], "x string").select(text.skeleton(F.col("x"))).first()[0]) > 2900


def test_area_tokens_keep_something(spark):
    rows = [(f"S1-{i}", 1, "US", "n", f"{i} oak{'abcdefghij'[i]} springfield") for i in range(10)] + [("S1-90", 1, "US", "n", "7 springfield"), ("S1-91", 1, "FR", "n", "solo"), ("S1-92", 1, "FR", "n", "rue une"), *((f"S1-{93 + i}", 1, "FR", "n", "") for i in range(8))]
    got = {r["entity_id"]: r["addr_street"] for r in normalize.build_records(raw(spark, rows)).collect()}
    assert got["S1-3"] == "oakd" and got["S1-90"] == "springfield" and got["S1-91"] == "solo"


def test_similarities():
    assert similarity.ratio("reed pizza", "reedpizza") == pytest.approx(18 / 19)
    assert similarity.ratio("abc", "xbc") == pytest.approx(2 / 3) and similarity.ratio("", "") == 1 and similarity.ratio("abcd", "") == 0
    assert similarity.token_set("a b c", "c b") == 1 and similarity.token_set("", "") == 0 and similarity.token_sort("b a", "a b") == 1
    assert similarity.partial("pizza", "reed pizza place") == 1 and similarity.jaro_winkler("martha", "marhta") == pytest.approx(0.9611, abs=1e-4)


def subsequence(a, b):
    above = [0] * (len(b) + 1)
    for x in a:
        row = [0]
        for j, y in enumerate(b):
            row.append(above[j] + 1 if x == y else max(above[j + 1], row[-1]))
        above = row
    return above[-1]


def test_similarities_equal_tables_and_windows(spark):
    rng = random.Random(3)
    pairs = [tuple("".join(rng.choices(alphabet, k=rng.randint(0, 13))) for _ in "ab") for alphabet in ("ab", "ab c", "abcdef é") for _ in range(250)]
    of = lambda a, b: 2 * subsequence(a, b) / (len(a) + len(b)) if a and b else float(a == b)
    for a, b in pairs:
        assert similarity.ratio(a, b) == pytest.approx(of(a, b))
        short, long = sorted((a, b), key=len)
        if short:
            windows = [long[max(0, i) : i + len(short)] for i in range(1 - len(short), len(long))]
            assert similarity.partial(a, b) == pytest.approx(max(of(short, w) for w in windows))
        x, y = set(a.split()), set(b.split())
        if x and y:
            both, one, other = (" ".join(sorted(z)) for z in (x & y, x - y, y - x))
            whole = [f"{both} {z}".strip() for z in (one, other)]
            want = 1.0 if both and not (one and other) else max(of(*whole), *((of(both, z) for z in whole) if both else (0.0,)))
            assert similarity.token_set(a, b) == pytest.approx(want)
    df = spark.createDataFrame([*pairs[:40], (None, "ab"), (None, None)], "a string, b string")
    got = df.select("a", "b", similarity.scorers(["ratio", "jw"], "a", "b").alias("x"), similarity.scorer("ratio")("a", "b").alias("y")).collect()
    assert all(r["x"]["ratio"] == r["y"] == similarity.ratio(r["a"] or "", r["b"] or "") and r["x"]["jw"] == similarity.jaro_winkler(r["a"] or "", r["b"] or "") for r in got)
    long = "".join(rng.choices("abcdefgh ", k=6000))
    assert similarity.partial(long[2000:2400], long) == 1 and 0.9 < similarity.partial(long[2000:2400] + "zz", long) < 1


def world(spark):
    rows = [("S1-1", 1, "US", "Reed Pizza Inc", "12 Oak Street"), ("S1-2", 1, "US", "Blue Anchor Foods", "77 Pine Road"), ("S1-3", 1, "US", "Reed Books", "900 Elm Lane"), ("S2-1", 2, "US", "Reed Pizza", "12 Oak St"), ("S2-2", 2, "US", "Anchor Foods Blue", "77 Pine Rd"), ("S3-1", 3, "US", "Unrelated", "5 Far Away"), ("S3-2", 3, "FR", "Reed Pizza", "12 Oak Street")]
    return normalize.build_records(raw(spark, rows))


def test_candidates_find_the_owner(spark):
    records = world(spark).cache()
    for limits in (blocking.Limits(), blocking.Limits(fuzzy=True, pair_keys=True, addr_key_cap=0)):
        got = {(r["s1_id"], r["cand_id"]): r for r in blocking.candidates(records, limits).collect()}
        assert got["S1-1", "S2-1"]["rank_in_cand"] == 1 and got["S1-2", "S2-2"]["rank_in_cand"] == 1
        assert not any(c == "S3-2" for _, c in got)


def test_block_fuzzy_keeps_weak_names(spark, monkeypatch):
    rows = [("S1-1", 1, "US", "Reed Pizza Parlour", ""), ("S1-2", 1, "US", "Blue Anchor Foods", ""), ("S2-1", 2, "US", "Blue Whale", ""), ("S2-2", 2, "US", "Quartz", "")]
    records = normalize.build_records(raw(spark, rows)).cache()
    monkeypatch.setattr(catalogue.W, "records", lambda s, d: records)
    got = catalogue.QUERIES["block_fuzzy"](spark, "").collect()
    assert [(r["cand_id"], r["s1_id"]) for r in got] == [("S2-1", "S1-2")] and 0.3 <= got[0]["score"] < 0.5


def test_merge_scales_and_ranks(spark):
    raw_hits = spark.createDataFrame([("X", "c1", "a", 10.0, 0), ("X", "c1", "b", 5.0, 0), ("X", "c1", "a", 0.5, 1), ("X", "c2", "b", 1.0, 1)], "country string, cand_id string, s1_id string, score double, bit int")
    got = {(r["s1_id"], r["cand_id"]): (r["block_mask"], r["block_score"]) for r in blocking.merge_passes(raw_hits).collect()}
    assert got == {("a", "c1"): (3, 1.5), ("b", "c1"): (1, 0.5), ("b", "c2"): (2, 1.0)}
    pairs = spark.createDataFrame([("b", "c", 1.0, 0.5), ("a", "c", 1.0, 0.5), ("d", "c", 2.0, 0.9)], "s1_id string, cand_id string, block_score double, rank_score double")
    ranked = {r["s1_id"]: r["rank_in_cand"] for r in blocking.rank_per_cand(pairs, 2).collect()}
    assert ranked == {"d": 1, "a": 2}
    assert {r["s1_id"]: r["rank_in_cand"] for r in blocking.rank_per_cand(pairs, 3, min_score=1.5).collect()} == {"d": 1}
    one = blocking.cap_per_s1(pairs.withColumn("s1_id", F.lit("a")).withColumn("cand_id", F.concat("cand_id", F.monotonically_increasing_id())), 2)
    assert one.count() == 2


def test_shuffle_partitions_do_not_matter(spark):
    records = world(spark).cache()
    out = []
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for n in ("1", "8"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        out.append(sorted(map(tuple, blocking.candidates(records).collect())))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert out[0] == out[1]


def test_token_difference(spark):
    rng = random.Random(4)
    rows = [(str(i), *(" ".join(rng.choices(["oak", "elm", "ash", "yew"], k=rng.randint(0, 4))) for _ in "ab")) for i in range(60)]
    df = spark.createDataFrame([(i, i, "IN", a, b) for i, a, b in rows], "s1_id string, cand_id string, country string, a string, b string")
    known = {"oak": 0.0, "elm": 1.5, "ash": 2.5}
    idf = spark.createDataFrame([("IN", t, w) for t, w in known.items()], "country string, token string, idf double")
    got = {r["s1_id"]: r for r in features.token_difference(df, "a", "b", "n", idf).collect()}
    for i, a, b in rows:
        x, y, r = set(a.split()), set(b.split()), got[i]
        assert (r["n_only_a"], r["n_only_b"], r["n_one_extra"]) == (len(x - y), len(y - x), int(len(x ^ y) == 1 and bool(x & y)))
        assert (r["n_extra_idf_a"], r["n_extra_idf_b"]) == tuple(pytest.approx(sum(known.get(t, 0) for t in z)) for z in (x - y, y - x))


def test_features_have_the_contract(spark):
    records = world(spark).cache()
    rows = features.build_features(blocking.candidates(records), records)
    assert len(rows.columns) == 3 + 56 and rows.count() > 0
    poisoned = features.build_features(blocking.candidates(records).withColumn("rank_score", F.lit(99.0)), records)
    assert sorted(map(str, rows.collect())) == sorted(map(str, poisoned.collect()))
    with pytest.raises(Exception, match="not in the vocabulary"):
        spark.createDataFrame([("zzz",)], "x string").select(features.code(F.col("x"), ("a",))).collect()
