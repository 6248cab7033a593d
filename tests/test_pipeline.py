from collections import Counter

import pytest

from recordloom.plans import config, pipeline


def write_split(folder, split):
    rows = {1: [], 2: [], 3: []}
    words = ["oak", "pine", "elm", "ash", "fir", "yew", "bay", "fig", "plum", "pear", "lime", "cedar"]
    for i in range(36):
        name, addr = f"{words[i % 12]} {words[(i * 5 + 1) % 12]} {words[(i * 7 + 3) % 12]} works", f"{100 + i} {words[(i * 3) % 12]} street"
        rows[1].append((f"S1-{i}", f"{name} inc", addr))
        rows[2].append((f"S2-{i}", name, addr))
        rows[3].append((f"S3-{i}", f"other {words[i % 12]}", f"{500 + i} far road"))
    for s, own in rows.items():
        lines = ["entity_id\tbusiness_name\tbusiness_address\tcountry"] + [f"{a}\t{b}\t{c}\tUS" for a, b, c in own]
        (folder / f"{split}_source{s}.tsv").write_text("\n".join(lines) + "\n")
    (folder / f"{split}_ground_truth.tsv").write_text("source1_entity_id\tmatched_entity_ids\n" + "".join(f"S1-{i}\tS2-{i}\n" for i in range(36)))


def test_every_stage_of_every_chain_exists():
    assert {s for chain in pipeline.CHAIN.values() for s in chain} <= set(pipeline.STAGES)
    with pytest.raises(ValueError, match="no stage"):
        pipeline.run("nothing", None)


def test_config():
    c = config.load(sets=["block.k_per_query=3", "decide.method=threshold"])
    assert c.get("block.k_per_query") == 3 and c.get("decide.method") == "threshold" and c.get("no.such", 1) == 1
    assert c.hash != config.load().hash == config.load().hash
    with pytest.raises(KeyError):
        c.get("no.such")
    with pytest.raises(TypeError):
        c.settings["block"]["k_per_query"] = 1


def test_chain_end_to_end(spark, tmp_path):
    for split in ("train", "test"):
        write_split(tmp_path, split)
    sets = [f"paths.{k}={tmp_path}{'' if k == 'raw' else '/' + k}" for k in ("raw", "artifacts", "out")] + ["model.rounds=3", "folds.n=2", "decide.scores_name=scores_fallback", "decide.method=ef05_approx"]
    for split in ("train", "test"):
        on = pipeline.Run(spark, config.load(sets=sets), split)
        for name in pipeline.CHAIN[split, "fallback"]:
            pipeline.run(name, on)
    lines = (tmp_path / "out" / "matching.tsv").read_text().splitlines()
    assert len(lines) == 37 and sum(line.split("\t")[1] == f"S2-{line[3:].split(chr(9))[0]}" for line in lines[1:]) >= 30


def test_the_stub_world_is_what_it_says(spark):
    from recordloom.sources import stub

    records, truth = stub.world(spark, 48)
    rows, pairs = {r["entity_id"]: r for r in records.collect()}, truth.collect()
    assert len(rows) == records.count() and sum(r["source"] == 1 for r in rows.values()) == 48
    n = Counter(p["s1_id"] for p in pairs)
    assert sum(f"S1-{i * 10}" not in n for i in range(48)) == 4 and max(n.values()) <= 5
    assert all(rows[p["s1_id"]]["country"] == rows[p["match_id"]]["country"] and rows[p["match_id"]]["source"] > 1 for p in pairs)
    assert sorted(map(str, records.collect())) == sorted(map(str, stub.world(spark, 48)[0].repartition(3).collect()))


def test_an_empty_submission_has_every_id(spark, tmp_path):
    write_split(tmp_path, "test")
    on = pipeline.Run(spark, config.load(sets=[f"paths.{k}={tmp_path}{'' if k == 'raw' else '/' + k}" for k in ("raw", "artifacts", "out")]), "test")
    for name in ("ingest", "empty_submission"):
        pipeline.run(name, on)
    assert (tmp_path / "out" / "matching.tsv").read_text().splitlines()[1:] == [f"S1-{i}\t" for i in range(36)]


SCHEMA = "entity_id string, source int, country string, name_raw string, addr_raw string"


def stream_world(spark):
    from recordloom.operators import normalize
    from recordloom.streaming import incremental

    known = [("S1-1", 1, "US", "Reed Pizza Inc", "12 Oak Street"), ("S1-2", 1, "US", "Blue Anchor", "77 Pine Road"), ("S2-8", 2, "US", "Reed Pizza House", "12 Oak Street"), ("S3-9", 3, "US", "Anchor Blue", "77 Pine Road")]
    return incremental.World(normalize.build_records(spark.createDataFrame(known, SCHEMA)))


def test_stream_of_new_records(spark, tmp_path):
    from recordloom.streaming import incremental

    spark.createDataFrame([("S2-1", 2, "US", "Reed Pizza", "12 Oak St")], SCHEMA).write.json(str(tmp_path / "in"))
    q = incremental.start(spark.readStream.schema(SCHEMA).json(str(tmp_path / "in")), stream_world(spark), str(tmp_path / "out"), str(tmp_path / "check"), availableNow=True)
    q.awaitTermination(120)
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert [(r["s1_id"], r["cand_id"], r["rank_in_cand"]) for r in rows] == [("S1-1", "S2-1", 1)]


def test_a_record_scores_alone_as_in_a_batch(spark):
    world = stream_world(spark)
    new = [("S2-1", 2, "US", "Pizza", "12 Oak St"), ("S2-2", 2, "US", "Reed Pizza", "12 Oak St"), ("S3-3", 3, "US", "The Anchor", "9 Pine Road"), ("S3-4", 3, "FR", "Reed", "12 Oak"), *((f"S3-{i}", 3, "US", "x", "Oak Lane") for i in range(10, 16))]
    rows = lambda own: sorted(map(str, world.candidates(spark.createDataFrame(own, SCHEMA)).collect()))
    assert rows(new) == sorted(x for r in (new[:1], new[1:2], new[2:]) for x in rows(r)) and len(rows(new)) >= 3
