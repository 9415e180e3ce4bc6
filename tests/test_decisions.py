import json

import pytest
from pyspark.sql import functions as F

from entrygraph.operators import matching
from entrygraph.streaming import decisions


def row(i, decision, seq, note=None, type_=None):
    return {"entry_id": f"R{i}", "name": f"N{i}", "type": type_, "kind": "mention", "decision": decision, "note": note, "seq": seq}


def put(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("".join(json.dumps(r) + "\n" for r in rows))


def kept(spark, store):
    return sorted(map(tuple, decisions.current(spark, str(store)).collect()), key=str)


FIRST = [row(i, f"node/{i}", i) for i in range(30)] + [row(3, "skip", 99, "seen")]
SECOND = [row(3, "node/old", 50), row(4, "skip", 100), row(5, None, 101, "open again"), row(40, "node/40", 102), row(4, "skip", 100, type_="peak")]


def test_batches_give_what_one_run_gives(spark, tmp_path):
    one, two = tmp_path / "one", tmp_path / "two"
    assert kept(spark, two) == []
    put(tmp_path / "a", "1.jsonl", FIRST)
    decisions.keep(spark, str(tmp_path / "a"), str(two), str(tmp_path / "at"))
    assert len(kept(spark, two)) == 30
    put(tmp_path / "a", "2.jsonl", SECOND)
    decisions.keep(spark, str(tmp_path / "a"), str(two), str(tmp_path / "at"))
    again = kept(spark, two)
    decisions.keep(spark, str(tmp_path / "a"), str(two), str(tmp_path / "at"))
    put(tmp_path / "b", "1.jsonl", SECOND + FIRST)
    decisions.keep(spark, str(tmp_path / "b"), str(one), str(tmp_path / "at1"))
    assert kept(spark, one) == kept(spark, two) == again and len(again) == 32
    last = {r[:4]: r[4:] for r in again}
    assert last["R3", "N3", None, "mention"] == ("skip", "seen") and last["R5", "N5", None, "mention"] == (None, "open again")


def test_a_batch_that_failed_is_not_seen_and_can_be_repeated(spark, tmp_path):
    store = tmp_path / "s"
    df = lambda rows: spark.createDataFrame([tuple(r.values()) for r in rows], decisions.DECISION)
    decisions.merge(df(FIRST), 0, str(store))
    before = kept(spark, store)
    # files of a version that never got as far as its entry in done
    df(SECOND).withColumn("bucket", F.lit(1)).write.partitionBy("bucket").parquet(f"{store}/cases/version=1")
    assert kept(spark, store) == before
    bad = df(SECOND).withColumn("note", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        decisions.merge(bad, 1, str(store))
    assert kept(spark, store) == before
    for _ in range(2):
        decisions.merge(df(SECOND), 1, str(store))
    assert len(kept(spark, store)) == 32
    # only touched buckets are written anew
    versions = spark.read.parquet(f"{store}/cases").groupBy("version").agg(F.countDistinct("bucket").alias("n")).collect()
    assert {r.version: r.n for r in versions}[1] <= 5


def test_a_case_is_reopened_when_its_candidate_vanishes(spark, tmp_path):
    items = spark.createDataFrame([("R1", 1, 1, "mention", "Kogel", "Kogel", None, None)], "entry_id string, item_id int, seq int, kind string, surface string, name string, type string, elevation_m double")
    both = [("Kogel", "peak", 1000.0, 47.0, 11.0, f"node/{i}") for i in (1, 2, 3)]
    features = lambda rows: spark.createDataFrame(rows, "name string, type string, ele double, lat double, lon double, osm string")
    none = spark.createDataFrame([], "case_id string, pick string, reason string")
    store = str(tmp_path / "s")
    decide = lambda decision, seq: spark.createDataFrame([("R1", "Kogel", None, "mention", decision, None, seq)], decisions.DECISION)
    decisions.merge(decide("node/2", 1), 0, store)
    resolved = lambda rows: matching.resolve(items, features(rows), decisions.current(spark, store), none, ())
    assert resolved(both).first().method == "review" and resolved(both).first().chosen.osm == "node/2"
    gone = resolved([r for r in both if r[5] != "node/2"])
    assert gone.first().method == "tie" and "node/2 is gone" in gone.first().note
    decisions.merge(decisions.reopened(gone, 2), 1, store)
    assert kept(spark, store) == [("R1", "Kogel", None, "mention", None, "accepted candidate node/2 is gone: case reopened")]
    assert resolved(both).first().method == "tie"
    decisions.merge(decide("node/3", 3), 2, store)
    assert resolved(both).first().chosen.osm == "node/3"
