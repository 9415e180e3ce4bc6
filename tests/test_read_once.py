from entrygraph.inputs import read
from entrygraph.operators import matching
from entrygraph.plans import staging

ITEM = "item_id int, seq int, entry_id string, kind string, surface string, name string, type string, elevation_m double"
FEATURE = "name string, type string, lat double, lon double, ele double, osm string"


def test_a_small_table_is_dealt_to_all_tasks(spark, tmp_path):
    spark.range(8).withColumnRenamed("id", "p_partkey").selectExpr("p_partkey", "'blue rod' p_name", "'A' p_type", "'B' p_brand", "1 p_size").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    items = read(spark, str(tmp_path), "items", deal=True)
    assert items.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism > 1 and items.count() == 8


def test_outcomes_are_not_written_for_one_reader(spark, monkeypatch):
    """Only small tables are written for ``settle``, and decisions and verdicts find their candidate in lists of a key."""
    items = spark.createDataFrame([(i, i, f"E{i}", "mention", "Karwendel", "Karwendel", None, None) for i in range(6)], ITEM)
    g = spark.createDataFrame([("Karwendelhaus", "hut", 47.0, 11.0, None, f"node/{k}") for k in (1, 2, 2)], FEATURE)
    d = spark.createDataFrame([(f"E{i}", "Karwendel", None, "mention", ref, None) for i, ref in ((0, "node/2"), (1, "node/9"), (2, "skip"))], "entry_id string, name string, type string, kind string, decision string, note string")
    case = [r.c for r in items.select(matching.text.case_id(*[matching.F.col(c) for c in ("entry_id", "name", "type", "kind")]).alias("c")).orderBy("c").collect()]
    v = spark.createDataFrame([(case[0], "node/1", "a"), (case[3], "node/2", "b"), (case[4], "node/9", "c")], "case_id string, pick string, reason string")
    found, sizes = matching.levels(items, g), []
    monkeypatch.setattr(matching, "written", lambda df: sizes.append(df.count()) or staging.written(df))
    rows = matching.settle(found, d, v, ()).orderBy("item_id").collect()
    assert max(sizes) < items.count()
    assert [(r.method, r.chosen and r.chosen.osm) for r in rows] == [("review", "node/2"), ("unmatched", None), ("skipped", None), ("llm", "node/2"), ("unmatched", None), ("unmatched", None)]
    assert [r.case_id for r in rows] == case and [r.queued for r in rows] == [False, True, False, False, False, True]


def test_pairs_hold_what_is_wanted_of_a_feature(spark, monkeypatch):
    monkeypatch.setattr(matching, "PAIRS", 5)
    items = spark.createDataFrame([(i, i, f"E{i}", "mention", "Alm", "Alm", None, None) for i in range(6)], ITEM)
    g = spark.createDataFrame([("alm", "hut", 47.0, 11.0, None, f"node/{k}") for k in range(4)], FEATURE)
    pairs = matching.exact_candidates(items, g, of=("osm",))
    assert not {"g_name", "lat", "lon"} & set(pairs.columns)
    assert sorted((r.item_id, r.osm) for r in pairs.collect()) == [(i, f"node/{k}") for i in range(6) for k in range(4)]
