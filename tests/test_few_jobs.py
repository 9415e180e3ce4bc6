import random

from pyspark.sql import functions as F

from entrygraph.functions import similarity
from entrygraph.operators import matching, similar
from entrygraph.plans import staging
from tests.test_similar import lcs

ITEM = "item_id int, seq int, entry_id string, kind string, surface string, name string, type string, elevation_m double"
FEATURE = "name string, type string, lat double, lon double, ele double, osm string"


def test_few_pairs_are_compared_without_python(spark):
    draw = random.Random(3)
    words = ["", "a", "ab", "é𝄞x"] + ["".join(draw.choices("abc", k=k)) for k in (5, 30, 61, 62, 63, 64, 90)]
    pairs = spark.createDataFrame([(x, y) for x in words for y in words], "x string, y string")
    got = pairs.select("x", "y", similarity.lcs_by_places(F.col("x"), similarity.places(F.col("x")), F.col("y")).alias("n")).collect()
    assert all(r.n == lcs(r.x, r.y) for r in got) and len(got) == len(words) ** 2
    keys = spark.createDataFrame([(w,) for w in words], "key string")
    met = similar.scored(similar.all_pairs(keys, keys, 60), 60)
    assert "ArrowEval" not in met._jdf.queryExecution().executedPlan().toString()
    assert {(r.key, r.g_key) for r in met.collect()} == {(x, y) for x in words for y in words if 200 * lcs(x, y) >= 60 * (len(x) + len(y))}


def test_few_tables_are_written_for_a_resolution(spark, monkeypatch):
    """Names are folded once and tables known to be few are not written to be counted; ties still find what they were decided for."""
    items = spark.createDataFrame([(i, i, f"E{i}", "mention", n, n, None, None) for i, n in enumerate(["Karwendelhaus", "Karwendelhau", "Karwendel"])], ITEM)
    g = spark.createDataFrame([("Karwendelhaus", "hut", 47.0, 11.0, None, f"node/{k}") for k in range(3)] + [("Karwendelhaus 1800 m", "hut", 47.0, 11.0, None, "node/3"), (None, "hut", 47.0, 11.0, None, "node/4")], FEATURE)
    d = spark.createDataFrame([("E0", "Karwendelhaus", None, "mention", "node/3", None), ("E1", "Karwendelhau", None, "mention", "node/2", None), ("E2", "Karwendel", None, "mention", "node/4", None)], "entry_id string, name string, type string, kind string, decision string, note string")
    v, tables = spark.createDataFrame([], "case_id string, pick string, reason string"), []
    for m in (matching, similar):
        monkeypatch.setattr(m, "written", lambda df: tables.append(df) or staging.written(df))
    found = matching.levels(items, g)
    assert len(tables) <= 8
    rows = matching.settle(found, d, v, ()).orderBy("item_id").collect()
    assert len(tables) <= 9
    assert [(r.level, r.n, r.method, r.chosen and r.chosen.osm) for r in rows] == [("exact", 4, "review", "node/3"), ("fuzzy", 4, "review", "node/2"), ("none", 4, "unmatched", None)]
