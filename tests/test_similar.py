import random

import pytest
from pyspark.sql import functions as F

from entrygraph.operators import matching, similar


def lcs(x, y):
    row = [0] * (len(y) + 1)
    for c in x:
        last = row[:]
        for j, d in enumerate(y):
            row[j + 1] = last[j] + 1 if c == d else max(row[j], last[j + 1])
    return row[-1]


def near(x, y, least):
    return 200 * lcs(x, y) >= least * (len(x) + len(y))


def words(seed, n, letters="abcde", most=14):
    draw = random.Random(seed)
    base = ["".join(draw.choices(letters, k=draw.randint(1, most))) for _ in range(n // 3)]
    out = base + ["", "a", "ab", "é𝄞x"]
    while len(out) < n:
        w = list(draw.choice(base))
        for _ in range(draw.randint(1, 3)):
            if draw.random() < 0.5 and w:
                w.pop(draw.randrange(len(w)))
            else:
                w.insert(draw.randint(0, len(w)), draw.choice(letters))
        out.append("".join(w))
    return out


def keys(spark, values):
    return spark.createDataFrame([(v, "g") for v in values] + [(None, "g")], "key string, guide_id string")


@pytest.mark.parametrize("least", [95, 90, 80, 70, 60])
def test_join_finds_all_similar_keys(spark, least):
    left, right = words(1, 70), words(2, 70) + words(1, 40)
    got = {(r.key, r.g_key) for r in similar.similar(keys(spark, left), keys(spark, right), least).collect()}
    assert got == {(x, y) for x in set(left) for y in set(right) if near(x, y, least)}


def test_keys_meet_in_their_scope_only(spark):
    left = spark.createDataFrame([("abc", "x"), ("abc", "y"), ("abd", "y")], "key string, guide_id string")
    right = spark.createDataFrame([("abc", "x"), ("abd", "y")], "key string, guide_id string")
    got = similar.similar(left, right, 60, ["guide_id"]).select("key", "g_key", "guide_id").collect()
    assert sorted(map(tuple, got)) == [("abc", "abc", "x"), ("abc", "abd", "y"), ("abd", "abd", "y")]
    assert similar.similar(left.limit(0), right, 60).count() == similar.similar(left, right.limit(0), 60).count() == 0


def test_few_candidates_beside_the_hits(spark):
    """Names of two thousand, each with one or two errors, against all: hardly more than the hits are compared."""
    draw, syllables = random.Random(4), "kar wen del spitz joch kogel horn tal berg see alm grat wand stein rot hoch".split()
    names = sorted({"".join(draw.choices(syllables, k=draw.randint(3, 5))) for _ in range(2500)})
    left = [n[:k] + n[k + 1 :] for n in names[::5] for k in [draw.randrange(len(n))]]
    a, b = similar.ordered(keys(spark, left), keys(spark, names))
    met = similar.candidates(a, b, 90).cache()
    hits = similar.scored(met, 90).count()
    assert hits == sum(near(x, y, 90) for x in set(left) for y in names if abs(len(x) - len(y)) < 4)
    assert met.count() <= 20 * hits
    joined = similar._meeting(a, 90, True).join(similar._meeting(b, 90, False).select("_sign"), "_sign").count()
    assert joined <= 40 * hits < len(set(left)) * len(names) / 4


def test_falling_cutoffs_give_the_same_best(spark):
    left, right = words(7, 60), words(7, 60) + words(8, 60)
    features = keys(spark, right).select(F.col("key").alias("g_key"), "guide_id").filter("g_key is not null").distinct()
    weights = features.withColumn("weight", F.lit(2))
    a, b = similar.ordered(keys(spark, left), keys(spark, right))
    first = similar.scored(similar.candidates(a, b, 90), 90)
    levels = similar.falling(a, b, weights.drop("guide_id"), (90, 80, 70, 60), 6, first)
    settled = [{r.key for r in df.select("key").distinct().collect()} for df in levels]
    assert len(levels) == 4 and all(not x & y for i, x in enumerate(settled) for y in settled[:i])
    got = {}
    for df in levels:
        for r in df.collect():
            got.setdefault(r.key, []).append((-r.score, r.g_key))
    for x in set(left):
        want = sorted((-float(r), y) for y in set(right) if near(x, y, 60) for r in [round(200 * lcs(x, y) / (len(x) + len(y)) if x or y else 100, 1)])
        mine = sorted(got.get(x, []))
        assert [s for s, _ in mine[:3]] == [s for s, _ in want[:3]] and set(mine[:3]) <= set(want)
    # what went down is what had not found enough
    went = {x for x in set(left) if sum(near(x, y, 90) for y in set(right)) < 3}
    assert set(left) - settled[0] >= went and not settled[0] & went


def test_shortlists_of_the_cascade(spark):
    """Pairs verified: those of keys that are still looking at each cutoff, and no more."""
    items = spark.createDataFrame([(i, n, None, None) for i, n in enumerate(["Karwendelhaus", "Karwendlhaus", "Falkenhuette"])], "item_id int, name string, type string, elevation_m double")
    names = ["Karwendelhaus"] + [f"Karwendelhaus{i}" for i in range(12)] + ["Falkenhueterl", "Falkenhuber", "Xyz"]
    gazetteer = spark.createDataFrame([(n, "hut", 1000.0, 47.0, 11.0, f"node/{i}") for i, n in enumerate(names)], "name string, type string, ele double, lat double, lon double, osm string")
    rows = {r.item_id: r for r in matching.cascade(items, gazetteer).collect()}
    assert rows[0].level == "exact" and rows[1].level == "fuzzy"
    assert rows[2].level == "none" and [c.name for c in rows[2].candidates] == ["Falkenhueterl", "Falkenhuber"]
