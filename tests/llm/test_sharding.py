import itertools
import random
import zlib

from pyspark.sql import functions as F

from entrygraph.llm import sharding


def brute(supply, capacity, cost):
    """The least cost by trying all splits."""
    def ways(total, caps):
        if len(caps) == 1:
            return [(total,)] if total <= caps[0] else []
        return [(x, *rest) for x in range(min(total, caps[0]) + 1) for rest in ways(total - x, caps[1:])]

    best = None
    for plan in itertools.product(*[ways(s, capacity) for s in supply]):
        if all(sum(p[j] for p in plan) <= c for j, c in enumerate(capacity)):
            x = sum(n * cost(i, j) for i, p in enumerate(plan) for j, n in enumerate(p))
            best = x if best is None else min(best, x)
    return best


def test_flow_is_the_cheapest():
    rng = random.Random(1)
    for _ in range(40):
        supply = [rng.randint(0, 4) for _ in range(3)]
        capacity = [rng.randint(0, 4) for _ in range(3)]
        capacity[0] += max(0, sum(supply) - sum(capacity))
        prices = {(i, j): rng.randint(0, 3) for i in range(3) for j in range(3)}
        cost = lambda i, j, p=prices: p[i, j]
        flow = sharding.min_cost_flow(supply, capacity, cost)
        for i, s in enumerate(supply):
            assert sum(n for (a, _), n in flow.items() if a == i) == s
        for j, c in enumerate(capacity):
            assert sum(n for (_, b), n in flow.items() if b == j) <= c
        assert sum(n * cost(i, j) for (i, j), n in flow.items()) == brute(supply, capacity, cost)


def numbered(got):
    sizes, slots, old = {}, {}, {}
    for r in got:
        sizes[r.shard] = sizes.get(r.shard, 0) + r.size
        old[r.old_shard] = old.get(r.old_shard, 0) + r.size
        slots.setdefault(r.shard, []).append(r.slot)
    assert set(sizes) <= set(range(40))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return sizes, old


def test_shards_are_near_equal_and_move_the_fewest_bytes(spark):
    rows = [(i, "é" * (i * 37 % 400) + str(i), "x") for i in range(3000)] + [(7, None, "x"), (None, "a", None), (9, "same", "x"), (9, "same", "x"), (None, "a", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard_hint string")
    got = sharding.reshard(docs, 32, 40).collect()
    assert len(got) == len(rows) and all(r.size == len((r.text or "").encode()) + 16 for r in got)
    sizes, old = numbered(got)
    mean = sum(sizes.values()) / 40
    assert all(abs(s - mean) <= 4 * 816 for s in sizes.values())
    moved = sum(r.size for r in got if r.shard != r.old_shard)
    least = sum(max(0, s - mean) for s in old.values())
    assert moved <= least + 40 * 816
    assert sharding.reshard(docs.limit(0), 32, 40).count() == 0


def test_equal_texts_stay_together_unless_they_fill_a_shard(spark):
    """A third of all rows has one text, and null ids; smaller groups lie in one shard each."""
    rows = [(None, "t" * 300)] * 1500 + [(i, f"group {i % 500} " + "u" * (i % 500 % 30)) for i in range(3000)]
    got = sharding.reshard(spark.createDataFrame(rows, "doc_id long, text string").repartition(7), 32, 40).collect()
    assert len(got) == len(rows)
    sizes, _ = numbered(got)
    mean = sum(sizes.values()) / 40
    assert all(abs(s - mean) < mean / 4 for s in sizes.values())
    shards = {}
    for r in got:
        shards.setdefault(r.text, set()).add(r.shard)
    assert all(len(v) == 1 for k, v in shards.items() if k.startswith("group")) and len(shards["t" * 300]) > 10


def test_query_columns(spark, tmp_path):
    from entrygraph.llm import catalog

    rows = [(i, "text %d" % (i % 5)) for i in range(200)] + [(None, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = catalog.op7_sharding(spark, str(tmp_path)).collect()
    assert len(got) == 201
    for r in got:
        assert r.text_crc32 == zlib.crc32(dict(rows)[r.doc_id].encode() if r.doc_id is not None else b"") and r.law == "bytes" and r.grown_shard is None


def test_rewritten_files_hold_each_row_once(spark, tmp_path):
    """From 4 shards to 5, and from those to 3: no row stays in a folder that is no shard any more."""
    path = str(tmp_path / "out")
    docs = spark.createDataFrame([(i, "t" * (i % 50) + str(i)) for i in range(500)], "doc_id long, text string")
    sharding.write_shards(sharding.reshard(docs, 4, 5), path, 5, only_changed=False)
    assert spark.read.parquet(path).count() == 500
    now = spark.read.parquet(path).withColumn("old_shard", F.col("shard")).withColumn("group", F.xxhash64("text")).drop("shard", "slot")
    done = sharding.transfer(now, 5, 3).drop("group")
    sharding.write_shards(done, path, 3)
    again = spark.read.parquet(path)
    assert again.count() == 500 == again.select("doc_id").distinct().count() and {r.shard for r in again.select("shard").distinct().collect()} <= {0, 1, 2}
    assert {p.name for p in (tmp_path / "out").glob("shard=*")} <= {"shard=0", "shard=1", "shard=2"}


def test_groups_that_fit_a_shard_stay_whole(spark):
    """Groups of a twentieth to nine tenths of a shard, beside small ones; shards are near equal all the same."""
    rows = [(i, f"small {i} " + "s" * (i % 90)) for i in range(6000)]
    whole = sum(len(t) + 16 for _, t in rows) * 3 // 2
    for k in range(24):
        text = f"large {k} " + "l" * 400
        rows += [(10_000 + k, text)] * (whole // 40 * (1 + k % 18) // 20 // (len(text) + 16))
    got = sharding.reshard(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), 32, 40).collect()
    sizes, _ = numbered(got)
    mean = sum(sizes.values()) / 40
    shards = {}
    for r in got:
        shards.setdefault(r.text, set()).add(r.shard)
    assert len(got) == len(rows) and all(len(v) == 1 for v in shards.values())
    assert all(abs(s - mean) < mean / 20 for s in sizes.values())


def test_a_group_goes_where_most_of_it_lies(spark):
    rows = [(i, 3 if i else 0, 7, 116) for i in range(20)] + [(100 + i, i % 4, 1000 + i, 100) for i in range(400)]
    for seed in (1, 2):
        random.Random(seed).shuffle(rows)
        got = sharding.transfer(spark.createDataFrame(rows, "doc_id long, old_shard int, group long, size long").repartition(3), 4, 4).collect()
        assert sum(r.group == 7 and r.shard != r.old_shard for r in got) == 1


def test_clashing_names_are_carried(spark):
    names = ["group", "_draw", "_key", "_part", "_row", "_large", "bytes", "block", "upto", "odd.name"]
    docs = spark.createDataFrame([(i, f"t{i % 7}", *[f"{n}{i}" for n in names], 5) for i in range(50)], ["doc_id", "text", *names, "slot"])
    got = sharding.reshard(docs, 4, 5)
    assert got.columns == ["doc_id", "text", *names, "size", "old_shard", "shard", "slot"]
    assert all(r[n] == f"{n}{r.doc_id}" for r in got.collect() for n in names)
