import random

import pytest
from pyspark.sql import functions as F

from entrygraph.operators import entries, scan


def guide_rows(seed, n):
    draw = random.Random(seed)
    rows, value = [], 0
    for seq in range(n):
        value += draw.choice((0, 1, 1, 2, 5, -3))
        kind = draw.choice(("place", "route", "route", "traverse"))
        guide = "a" if seq % 17 else draw.choice("bc")
        rows.append((guide, seq, value if draw.random() < 0.4 else None, kind, f"E{seq}"))
    return rows


@pytest.mark.parametrize("rows", [1, 7, 50, 100_000])
def test_blocks_give_what_windows_give(spark, rows):
    df = spark.createDataFrame(guide_rows(rows, 400), "guide_id string, seq int, value int, kind string, id string")
    want = {(r.guide_id, r.seq): r.filled for r in entries.gap_fill(df).collect()}
    got = entries.gap_fill_blocks(df, rows=rows)
    assert set(got.columns) == {*df.columns, "filled"}
    assert {(r.guide_id, r.seq): r.filled for r in got.collect()} == want
    assert sum(r is not None for r in want.values()) > df.filter("value is not null").count()
    want = {(r.guide_id, r.seq): r.destination_id for r in entries.parents(df).collect()}
    assert {(r.guide_id, r.seq): r.destination_id for r in entries.parents_blocks(df, rows).collect()} == want


def test_no_rows_and_no_values(spark):
    df = spark.createDataFrame(guide_rows(1, 60), "guide_id string, seq int, value int, kind string, id string")
    assert entries.gap_fill_blocks(df.limit(0)).count() == entries.parents_blocks(df.limit(0)).count() == 0
    bare = df.withColumn("value", F.lit(None).cast("int")).withColumn("kind", F.lit("route"))
    assert entries.gap_fill_blocks(bare, rows=9).filter("filled is not null").count() == 0
    assert entries.parents_blocks(bare, 9).filter("destination_id is not null").count() == 0


def test_no_task_holds_a_guide(spark):
    """A guide of 40,000 rows lies in stretches of at most a few thousand, in order."""
    df = spark.range(40_000).selectExpr("1 AS guide_id", "id AS seq")
    per = scan.blocks(df, 2000).groupBy(scan.BLOCK).agg({"seq": "min", "*": "count"}).orderBy(scan.BLOCK).collect()
    assert len(per) >= 15 and max(r["count(1)"] for r in per) < 8000
    assert [r["min(seq)"] for r in per] == sorted(r["min(seq)"] for r in per)
