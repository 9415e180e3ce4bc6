from entrygraph.operators import audit, matching, work
from entrygraph.sources import writers

ROWS = "key string, poi_id string, title string, excerpt string, osm_name string, delta string, method string"


def test_rendered_sections(spark):
    rows = spark.createDataFrame([("b", "p2", "B", "x", "n", "+1 m", "exact"), ("a", "p1", "A", "y", "m", "—", "fuzzy"), ("b", "p1", "B", "x", "k", "—", "exact")], ROWS)
    unmatched = spark.createDataFrame([("place",), ("mention",), ("place",)], "kind string")
    got = audit.rendered(rows, unmatched, "place").first()
    assert got.markdown.split("\n") == [
        "## Place → POI matches (3 of 3 matches)", "", "| Place (book elev.) | Übersicht excerpt | OSM name | Δ elev. | method |", "| --- | --- | --- | --- | --- |",
        "| A | y | m | — | fuzzy |", "| B | x | k | — | exact |", "| B | x | n | +1 m | exact |",
    ]
    assert got.summary == "place matches: 3 matched (sample 3 — exact: 2, fuzzy: 1), 2 without a match"
    # the uncertain one is in every sample, which is told in the order of keys
    one = audit.rendered(rows, unmatched, "place", size=2).first()
    assert "(2 of 3 matches)" in one.markdown and one.markdown.split("\n")[4] == "| A | y | m | — | fuzzy |"
    none = audit.rendered(rows.limit(0), unmatched, "mention")
    assert none.first().markdown == "## Entry mentions → POI (0 of 0 matches)\n\n| Mention | Prose context | OSM name | Δ elev. | method |\n| --- | --- | --- | --- | --- |"
    both = audit.report(none.unionByName(audit.rendered(rows, unmatched, "place"))).first()
    assert both.markdown == got.markdown + "\n\n" + none.first().markdown
    assert both.summary == f"[audit] {got.summary}; mention links: 0 matched (sample 0 — ), 1 without a match."


def test_funnel_table(spark):
    items = [("m", t, method) for t, n, method in (("hut", 3, "exact"), ("settlement", 3, "tie"), (None, 1, "unmatched")) for _ in range(n)] + [("place", "hut", "fuzzy")]
    r = spark.createDataFrame(items, "kind string, type string, method string")
    funnel = matching.funnel(r)
    lines = work.funnel_table(funnel).first().text.split("\n")
    assert lines[0] == "type      " + "".join(c.rjust(11) for c in work.FUNNEL_COLUMNS)
    rows = [("hut", 3, 3, 0, 0, 0, 0, 0, 0), ("settlement", 3, 0, 0, 0, 0, 3, 0, 0), ("place", 1, 0, 1, 0, 0, 0, 0, 0), ("untyped", 1, 0, 0, 0, 0, 0, 0, 1), ("total", 8, 3, 1, 0, 0, 3, 0, 1)]
    assert lines[1:] == [name.ljust(10) + "".join(str(n).rjust(11) for n in counts) for name, *counts in rows]
    entries = spark.createDataFrame([("R1", True), ("R2", False), ("R3", True)], "id string, has_part boolean")
    assert work.funnel_summary(funnel, entries, "review.jsonl", "unmatched.jsonl").first().text == "[plan funnel] 2/3 entries have extracted mentions; 3 open ties in review.jsonl, 1 unmatched in unmatched.jsonl."


def test_tables_of_a_pass_are_replaced(spark, tmp_path):
    """Each table of a pass takes the place of the one before, be it empty."""
    df = spark.createDataFrame([("p1", 1)], "poi_id string, n int")
    writers.match_outputs({"pois": df, "queue": df}, str(tmp_path))
    writers.match_outputs({"pois": df.limit(0), "queue": df.union(df)}, str(tmp_path))
    assert spark.read.schema("poi_id string, n int").parquet(str(tmp_path / "pois")).count() == 0 and spark.read.parquet(str(tmp_path / "queue")).count() == 2
    # the report of what could not be sliced is empty when nothing is left
    writers.json_lines(df, str(tmp_path / "unsliced"), "n")
    writers.json_lines(df.limit(0), str(tmp_path / "unsliced"), "n")
    assert spark.read.schema("poi_id string").json(str(tmp_path / "unsliced")).count() == 0
