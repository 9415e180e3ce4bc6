from entrygraph.operators import audit


def test_texts_are_cut_before_the_links_meet_them(spark):
    """Neither the description nor its flat form is in what joins or exchanges of the links carry."""
    links = spark.createDataFrame([("E1", "a spring", f"osm-{i}") for i in range(50)] + [("E2", "gone", "osm-1"), ("E3", "x", "osm-2")], "entry_id string, surface string, poi_id string")
    entries = spark.createDataFrame([("E1", "E", "far away " * 40 + "a  spring " + "and on " * 40), ("E2", "F", None)], "id string, name string, description string")
    resolved = spark.createDataFrame([("E1", "mention", "a spring", "n", 900.0, "fuzzy", 1), ("E1", "mention", "a spring", "n", 800.0, "exact", 2)], "entry_id string, kind string, surface string, name string, elevation_m double, method string, seq int")
    pois = spark.createDataFrame([(f"osm-{i}", f"Quelle {i}", 880.0) for i in range(40)], "poi_id string, name string, ele double")
    rows = audit.mention_rows(links, entries, resolved, pois)
    assert "description" not in rows._jdf.queryExecution().optimizedPlan().toString()
    got = {(r.key.split("\x1f")[0], r.poi_id): r for r in rows.collect()}
    assert len(got) == 51 and ("E3", "osm-2") not in got
    assert {(r.method, "a spring" in r.excerpt, r.osm_name, r.delta) for k, r in got.items() if k == ("E1", "osm-7")} == {("fuzzy", True, "Quelle 7", "+20 m")}
    assert got["E1", "osm-45"].osm_name == "(missing POI osm-45)" and got["E1", "osm-45"].delta == "—"
    assert (got["E2", "osm-1"].method, got["E2", "osm-1"].excerpt) == ("?", "—")
