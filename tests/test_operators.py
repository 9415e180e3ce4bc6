import json
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from entrygraph.operators import entries, gazetteer, graph, planning, records, work
from entrygraph.plans import assemble, guides
from entrygraph.sources import readers, writers
from entrygraph.streaming.incremental import run_available


def plain_fill(values):
    out, i, before = list(values), 0, 0
    while i < len(out):
        if out[i] is None:
            j = i
            while j < len(out) and out[j] is None:
                j += 1
            if j < len(out) and out[j] - (j - i) > before:
                for k in range(i, j):
                    out[k] = out[j] - (j - k)
            i = j
        if i < len(out):
            before = out[i]
            i += 1
    return out


def test_gap_fill_against_a_walk(spark):
    rng = random.Random(3)
    lists = [[40, None, 47], [61, None, None, 64], [61, None, None, None, 64], [None, 6], [None, None, 2], [9, None]]
    lists += [[rng.choice([None, rng.randint(1, 12)]) for _ in range(rng.randint(1, 9))] for _ in range(300)]
    rows = [(g, s, v) for g, values in enumerate(lists) for s, v in enumerate(values)]
    got = entries.gap_fill(spark.createDataFrame(rows, "guide_id int, seq int, value bigint").repartition(3)).orderBy("guide_id", "seq").collect()
    assert [r.filled for r in got] == [v for values in lists for v in plain_fill(values)]


def plain_ids(raws):
    """Ids in one walk: book ids are reserved before anything is inferred."""
    import re

    book = []
    for r in raws:
        m = re.search(r"(\d+)(?:\s*([A-Za-z])(?![A-Za-z]))?", r or "")
        book.append(f"R{int(m[1])}{(m[2] or '').upper()}" if m else None)
    filled = plain_fill([int(re.search(r"\d+", b)[0]) if b else None for b in book])
    taken, used, out = set(filter(None, book)), set(), []
    for n, (b, f) in enumerate(zip(book, filled)):
        guess = f"R{f}" if b is None and f is not None else None
        if b and b not in used:
            out.append((b, "book"))
        elif guess and guess not in taken and guess not in used:
            out.append((guess, "inferred"))
        else:
            out.append((f"p0001_{n + 1:02d}", "synthetic"))
        used.add(out[-1][0])
    return out


def test_ids_against_a_walk(spark):
    rng = random.Random(4)
    lists = [[rng.choice([None, "x", f"R {rng.randint(1, 8)}", f"{rng.randint(1, 8)} b"]) for _ in range(rng.randint(1, 9))] for _ in range(300)]
    rows = [(g, s, 1, s + 1, r) for g, raws in enumerate(lists) for s, r in enumerate(raws)]
    got = entries.assign_ids(spark.createDataFrame(rows, "guide_id int, seq int, page int, position int, raw_id string").repartition(3)).orderBy("guide_id", "seq").collect()
    assert [(r.id, r.id_source) for r in got] == [x for raws in lists for x in plain_ids(raws)]


ELEMENTS = [
    {"type": "node", "id": 1, "lat": 47.4, "lon": 11.0, "tags": {"name": "Alp", "natural": "peak", "ele": "2743,5 m"}},
    {"type": "way", "id": 2, "center": {"lat": 47.41, "lon": 11.01}, "tags": {"name": "Weg", "highway": "path"}},
    {"type": "way", "id": 3, "center": {"lat": 47.42, "lon": 11.02}, "tags": {"name": "Weg", "highway": "path"}},
    {"type": "relation", "id": 9, "center": {"lat": 47.42, "lon": 11.02}, "tags": {"name": "Weg", "highway": "path"}},
    {"type": "node", "id": 4, "lat": 47.0, "lon": 11.0, "tags": {"natural": "peak"}},
    {"type": "node", "id": 5, "lat": 47.3, "lon": 11.3, "tags": {"name": "Dorf", "place": "village"}},
    {"type": "node", "id": 6, "lat": 47.3, "lon": 11.301, "tags": {"name": "Wirt im Dorf", "amenity": "restaurant"}},
    {"type": "node", "id": 7, "lat": 47.6, "lon": 11.3, "tags": {"name": "Ferner Wirt", "amenity": "restaurant"}},
    {"type": "node", "id": 8, "lat": 47.7, "lon": 11.3, "tags": {"name": "ALP", "amenity": "restaurant"}},
]
TAGS = (("peak", (("natural", "peak"),)), ("settlement", (("place", "village"),)), ("path", (("highway", "path"),)))


def test_gazetteer_from_a_dump(spark, tmp_path):
    (tmp_path / "raw.json").write_text(json.dumps({"version": 0.6, "elements": ELEMENTS}))
    g = assemble.build_gazetteer(readers.elements(spark, str(tmp_path / "raw.json")), TAGS, (("hut", (("amenity", "restaurant"),)),), ["path"], 1.0)
    assert sorted((r.name, r.type, r.ele, r.osm) for r in g.collect()) == [("Alp", "peak", 2743.5, "node/1"), ("Dorf", "settlement", None, "node/5"), ("Ferner Wirt", "hut", None, "node/7"), ("Weg", "path", None, "relation/9")]


def test_guarded_admission_against_all_distances(spark):
    rng = random.Random(5)
    towns = [(f"t{i}", "settlement", rng.uniform(46, 48), rng.uniform(10, 12)) for i in range(60)]
    inns = [(f"i{i}", rng.uniform(46, 48), rng.uniform(10, 12)) for i in range(400)]
    t = spark.createDataFrame(towns, "name string, type string, lat double, lon double")
    c = spark.createDataFrame(inns, "name string, lat double, lon double")
    import math

    far = lambda a, b: math.hypot((b[2] - a[1]) * 111.32, (b[3] - a[2]) * 111.32 * math.cos(math.radians((a[1] + b[2]) / 2)))
    for km in (1.0, 12.0):
        want = {i[0] for i in inns if all(far(i, x) >= km for x in towns)}
        assert {r.name for r in gazetteer.admit_guarded(c, t, km).collect()} == want


def test_cascade_and_decisions(spark):
    """Every way an item may end, on invented names."""
    features = [("Amberkogel", "peak", 46.1, 9.0, 2410.0, "node/11"), ("Salzblickhaus", "hut", 46.1, 9.1, 1530.0, "node/12"), ("Spitz", "peak", 46.2, 9.0, None, "node/13"), ("Spitz", "peak", 46.3, 9.0, None, "way/14"), ("Lindenau", "settlement", 46.3, 9.2, None, "node/15")]
    g = spark.createDataFrame(features, "name string, type string, lat double, lon double, ele double, osm string")
    told = {
        "same name, stated height": (("Amberkogel, 2410 m", "peak", 2410.0), ("exact", "node/11")),
        "a letter short": (("Amberkoge", "peak", None), ("fuzzy", "node/11")),
        "the wrong type": (("Amberkogel", "hut", None), ("unmatched", None)),
        "written apart": (("Salzblick-Haus", "hut", None), ("exact", "node/12")),
        "two of the name, one chosen": (("Spitz", None, None), ("review", "way/14")),
        "no peak is a settlement": (("Lindenaue", "peak", None), ("unmatched", None)),
        "out of scope": (("Xylophon spielen", None, None), ("skipped", None)),
        "two of the name, put aside": (("Spitz", "peak", None), ("skipped", None)),
        "too far up": (("Amberkogel", "peak", 2461.0), ("unmatched", None)),
    }
    schema = "item_id int, seq int, entry_id string, kind string, surface string, name string, type string, elevation_m double"
    items = spark.createDataFrame([(i, i, f"E{i}", "mention", n, n, t, e) for i, ((n, t, e), _) in enumerate(told.values())], schema)
    d = spark.createDataFrame([("E4", "Spitz", None, "mention", "way/14", None), ("E7", "Spitz", "peak", "mention", "skip", None)], "entry_id string, name string, type string, kind string, decision string, note string")
    v = spark.createDataFrame([], "case_id string, pick string, reason string")
    out = assemble.match(items, g, d, v, [("xylophon", "no place")])
    got = {r.item_id: (r.method, r.chosen.osm if r.chosen else None) for r in out["resolution"].collect()}
    assert got == {i: want for i, (_, want) in enumerate(told.values())}
    assert {r.item_id for r in out["queue"].collect()} == {2, 5, 8}
    total = out["funnel"].collect()[-1]
    assert total.type is None and (total.mentions, total.exact, total.fuzzy, total.review, total.skipped, total.unmatched) == (9, 2, 1, 1, 2, 3)
    assert json.loads(out["geojson"].first().feature)["geometry"]["type"] == "Point"
    assert {r.poi_id: r.match.method for r in out["pois"].collect()}["osm-node-11"] == "exact"


def test_guides_do_not_meet(spark):
    """With a scope, items, decisions and registries of two guides stay apart."""
    g = spark.createDataFrame([("a", "Amberkogel", "peak", 1.0, 1.0, None, "node/1"), ("b", "Amberkogl", "peak", 1.0, 1.0, None, "node/2"), ("b", "Spitz", "peak", 1.0, 1.0, None, "node/3")], "guide_id string, name string, type string, lat double, lon double, ele double, osm string")
    rows = [("a", 1, "Amberkogel"), ("b", 1, "Amberkogel"), ("a", 2, "Spitz"), ("b", 2, "Spitz")]
    items = spark.createDataFrame([(guide, i, i, "E", "mention", n, n, "peak", None) for guide, i, n in rows], "guide_id string, item_id int, seq int, entry_id string, kind string, surface string, name string, type string, elevation_m double")
    d = spark.createDataFrame([], "guide_id string, entry_id string, name string, type string, kind string, decision string, note string")
    v = spark.createDataFrame([], "guide_id string, case_id string, pick string, reason string")
    out = assemble.match(items, g, d, v, [], scope=["guide_id"])
    got = {(r.guide_id, r.item_id): (r.method, r.chosen.osm if r.chosen else None) for r in out["resolution"].collect()}
    assert got == {("a", 1): ("exact", "node/1"), ("b", 1): ("fuzzy", "node/2"), ("a", 2): ("unmatched", None), ("b", 2): ("exact", "node/3")}
    assert {(r.guide_id, r.poi_id) for r in out["pois"].collect()} == {("a", "osm-node-1"), ("b", "osm-node-2"), ("b", "osm-node-3")}
    assert out["entry_pois"].count() == 3


def test_assembled_entries(spark):
    part = "guide_id string, page int, position int, kind string, entry_id_raw string, name string, start_quote string, end_quote string, place_names array<string>"
    rows = [
        ("g", 1, 1, "place", "R 10", "Alte Hütte", "Die Hütte", "im Tal.", []),
        ("g", 1, 2, "route", None, "Aufstieg", "Aufstieg von", "oben.", ["alte  HÜTTE", "Gipfel", "Nirgends"]),
        ("g", 2, 1, "traverse", "R 12", "Übergang", "fehlt", "x", []),
        ("g", 2, 2, "place", "R 10", "Gipfel", "Der Gipfel", "Der Gipfel", []),
    ]
    pages = [("g", 1, "Die Hütte liegt im Tal.\nAufstieg von R 99\nnach"), ("g", 2, "oben. Der Gipfel\n12\n")]
    out = assemble.assemble(spark.createDataFrame(rows, part), spark.createDataFrame(pages, "guide_id string, page int, text string"))
    e = {r.name: r for r in out["entries"].collect()}
    assert [e[n].id for n in ("Alte Hütte", "Aufstieg", "Übergang", "Gipfel")] == ["R10", "R11", "R12", "p0002_02"]
    assert e["Aufstieg"].destination_id == "R10" and e["Aufstieg"].place_ids == ["p0002_02"] and e["Übergang"].destination_id is None
    assert e["Aufstieg"].description == "Aufstieg von R 99 nach oben." and e["Gipfel"].description_source == "stub"
    assert [r.ref_id for r in out["dangling"].collect()] == ["R99"] and [r.place_name for r in out["unresolved_places"].collect()] == ["Nirgends"]
    assert out["contract"].columns == list(entries.CONTRACT)


def test_readers_and_writers(spark, tmp_path):
    (tmp_path / "pages").mkdir()
    (tmp_path / "pages" / "page_0001.txt").write_text("x" * 250)
    (tmp_path / "pages" / "page_0002.txt").write_text("short")
    assert {(r.page, r.is_sketch) for r in readers.pages(spark, str(tmp_path / "pages")).collect()} == {(1, False), (2, True)}
    (tmp_path / "parts").mkdir()
    (tmp_path / "parts" / "page_0003.json").write_text(json.dumps({"entries": [{"kind": "place", "name": "A"}, {"kind": "route", "name": "B"}]}))
    (tmp_path / "parts" / "page_0004.json").write_text("{broken")
    good, bad = readers.parts(spark, str(tmp_path / "parts"))
    assert sorted((r.page, r.position, r.name) for r in good.collect()) == [(3, 1, "A"), (3, 2, "B")] and [r.page for r in bad.collect()] == [4]
    (tmp_path / "lines.jsonl").write_text('{"a": 1}\n{"a": oops\n{"a": 2}\n')
    records, malformed = readers.permissive_lines(spark, str(tmp_path / "lines.jsonl"), "a int")
    assert sorted(r.a for r in records.collect()) == [1, 2] and malformed.count() == 1
    (tmp_path / "verdicts").mkdir()
    (tmp_path / "verdicts" / "c1.json").write_text('{"case_id": "c1", "pick": null, "reason": "no"}')
    assert readers.verdicts(spark, str(tmp_path / "verdicts")).collect()[0].case_id == "c1"
    (tmp_path / "verdicts" / "c2.json").write_text('{"case_id": "c3", "pick": null, "reason": "no"}')
    try:
        readers.verdicts(spark, str(tmp_path / "verdicts")).collect()
        raise AssertionError("a verdict under another's name was read")
    except Exception as e:
        assert "malformed verdict" in str(e)
    (tmp_path / "verdicts" / "c2.json").write_text('{"pick": "node/1", "reason": "its name"}')
    assert {(r.case_id, r.pick) for r in readers.verdicts(spark, str(tmp_path / "verdicts")).collect()} == {("c1", None), ("c2", "node/1")}
    for bad in ('{"case_id": "c2", "reason": "no pick"}', '{"pick": 5, "reason": "a number"}', '{"pick": null, "reason": " "}', "{cut off"):
        (tmp_path / "verdicts" / "c2.json").write_text(bad)
        with pytest.raises(Exception, match="malformed verdict"):
            readers.verdicts(spark, str(tmp_path / "verdicts")).collect()
    df = spark.createDataFrame([("g", 2, "b"), ("g", 1, "a")], "guide_id string, seq int, id string")
    writers.json_lines(df, str(tmp_path / "out"), "seq")
    assert spark.read.json(str(tmp_path / "out")).count() == 2
    assert json.loads(writers.contract_array(df, "seq").first().routes) == [{"id": "a"}, {"id": "b"}]
    writers.by_guide(df, str(tmp_path / "tab"))
    assert spark.read.parquet(str(tmp_path / "tab")).count() == 2


def test_batches_graph_and_stream(spark, tmp_path):
    units = spark.createDataFrame([("g", i) for i in range(1, 8)], "guide_id string, seq int")
    done = spark.createDataFrame([("g", 1), ("g", 4)], "guide_id string, seq int")
    number = lambda stable: [(r.seq, r.batch) for r in work.batches(units, "seq", 3, done, stable).orderBy("seq").collect()]
    assert number(True) == [(2, 1), (3, 1), (5, 2), (6, 2), (7, 3)] and number(False) == [(2, 1), (3, 1), (5, 1), (6, 2), (7, 2)]
    points = spark.createDataFrame([(1.0, 2.0)], "lon double, lat double")
    assert graph.extent(points).first().zoom == 12 and graph.extent(points.limit(0)).first().kind == "default"
    assert graph.search(spark.createDataFrame([("Alp", None), ("Berg", "hut")], "name string, t string"), ["name", "t"], " HUT").count() == 1
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"k": 1}\n{"k": 2}\n')
    seen = []
    for _ in range(2):
        run_available(spark, str(tmp_path / "in"), "k int", lambda df, n: seen.extend(r.k for r in df.collect()), str(tmp_path / "check"))
    assert sorted(seen) == [1, 2]
    assert F is not None


def test_repairs(spark):
    parts = spark.createDataFrame([(1, 1, "R 5", "A", "s", "e"), (1, 2, "R 6", "A", "s", "e")], "page int, position int, raw_id string, name string, start_quote string, end_quote string")
    repairs = spark.createDataFrame([(1, 1, "R5", "A", "new", "end"), (2, 1, None, "A", "x", "y")], "seq int, page int, entry_id string, name string, start_quote string, end_quote string")
    m = work.match_repairs(repairs, parts)
    assert {r.seq: r.position for r in m.collect()} == {1: 1, 2: None}
    assert {r.position: r.start_quote for r in work.apply_repairs(parts, m).collect()} == {1: "new", 2: "s"}


def test_published_tables(spark, tmp_path):
    """Written where a guide publishes them, read back and guarded; collections hold no row of more than one feature."""
    for name, text in {
        "entries": json.dumps([{"id": "R1", "kind": "place", "name": "A"}, {"id": "R2", "kind": "route", "description": "d", "place_ids": ["R1"]}, {"kind": "place"}, {"id": "R4", "kind": "poem"}]),
        "place_links": '{"place_id": "R1", "poi_id": "p1"}\n{broken\n{"place_id": "R1", "poi_id": "p2"}\n',
        "entry_links": '{"entry_id": "R2", "poi_id": "p2", "surface": "s"}\n',
    }.items():
        path = Path(readers.guide_paths(str(tmp_path), "g")[name])
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)
    feature = lambda i, point, ele: json.dumps({"type": "Feature", "geometry": {"type": "Point", "coordinates": point}, "properties": {"poi_id": i, "name": "n", "type": "peak", "ele": ele, "osm": "node/1", "aliases": [], "n_entries": 1}})
    rows = [("p1", feature("p1", [1.0, 2.0], 3.5)), ("p2", feature("p2", [1.0, 2.0], None)), ("p3", feature(None, [1.0, 2.0], None)), ("p4", feature("p4", [1.0], None))]
    writers.feature_collection(spark.createDataFrame(rows, "poi_id string, feature string").repartition(3), str(tmp_path / "made"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "made").glob("part-*")))
    assert [f["properties"]["poi_id"] for f in json.loads(text)["features"]] == ["p1", "p2", None, "p4"]
    with pytest.raises(Exception, match="pois.geojson"):
        readers.published(spark, str(tmp_path), "g")
    Path(readers.guide_paths(str(tmp_path), "g")["pois"]).parent.mkdir(parents=True, exist_ok=True)
    Path(readers.guide_paths(str(tmp_path), "g")["pois"]).write_text(text)
    got = readers.published(spark, str(tmp_path), "g")
    assert sorted(r.id for r in graph.valid_pois(got["pois"].withColumnRenamed("poi_id", "id").withColumn("poi_id", F.col("id")), "u/").collect()) == ["p1", "p2"]
    assert {r.id: r.description_source for r in graph.valid_entries(got["entries"]).collect()} == {"R1": "none", "R2": "sliced"}
    assert [r.poi_id for r in got["place_links"].orderBy("seq").collect()] == ["p1", "p2"] and got["entry_links"].count() == 1


def test_missing_sources(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="run extraction first"):
        readers.manifest(spark, str(tmp_path / "none.jsonl"))
    assert readers.optional_lines(spark, str(tmp_path / "none.jsonl"), "place_id string, poi_id string").count() == 0
    (tmp_path / "repairs").mkdir()
    for name, page in (("b", 2), ("a", 1)):
        (tmp_path / "repairs" / f"{name}.json").write_text(json.dumps({"entry_id": name, "source_page": page, "name": "n", "start_quote": "s", "end_quote": "e"}))
    assert [(r.entry_id, r.page) for r in readers.repairs(spark, str(tmp_path / "repairs")).orderBy("seq").collect()] == [("a", 1), ("b", 2)]


def test_landed_pages_and_images(spark, tmp_path):
    """Page texts come from files that are there already; of a page's images the largest is told, of equal ones the first."""
    pages = spark.createDataFrame([("g", 1, "text", 4, 0, 2, [30, 40], False), ("g", 2, "", 0, 90, 0, None, True)], "guide_id string, page int, text string, char_count int, rotation int, n_images int, largest_image array<int>, is_sketch boolean")
    writers.page_texts(pages, str(tmp_path / "out"))
    meta = {r.page: r for r in spark.read.json(str(tmp_path / "out" / "manifest")).collect()}
    assert meta[2].stem == "page_0002" and meta[2].largest_image is None and meta[1].largest_image == [30, 40]
    d = spark.createDataFrame([([(3, 4), (6, 2), (1, 1)],), ([],), (None,)], "i array<struct<width int, height int>>")
    assert [r.d and tuple(r.d) for r in d.select(records.largest_image(F.col("i")).alias("d")).collect()] == [(3, 4), None, None]


def test_section_maps(spark, tmp_path):
    """Equal pages pass; an empty map, unknown roles, falling pages and no traverses do not, nor does a missing file."""
    good = [("huts", "H", 3), ("traverses", "T", 9), ("peaks", "P", 9), ("back_matter", "B", 40)]

    def read(sections):
        path = tmp_path / f"{len(list(tmp_path.iterdir()))}.json"
        path.write_text(json.dumps({"sections": [dict(zip(("role", "title", "book_page"), s)) for s in sections]}))
        return readers.section_map(spark, str(path), "g")

    got = entries.section_ranges(read(good))
    assert [(r.position, r.first_page, r.last_page) for r in got.orderBy("position").collect()] == [(0, 3, 8), (1, 9, 8), (2, 9, 39), (3, 40, None)]
    block = planning.section_block(got).first().block.split("\n")
    assert block[3] == "- H (book pp. 3–8) — huts — Places (huts) and the Routes (Zugänge) filed under them."
    assert block[6].startswith("- B (book pp. 40+) — back matter") and "straddles" in block[7] and len(block) == 8
    for bad, fault in (([], "empty"), ([good[1], good[0]], "not_ascending"), ([("gipfel", "X", 1), *good], "unknown_role"), ([good[0], good[2]], "no_traverses")):
        with pytest.raises(Exception, match=f"malformed section map: g {fault}"):
            read(bad).collect()
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        readers.section_map(spark, str(tmp_path / "none.json"))


def _configuration(**more):
    facts = {"title": "T", "author": "A/B", "edition": "2nd", "year": 1999, "language": "German"}
    features = {
        "tag_map": {"peak": [["natural", "peak"]], "hut": [["tourism", "alpine_hut"], ["place", "farm"]]}, "guarded_tag_map": {"hut": [["tourism", "chalet"]]},
        "deduped_types": ["path", "water"], "settlement_exclusion_km": 1.5, "out_of_scope": [{"pattern": "gebirge$", "reason": "a range"}],
    }
    return {"id": "g", "facts": facts, "bbox": [1, 2, 3, 4], "parse-routes": {"pdf": "g.pdf", "min_text_chars": 150, "toc_pages": [5, 12]}, "fetch-pois": features} | more


def test_guide_configuration(tmp_path):
    (tmp_path / "g").mkdir()
    (tmp_path / "g" / "config.json").write_text(json.dumps(_configuration()))
    g = guides.load(str(tmp_path), "g")
    assert g.tag_map == (("peak", (("natural", "peak"),)), ("hut", (("tourism", "alpine_hut"), ("place", "farm")))) and g.guarded_tag_map == (("hut", (("tourism", "chalet"),)),)
    assert (g.bbox, g.deduped_types, g.settlement_exclusion_km, g.out_of_scope) == ((1.0, 2.0, 3.0, 4.0), ("path", "water"), 1.5, (("gebirge$", "a range"),))
    assert (g.pdf, g.min_text_chars, g.toc_stems()) == ("g.pdf", 150, ["page_0005", "page_0012"])
    assert g.facts_block() == "Guide facts for this run (the guidebook these scanned pages are from):\n- Title: T\n- Author: A/B\n- Edition: 2nd\n- Year: 1999\n- Language: German"
    assert gazetteer.query_text([p for _, ps in g.tag_map for p in ps], g.bbox).count("nwr[") == 3
    plain = guides.Guide.of("g", {"id": "g", "bbox": [1, 2, 3, 4]}, ["fetch-pois"])
    assert (plain.min_text_chars, plain.settlement_exclusion_km, plain.tag_map, plain.facts) == (200, 1.0, (), ())
    with pytest.raises(FileNotFoundError):
        guides.load(str(tmp_path), "h")


@pytest.mark.parametrize(
    "more", [{"bbox": [1]}, {"bbox": None}, {"id": "h"}, {"facts": {"title": "T"}}, {"parse-routes": {}}, {"fetch-pois": {"out_of_scope": [{"pattern": "x"}]}}]
)
def test_incomplete_configurations_are_refused(more):
    with pytest.raises(ValueError, match="guide g"):
        guides.Guide.of("g", _configuration(**more))


def test_published_yaml_is_read(tmp_path):
    pytest.importorskip("yaml")
    (tmp_path / "g").mkdir()
    text = "id: g\nbbox: [1, 2, 3, 4]\nfacts: {title: T, author: A, edition: E, year: 2011, language: German}\nparse-routes:\n  pdf: x.pdf\n  toc_pages: [6]\nfetch-pois:\n  tag_map:\n    pass: [[natural, saddle], [mountain_pass, \"yes\"]]\n"
    (tmp_path / "g" / "config.yml").write_text(text)
    g = guides.load(str(tmp_path), "g")
    assert g.tag_map == (("pass", (("natural", "saddle"), ("mountain_pass", "yes"))),) and g.toc_stems() == ["page_0006"] and dict(g.facts)["year"] == "2011"


def test_queue_whose_entry_is_gone(spark):
    queue = spark.createDataFrame([("E1", "place"), ("E2", "mention")], "entry_id string, kind string")
    there = spark.createDataFrame([("E1",)], "id string")
    assert planning.checked_queue(planning.queue_of(queue, "place"), there).count() == 1
    with pytest.raises(Exception, match="no longer an entry: E2"):
        planning.checked_queue(queue, there).collect()
