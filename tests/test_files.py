import io
import json
import os
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Observation
from pyspark.sql import functions as F

from entrygraph.operators import gazetteer, matching, work
from entrygraph.sources import dump, files, readers, writers

ODD = ['{"type":"node","id":1,', "a\\b", 'quote " and {', "ü 日 𝄞", "", ' {"type": "way", "id": 5}']


def element(draw, i):
    e = {"type": draw.choice(["node", "way", "relation"]), "id": i}
    if draw.random() < 0.7:
        e |= {"lat": 47.0 + i / 1000, "lon": 11}
    if draw.random() < 0.3:
        e["center"] = {"lat": 1.5, "lon": 2.5}
    if draw.random() < 0.8:
        e["tags"] = {"name": draw.choice(ODD) + str(i), "natural": "peak", draw.choice(ODD) or "k": draw.choice(ODD)}
    if draw.random() < 0.3:
        e["members"] = [{"type": "way", "ref": 3, "role": "id"}]
    return e


def document(elements, indent):
    return json.dumps({"version": 0.6, "osm3s": {"type": "x"}, "elements": elements}, indent=indent, ensure_ascii=False, separators=None if indent else (",", ":")).encode()


@settings(max_examples=120, deadline=None)
@given(st.integers(0, 10**6), st.integers(0, 12), st.sampled_from([None, 1, 2]), st.integers(1, 400), st.integers(1, 300))
def test_splits_at_any_place_give_all_elements_once(seed, n, indent, split, chunk):
    draw = random.Random(seed)
    elements = [element(draw, i) for i in range(n)]
    data = document(elements, indent)
    got = [dump.parsed(x)[0] for i in range(0, len(data), split) for x in dump.split_elements(io.BytesIO(data), i, min(i + split, len(data)), chunk)]
    assert [(r[0], r[1]) for r in got] == [(e["type"], e["id"]) for e in elements]
    assert [r[5] for r in got] == [e.get("tags") for e in elements]


def test_dump_is_read_by_several_tasks(spark, tmp_path):
    draw = random.Random(1)
    elements = [element(draw, i) for i in range(3000)]
    path = tmp_path / "raw.json"
    path.write_bytes(document(elements, 2))
    df = dump.elements(spark, str(path), 20_000)
    assert df.rdd.getNumPartitions() == -(-path.stat().st_size // 20_000) > 10
    rows = {r.id: r for r in df.collect()}
    assert len(rows) == 3000 and all(rows[e["id"]].tags == e.get("tags") and rows[e["id"]].lat == e.get("lat") for e in elements)
    whole = spark.read.schema("elements array<struct<" + dump.ELEMENT.replace("type string", "type: string").replace("id bigint", "id: bigint").replace("lat double, lon double, center", "lat: double, lon: double, center:").replace("tags map", "tags: map") + ">>").option("multiLine", True).json(str(path))
    tags, guarded = (("peak", (("natural", "peak"),)),), ()
    one = gazetteer.parse_elements(whole, tags, guarded)
    split = gazetteer.parse_elements(df.select(F.array(F.struct(*df.columns)).alias("elements")), tags, guarded)
    assert sorted(map(tuple, split.collect()), key=str) == sorted(map(tuple, one.collect()), key=str)
    assert one.count() > 500


@pytest.mark.parametrize("data", [b'{"elements": []}', b'{"elements":[{"type":"node","id":1}]}', b'{"elements":[{"type":"node","id":1}], "end": 1}'])
def test_small_dumps(spark, tmp_path, data):
    (tmp_path / "d.json").write_bytes(data)
    assert dump.elements(spark, str(tmp_path / "d.json")).count() == data.count(b"node")


@pytest.mark.parametrize("data", [b'{"elements":[{"type":"node","id":1}', b'{"elements":[{"type":"node","id":1},', b'{"elements":[{"type":"node","id":1,"lat":', b'{"elements":[{"type":"node","id":1} {"type":"node","id":2}]}', b"", b'{"elements": ['])
def test_broken_dumps_end_the_read(spark, tmp_path, data):
    (tmp_path / "d.json").write_bytes(data)
    with pytest.raises(Exception, match="cut short|malformed|JSONDecodeError"):
        dump.elements(spark, str(tmp_path / "d.json")).collect()


def test_missing_dump(spark, tmp_path):
    with pytest.raises(Exception, match="run the download first"):
        dump.elements(spark, str(tmp_path / "none.json")).collect()


def listed(folder):
    return {p.name: p.read_text(encoding="utf-8") for p in folder.iterdir()}


def test_folder_is_rebuilt_without_stale_files(spark, tmp_path):
    out = tmp_path / "entries"
    rows = lambda ids: spark.createDataFrame([(f"R{i}.json", json.dumps({"id": f"R{i}", "name": "ü"})) for i in ids], "name string, value string").repartition(3)
    files.named_files(rows(range(20)), str(out), indent=2)
    assert len(listed(out)) == 20 and listed(out)["R3.json"] == '{\n  "id": "R3",\n  "name": "ü"\n}\n'
    files.named_files(rows([3, 99]), str(out))
    assert sorted(listed(out)) == ["R3.json", "R99.json"] and list(tmp_path.iterdir()) == [out]
    files.named_files(rows([]), str(out))
    assert listed(out) == {}


def test_failed_write_leaves_the_folder(spark, tmp_path):
    out = tmp_path / "entries"
    good = spark.createDataFrame([("a", "1")], "name string, value string")
    files.named_files(good, str(out))
    bad = spark.range(40).select(F.concat(F.lit("f"), F.col("id").cast("string")).alias("name"), F.when(F.col("id") < 39, "x").otherwise(F.raise_error(F.lit("broken row"))).cast("string").alias("value"))
    for df, why in ((bad, "broken row"), (good.union(good), "two rows for one file"), (spark.createDataFrame([("../x", "1")], "name string, value string"), "no name of a file")):
        with pytest.raises(Exception, match=why):
            files.named_files(df, str(out))
        assert listed(out) == {"a": "1"}
    files.named_files(spark.createDataFrame([("b", "2")], "name string, value string"), str(out), "append")
    assert listed(out) == {"a": "1", "b": "2"}


def test_only_changed_parts_are_rewritten(spark, tmp_path):
    folder = tmp_path / "parts"
    folder.mkdir()
    for page in range(1, 7):
        entries = [{"kind": "route", "entry_id_raw": str(10 * page + k), "name": f"E{k}", "start_quote": "a", "end_quote": "b", "own": {"k": None}} for k in range(3)]
        (folder / f"page_{page:04d}.json").write_text(json.dumps({"entries": entries, "note": "ü"}, ensure_ascii=False, indent=1), encoding="utf-8")
        os.utime(folder / f"page_{page:04d}.json", (1000, 1000))
    before = listed(folder)
    rows = [(1, 2, "R21", "x", "s1", "e1"), (2, 2, "R21", "x", "s2", "e2"), (3, 4, "R0", "E2", "s3", "e3"), (4, 5, "R99", "none", "s", "e"), (5, 9, "R91", "E1", "s", "e"), (6, 6, "R62", "E2", "", "ü")]
    repairs = spark.createDataFrame(rows, "seq int, page int, entry_id string, name string, start_quote string, end_quote string")
    parts, _ = readers.parts(spark, str(folder))
    parts = parts.withColumnRenamed("entry_id_raw", "raw_id")
    parts = spark.createDataFrame(parts.collect(), parts.schema)  # as they were before
    matched = work.match_repairs(repairs, parts)
    applied, skipped = writers.rewrite_parts(spark, str(folder), matched)
    assert sorted(r.seq for r in applied.collect()) == [1, 2, 3, 6] and sorted(r.entry_id for r in skipped.collect()) == ["R91", "R99"]
    after = listed(folder)
    changed = {n for n in after if after[n] != before[n]}
    assert changed == {"page_0002.json", "page_0004.json", "page_0006.json"} and sorted(after) == sorted(before)
    assert all((folder / n).stat().st_mtime == 1000 for n in set(before) - changed)
    two = json.loads(after["page_0002.json"])
    assert (two["entries"][1]["start_quote"], two["entries"][1]["own"], two["note"]) == ("s2", {"k": None}, "ü")
    want = {(r.page, r.position): (r.start_quote, r.end_quote) for r in work.apply_repairs(parts, matched).collect()}
    assert {(r.page, r.position): (r.start_quote, r.end_quote) for r in readers.parts(spark, str(folder))[0].collect()} == want
    writers.rewrite_parts(spark, str(folder), matched.filter("seq > 99"))
    assert listed(folder) == after


def test_entry_files(spark, tmp_path):
    e = spark.createDataFrame([("R1", "ü", None), ("R2", "b", "x")], "id string, name string, peak string")
    writers.entry_files(e, str(tmp_path / "entries"))
    assert listed(tmp_path / "entries")["R1.json"] == '{\n  "id": "R1",\n  "name": "ü",\n  "peak": null\n}\n'
    writers.entry_files(e.filter("id = 'R2'"), str(tmp_path / "entries"))
    assert list(listed(tmp_path / "entries")) == ["R2.json"]


def test_counts_come_from_the_same_scan(spark, tmp_path):
    (tmp_path / "l.jsonl").write_text('{"a": 1}\n\n{"a": \n{"a": 2}\n  \nx\n')
    watch = Observation("lines")
    good, bad = readers.permissive_lines(spark, str(tmp_path / "l.jsonl"), "a int", watch)
    assert sorted(r.a for r in good.collect()) == [1, 2]
    assert watch.get == {"n_lines": 6, "n_blank": 2, "n_bad": 2} and [r.line for r in bad.collect()] == ['{"a": ', "x"]
    rows = spark.createDataFrame([('{"a": 5}',), (" ",), (None,), ("{",), ("7",)], "line string")
    watch = Observation("rows")
    assert [r.record.a for r in readers.parsed_lines(rows, "line", "a int", watch).collect()] == [5]
    assert watch.get == {"n_lines": 5, "n_blank": 2, "n_bad": 2}
    (tmp_path / "parts").mkdir()
    for page, text in ((1, '{"entries": [{"name": "A"}, {"name": "B"}]}'), (2, '{"entries": ['), (3, '{"entries": []}')):
        (tmp_path / "parts" / f"page_{page:04d}.json").write_text(text)
    watch = Observation("parts")
    found, corrupt = readers.parts(spark, str(tmp_path / "parts"), watch)
    assert sorted((r.page, r.position, r.name) for r in found.collect()) == [(1, 1, "A"), (1, 2, "B")]
    assert watch.get == {"n_files": 3, "n_corrupt": 1} and [r.page for r in corrupt.collect()] == [2]


def test_only_a_missing_file_counts_as_missing(spark, tmp_path):
    (tmp_path / "l.jsonl").write_text("{}\n")
    assert readers.optional_lines(spark, str(tmp_path / "none.jsonl"), "a int").count() == 0
    for read in (lambda: readers.optional_lines(spark, str(tmp_path / "l.jsonl"), "a nothing"), lambda: readers.needed(spark, str(tmp_path / "l.jsonl"), "a nothing", "x")):
        with pytest.raises(Exception) as e:
            read()
        assert not isinstance(e.value, FileNotFoundError)


def test_guides_manifest(spark, tmp_path):
    good = {"id": "b", "name": "B", "label": "L", "bbox": [1, 2.5, 3, 4]}
    bad = [{**good, "name": " "}, {**good, "bbox": [1, 2, 3]}, {**good, "bbox": [1, 2, 3, "x"]}, {k: v for k, v in good.items() if k != "id"}, {**good, "bbox": None}]
    (tmp_path / "guides.json").write_text(json.dumps([bad[0], good, *bad[1:], {**good, "id": "a"}], indent=1))
    got = readers.guides_manifest(spark, str(tmp_path / "guides.json")).orderBy("seq").collect()
    assert [(r.id, r.bbox) for r in got] == [("b", [1.0, 2.5, 3.0, 4.0]), ("a", [1.0, 2.5, 3.0, 4.0])]
    with pytest.raises(FileNotFoundError, match="no guides manifest"):
        readers.guides_manifest(spark, str(tmp_path / "none.json"))


def test_unmatched_records_leave_optional_keys_out(spark):
    rows = [(1, "unmatched", "R1", "S, 5 m", "S", None, "mention", None, None, None, None), (2, "skipped", "R2", "T", "T", "hut", "place", 900.5, "review", None, None), (3, "unmatched", "R3", "U", 'U "q"', None, "mention", None, None, None, "no such"), (4, "exact", "R4", "V", "V", None, "mention", None, None, None, None)]
    r = spark.createDataFrame(rows, "item_id int, method string, entry_id string, surface string, name string, type string, kind string, elevation_m double, skipped_by string, skip_reason string, llm_reason string")
    got = {x.item_id: json.loads(x.record) for x in matching.unmatched_records(r).collect()}
    assert got == {
        1: {"entry_id": "R1", "mention": "S, 5 m", "name": "S", "type": None, "kind": "mention", "elevation_m": None},
        2: {"entry_id": "R2", "mention": "T", "name": "T", "type": "hut", "kind": "place", "elevation_m": 900.5, "skipped_by": "review"},
        3: {"entry_id": "R3", "mention": "U", "name": 'U "q"', "type": None, "kind": "mention", "elevation_m": None, "llm_reason": "no such"},
    }
