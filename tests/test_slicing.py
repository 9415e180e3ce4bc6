import random
import re

from pyspark.sql import functions as F

from entrygraph.functions import slicing
from entrygraph.operators import entries

SPACES = [" ", "  ", "\n", "\n\n", " \n", "\n ", "\t\n\t", "\r\n", "\n\r", " ", "\n ", " \n", " \n \n ", "\n 12 \n", "-\n", "- \n", "-\n 7\n"]


def flow(t):
    t = re.sub(r"(?m)^[ \t]*\d{1,4}[ \t]*$", "", t)
    return re.sub(r"^ | $", "", re.sub(r"\s+", " ", re.sub(r"-\n\s*", "", t)))


def sliced(page, after, start, end):
    """By patterns of the words with white space between, on the text as it is, then reflowed."""
    words = [re.sub(r"\s+", " ", q or "").strip(" ") for q in (start, end)]
    if not all(words):
        return None
    first, last = (r"\s+".join(map(re.escape, w.split(" "))) for w in words)
    for p, a in ((page, after), (flow(page), flow(after) if after is not None else None)):
        if len(re.findall(first, p)) != 1:
            continue
        if m := re.search(f"(?s){first}.*?{last}", p):
            return flow(m.group())
        if a and (m := re.search(f"(?s)^.*?{last}", a)):
            return flow(re.search(f"(?s){first}.*", p).group() + "\n" + m.group())
    return None


def test_places_agree_with_patterns(spark):
    draw, rows = random.Random(2), []
    words = ["ab", "c", "12", "7", "a.b", "\\E", "x-", "ä", "(d", "345"]
    text = lambda n: draw.choice(["", " ", "\n"]) + "".join(draw.choice(words) + draw.choice(SPACES) for _ in range(n))
    for i in range(2500):
        page, after = text(draw.randint(0, 14)), draw.choice([None, text(draw.randint(0, 6))])
        quote = lambda p: " ".join((p or "x").split()[(k := draw.randrange(max(1, len((p or "x").split())))) : k + draw.randint(1, 3)]) or "x"
        start = draw.choice([quote(page), quote(flow(page)), quote(page)[:2], "", None])
        end = draw.choice([quote(page), quote(after), quote(flow(page)), "no"])
        rows.append((i, page, after, start, end))
    df = spark.createDataFrame(rows, "i int, page string, after string, start string, end string")
    c = F.col
    got = {r.i: r for r in df.select("i", slicing.slice_description(c("page"), c("after"), c("start"), c("end")).alias("cut"), slicing.reflow(c("page")).alias("flow")).collect()}
    found = 0
    for i, page, after, start, end in rows:
        assert got[i].flow == flow(page)
        want = sliced(page, after, start, end)
        assert got[i].cut == want, (page, after, start, end)
        found += want is not None
    assert found > 200


def test_no_pattern_is_made_of_anchors(spark):
    e = spark.createDataFrame([("g", 1, "a", "b")], "guide_id string, page int, start_quote string, end_quote string")
    pages = spark.createDataFrame([("g", 1, "x a y b")], "guide_id string, page int, text string")
    df = entries.sliced(e, pages)
    assert df.first().description == "a y b"
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "RLIKE" not in plan and "regexp_substr" not in plan and "regexp_count" not in plan and "regexp_extract" not in plan
