import hashlib
import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from entrygraph.llm import catalog, periods
from tests.oracle import DATA, PRESENT


def brute(words, least=6, exponent=4):
    """All maximal intervals of each period, kept where the period is the interval's smallest."""
    n, found = len(words), {}
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, exponent * q):
                found.setdefault((i, j + q), q)
            i = j
    return sorted([(i, j - i, q) for (i, j), q in found.items()], key=lambda r: (r[0], r[2]))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=60))
def test_small_alphabets(words):
    assert periods.runs_of(words) == brute(words)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=6), st.integers(1, 9)), max_size=6))
def test_powers_side_by_side(parts):
    words = [x for part, times in parts for x in part * times]
    assert periods.runs_of(words) == brute(words)
    assert periods.runs_of(words, 4, 3) == brute(words, 4, 3)


def test_long_periods_and_many_words():
    draw = random.Random(5)
    base = [draw.randrange(5000) for _ in range(700)]
    words = base[:100] + (base * 5)[:3100] + ["x"] * 9 + base[:50]
    assert periods.runs_of(words) == brute(words)
    assert (periods.runs_of(words)[0][2]) == 700


def test_few_periods_are_refused():
    with pytest.raises(ValueError):
        periods.runs_of([1] * 10, 6, 2)


def test_collapse_keeps_the_first_period(spark):
    text = "start " + "a b " * 5 + "end"
    docs = spark.createDataFrame([(1, text, "m"), (2, None, "n"), (3, "", "o"), (4, text, "p"), (5, "one  two", "q")], "doc_id long, text string, start string")
    got = {r.doc_id: (r.text, r.start) for r in periods.collapse(docs).collect()}
    assert got == {1: ("start a b end", "m"), 2: (None, "n"), 3: ("", "o"), 4: ("start a b end", "p"), 5: ("one  two", "q")}
    assert sorted(map(tuple, periods.all_runs(docs).collect())) == [(1, 1, 10, 2), (4, 1, 10, 2)]
    rows = {r.doc_id: r for r in periods.run_report(docs).collect()}
    assert rows[2].n_runs == 0 and rows[2].start is None and rows[2].exponent_milli is None
    assert rows[2].runs_sha256 == rows[2].collapsed_sha256 == hashlib.sha256(b"").hexdigest()
    assert (rows[1].start, rows[1].length, rows[1].period, rows[1].exponent_milli) == (1, 10, 2, 5000)
    assert periods.run_report(docs.limit(0)).count() == 0


def test_ties_go_to_the_smallest_start():
    words = [*("a " * 8).encode().split(), b"x", *("b " * 8).encode().split()]
    assert periods.summary(words)[2:5] == (0, 8, 1)


@pytest.mark.skipif(not PRESENT, reason="needs the driver's tables")
def test_query_against_brute_force(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    rows = catalog.queries()["op12_periodic_runs"](spark, DATA).collect()
    assert len(rows) == len(texts)
    seen = 0
    for r in rows:
        words = (texts[r.doc_id] or "").encode().split()
        h, n = zlib.crc32(str(r.doc_id).encode()), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        if n > 3000:
            continue
        want = brute(words)
        dropped = {k for i, m, q in want for k in range(i + q, i + m)}
        assert r.n_runs == len(want)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{i},{m},{q}\n" for i, m, q in want).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(b" ".join(w for k, w in enumerate(words) if k not in dropped)).hexdigest()
        seen += len(want)
    assert seen > 10
