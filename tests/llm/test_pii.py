import hashlib
import re
import time

import numpy as np
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from entrygraph.llm import pii
from tests.oracle import DATA, PRESENT


def plain(text):
    """The base spans straight from their description."""
    out = []
    for kind, pattern in (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")):
        for m in re.finditer(pattern, text):
            d = [int(c) for c in m.group() if c in "0123456789"]
            if kind == "ip" and any(len(p.lstrip("0")) > 3 or int(p.lstrip("0") or 0) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (12 <= len(d) <= 19 and sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(d[::-1])) % 10 == 0):
                continue
            if kind == "phone" and not 9 <= len(d) <= 15:
                continue
            out.append((m.start(), ("email", "ip", "card", "phone").index(kind), m.end()))
    return sorted(out)


@settings(max_examples=500, deadline=None)
@given(st.text(st.sampled_from("0123456789.+-() @aé%\n"), max_size=60))
def test_base_spans(text):
    assert pii.base_spans(text) == plain(text)


@settings(max_examples=500, deadline=None)
@given(st.text(st.sampled_from("ab1.%-@@ "), max_size=40))
def test_base_emails(text):
    assert pii.base_spans(text) == plain(text)


def test_long_runs_take_time_in_proportion():
    """Texts of a megabyte that make patterns with nested or repeated scans take the square."""
    long = 1 << 20
    for text in ("0" * 5000 + ".1.1.1", "0" * long + ".1.1.1", "1." * (long // 2), "a" * long + "(at)", "a@" * (long // 2), "a-" * (long // 2), "+" * long, "+1" + "(" * long):
        began = time.perf_counter()
        base = pii.base_spans(text)
        pii.proposed(text)
        assert time.perf_counter() - began < 10
        if text.endswith(".1.1.1") and text[0] == "0":
            assert base[0] == (0, 1, len(text))


def test_long_secrets_are_proposed_whole():
    secret = "9f" * 400
    assert (4, 4, 804) in pii.proposed("is: " + secret + " ")


@pytest.mark.skipif(not PRESENT, reason="needs the driver's tables")
def test_recall_on_the_documents():
    """All tokens that the tables hold are caught, and nothing else is added to the base spans."""
    trees, least = pii.model()
    held = added = right = 0
    for text in pq.read_table(DATA.replace("0.001", "0.01") + "/documents.parquet", columns=["text"])["text"].to_pylist():
        truth = {m.span(1) for m in re.finditer(r'token = "([0-9a-f]{40})"', text or "")}
        got = {(a, b) for a, _, b in pii.added_spans(text or "", pii.base_spans(text or ""), trees, least)}
        held, added, right = held + len(truth), added + len(got), right + len(truth & got)
    assert held > 5 and right == held and right == added


def test_trees_are_right_on_held_out_examples():
    trees, least = pii.model()
    rows = pii.invented(2000, seed=99)
    p = trees.predict(np.array([pii.describe(t, a, k, b) for t, a, k, b, _ in rows]))
    took = np.array([x >= least[r[2]] for x, r in zip(p, rows)])
    truth = np.array([r[4] for r in rows])
    assert (took & truth).sum() / took.sum() >= 0.98
    assert (took & truth).sum() / truth.sum() >= 0.7


def test_table(spark):
    text = 'Anon er.12@mail3.example.com at 10.0.0.300 or 10.0.0.3, 4111 1111 1111 1111, +1 (555) 010-9999. token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" end'
    rows = [(1, text), (1, text), (2, None), (3, ""), (None, "é" * 9 + " +49 30 1234567"), (4, "plain words only")]
    docs = spark.createDataFrame([(*r, 5) for r in rows], "doc_id long, text string, spans int")
    got = pii.find_spans(docs).collect()
    assert len(got) == 6
    for r in got:
        t = next(t for k, t in rows if k == r.doc_id) or ""
        assert r.base_sha256 == hashlib.sha256(pii.written(plain(t)).encode()).hexdigest()
        assert set(filter(None, pii.written(plain(t)).split(","))) <= set(r.spans.split(","))
    assert "secret:" in next(r.spans for r in got if r.doc_id == 1)
    clean = {r.doc_id: r.text for r in pii.redact(docs).collect()}
    assert "24be" not in clean[1] and "<email>" in clean[1] and clean[4] == "plain words only"
    assert pii.find_spans(docs.limit(0)).count() == 0


def test_redaction_carries_all_columns(spark):
    docs = spark.createDataFrame([(1, "x", "mail a.b@c.example now", 5), (2, "y", None, 6), (3, "z", "", 7), (1, "x", "mail a.b@c.example now", 5)], "doc_id long, spans string, text string, n_email int")
    got = pii.redact(docs)
    assert got.columns == docs.columns
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(1, "x", "mail <email> now", 5), (1, "x", "mail <email> now", 5), (2, "y", None, 6), (3, "z", "", 7)], key=str)
    assert pii.redact(docs.limit(0)).count() == 0
