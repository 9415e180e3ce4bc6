import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from entrygraph.llm import align, catalog
from tests.oracle import DATA, PRESENT

PATHS = [public_tokenizers.path(n) for n in catalog.ALIGNED]


@pytest.fixture(scope="module")
def pair():
    with open(PATHS[0], encoding="utf-8") as f, open(PATHS[1], "rb") as g:
        return align.Pair(f.read(), g.read())


def whole(pair, text):
    """(a ids, b ids, groups, linked ids) from the libraries' ids of the whole text and plain byte offsets."""
    if not text:
        return [], [], [], []
    a = pair.a.encode(" " + text, add_special_tokens=False).ids
    b = pair.b.encode(text)
    data = (" " + text).encode()
    bytes_a, bytes_b = [pair.tokens[0][i] for i in a], [pair.tokens[1][i] for i in b]
    if b"".join(bytes_a) != data or b"".join(bytes_b) != data:
        return [], [], [], []
    ends = []
    for parts in (bytes_a, bytes_b):
        at, mine = 0, []
        for p in parts:
            mine.append((at, at + len(p)))
            at += len(p)
        ends.append(mine)
    both = sorted({e for _, e in ends[0]} & {e for _, e in ends[1]})
    groups, begin = [], 0
    for e in both:
        groups.append(tuple([i for i, (x, y) in zip(ids, spans) if begin <= x and y <= e] for ids, spans in ((a, ends[0]), (b, ends[1]))))
        begin = e
    links, first = [], 0
    for i, (x, y) in zip(a, ends[0]):
        while first < len(b) and ends[1][first][1] <= x:
            first += 1
        k = first
        while k < len(b) and ends[1][k][0] < y:
            links.append((i, b[k]))
            k += 1
    return a, b, groups, links


def told(groups):
    return ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)


def check(pair, texts):
    for text, (n_a, n_b, sha, n_groups, links) in zip(texts, pair.documents(texts)):
        a, b, groups, want = whole(pair, text)
        assert (n_a, n_b, n_groups) == (len(a), len(b), len(groups)), text
        assert sha == (hashlib.sha256(told(groups).encode()).hexdigest() if a else "")
        got = [(int(x) // align.SIDE, int(x) % align.SIDE) for x in np.frombuffer(links, np.int64)]
        assert Counter(got) == Counter(want)


ODD = ["", None, " ", "  ", "a", " a ", "a  b\n c", "x\n  y", "tab\there", "<|endoftext|> <s> </s>", "▁ b", "a▁b c", "naïve façade 日本語 👩‍👩‍👧 ﬁ", "a  b  c", "\x1c x \x85 y", "end \n ", "\n", "…  …", "0123456789 " * 9, "don't we'll I'd", "\x00 nul", "a" * 3000, "\u0000", "word " * 500, "﻿bom x", "é ́"]


def test_odd_texts(pair):
    check(pair, ODD)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("aeintr .,'\n\t-19éß▁ 日<>s|"), max_size=30), max_size=4))
def test_any_text(pair, texts):
    check(pair, texts)


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=40))
def test_any_code_points(pair, text):
    check(pair, [text])


def test_bytes_of_all_byte_level_characters():
    assert sorted(align.byte_level().values()) == list(range(256))


def test_transducer_closes_groups_and_refuses_other_bytes():
    t = align.Transducer([b"ab", b"c", b"d", b"abc"], [b"a", b"bc", b"d", b"bd"])
    groups, links = t.align([0, 1, 2], [0, 1, 2])
    assert groups == [(0, 2, 0, 2), (2, 3, 2, 3)] and links == [(0, 0), (0, 1), (1, 1), (2, 2)]
    assert t.align([0, 1], [0, 3]) is None and t.align([0], [0]) is None and t.align([], []) == ([], [])


def test_nulls_repeats_other_columns_and_no_rows(spark):
    texts = [(1, "the cat sat", 5), (2, None, 6), (3, "", 7), (1, "the cat sat", 5), (None, "the dog", 8), (4, "a▁b", 9)]
    docs = spark.createDataFrame(texts, "doc_id long, text string, block long")
    rows = align.aligned(docs, *PATHS).collect()
    assert len(rows) == 6
    by = Counter((r.doc_id, r.n_a > 0, r.groups_sha256 != "") for r in rows)
    assert by == {(1, True, True): 2, (2, False, False): 1, (3, False, False): 1, (None, True, True): 1, (4, False, False): 1}
    assert align.aligned(docs.limit(0), *PATHS).count() == 0
    assert align.aligned(docs.filter("text = ''"), *PATHS).collect()[0].count_sum == 0


@pytest.mark.skipif(not PRESENT, reason="needs the driver's tables")
def test_query_against_whole_texts(spark, pair, monkeypatch):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    found = {k: whole(pair, t) for k, t in texts.items()}
    times = Counter(x for _, _, _, links in found.values() for x in links)
    top = {}
    for (_, b), n in times.items():
        top[b] = max(top.get(b, 0), n)
    rows = catalog.queries()["op11_alignment"](spark, DATA).collect()
    assert len(rows) == len(texts)
    for r in rows:
        a, b, groups, links = found[r.doc_id]
        want = (len(a), len(b), len(groups), len(links), sum(times[x] == top[x[1]] for x in links), sum(times[x] for x in links))
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum) == want
        assert r.groups_sha256 == (hashlib.sha256(told(groups).encode()).hexdigest() if a else "")
    counts = {(r.a, r.b): (r.links, r.best) for r in align.pair_counts(spark.read.parquet(f"{DATA}/documents.parquet"), *PATHS).collect()}
    assert counts == {x: (n, n == top[x[1]]) for x, n in times.items()}


def test_blocks_split_documents(spark, monkeypatch):
    keys = list(range(40))
    found = [(1, 1, "x", 1, b"") for _ in keys]
    assert align._block(3, keys, found)[:3][0] == 3
    for numbers in ([], [0], [5, 70000, 1 << 31], list(range(999))):
        assert align._unpacked(align._packed(np.array(numbers, np.int64))).tolist() == numbers
