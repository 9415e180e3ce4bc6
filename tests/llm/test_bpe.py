import base64
import hashlib

import public_tokenizers as P
import pyarrow.parquet as pq
import pytest
import regex
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from entrygraph.llm import bpe
from tests.oracle import DATA

PATH = P.path("byte_bpe_multi_50k.tiktoken")
RANKS = bpe.read_ranks(PATH)
ENCODER = bpe.Encoder(RANKS)
ORACLE = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})
ALPHABET = st.sampled_from(list("aZstdmrevl'  \n\t\r\x0b\x1c 5²é漢ß.!#😀́ ")) | st.characters(blacklist_categories=["Cs", "Cn"], max_codepoint=0x2FFF)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(ALPHABET, max_size=30), max_size=5))
def test_slices_are_the_matches_of_the_pattern(texts):
    assert bpe.slices(texts) == [regex.findall(P.PATTERN, t) for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.text(ALPHABET, max_size=40))
def test_ids_are_those_of_the_library(text):
    encoder, decoder = ENCODER, bpe.Decoder(RANKS)
    encoder.clear()
    parts = [encoder[p] for p in bpe.slices([text])[0]]
    ids = [int(x) for p in parts for x in p.split(",")]
    assert ids == ORACLE.encode_ordinary(text)
    assert b"".join(decoder[p] for p in parts) == text.encode()


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(ALPHABET, max_size=30), max_size=12))
def test_slices_merged_at_once(texts):
    split = bpe.slices(texts)
    ENCODER.clear()
    ENCODER.learn(split)
    for text, parts in zip(texts, split):
        assert [int(x) for p in parts for x in ENCODER[p].split(",")] == ORACLE.encode_ordinary(text)
    assert set(ENCODER) >= {p for parts in split for p in parts if len(p.encode()) < bpe.Encoder.WIDE}


def test_words_of_the_documents_merge_alike():
    words = list(dict.fromkeys(w for t in pq.read_table(DATA + "/documents.parquet", columns=["text"])["text"].to_pylist() for p in bpe.slices([t or ""]) for w in p))
    ENCODER.clear()
    ENCODER.learn([words])
    assert all(ENCODER[w] == ",".join(map(str, ORACLE.encode_ordinary(w))) for w in words)


def test_long_slices_merge_alike():
    encoder = bpe.Encoder(RANKS)
    for part in ("ab" * 700, "x" * 1001, "donaudampfschiff" * 90):
        assert encoder.merge(part.encode()) == ORACLE.encode_ordinary(part)


def test_table(spark):
    rows = [(1, None), (2, ""), (3, "It's  a\n\n test's"), (3, "It's  a\n\n test's"), (None, "x" * 5000), (9, "  ")]
    docs = spark.createDataFrame([(*r, "extra") for r in rows], "doc_id long, text string, n_tokens string")
    got = sorted(map(tuple, bpe.encode_documents(docs, PATH).collect()), key=str)
    want = []
    for k, t in rows:
        ids = ORACLE.encode_ordinary(t or "")
        want.append((k, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want, key=str)
    assert bpe.encode_documents(docs.limit(0), PATH).count() == 0


def test_ranks_file_is_read_whole():
    assert len(RANKS) == sum(1 for _ in open(PATH, "rb")) and base64.b64encode(next(iter(RANKS)))


def test_offsets_and_decoding(spark):
    texts = ["It's  a\n\n test's é漢字😀 end", "", "x" * 300 + " 12", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    coded = bpe.encode_documents(docs, PATH, with_offsets=True)
    for r in coded.collect():
        parts = regex.findall(P.PATTERN, texts[r.doc_id] or "")
        assert r.starts == [sum(map(len, parts[:i])) for i in range(len(parts))] and len(r.ends) == len(parts)
        assert [r.ids[a:b] for a, b in zip([0, *r.ends], r.ends)] == [ORACLE.encode_ordinary(p) for p in parts]
    for form in (coded, coded.drop("starts", "ends")):
        assert {r.doc_id: r.text for r in bpe.decode_documents(form, PATH).collect()} == {i: t or "" for i, t in enumerate(texts)}
    moved = coded.filter("doc_id = 0").selectExpr("doc_id", "ids", "transform(starts, x -> x + 1) as starts", "ends")
    with pytest.raises(Exception, match="decodes to begin"):
        bpe.decode_documents(moved, PATH).collect()
