import random
import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from entrygraph.llm import quality

WORD = re.compile("[^\x20\x09-\x0d]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    c = Counter(windows)
    in_twice = {i + k for i, w in enumerate(windows) if c[w] > 1 for k in range(3)}
    lines = text.split("\n")
    dup = sum(1 for i, x in enumerate(lines) if WORD.search(x) and x in lines[:i])
    return len(words), sum(map(len, words)), sum(ch in "#*$%&|<>" for ch in text), dup, len(in_twice)


@settings(max_examples=400, deadline=None)
@given(st.text(st.sampled_from("ab é\t\x0b\x85\x1c#|\n"), max_size=60))
def test_features(text):
    assert quality.features(text)[:5] == plain(text)


def made(n=400, seed=6):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice(["an", "er", "th", "on"]) for _ in range(rng.randint(1, 3)))
    rows = []
    for i in range(n):
        words = [word() for _ in range(rng.randint(90, 200))]
        kind = rng.choice(["good"] * 8 + ["symbols", "shout"])
        if kind == "symbols":
            words = [w + "###" for w in words]
        if kind == "shout":
            words = [w.upper() + "!!" for w in words[:20]] * 4
        rows.append((i, " ".join(words) + ".", kind))
    return rows


def test_votes_tell_good_from_bad_without_labels(spark):
    rows = made()
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    kept = {r.doc_id for r in quality.score_quality(docs).collect() if r.kept}
    assert sum((k in kept) == (kind == "good") for k, _, kind in rows) >= 0.97 * len(rows)
    same = quality.keep_good(docs)
    assert same.columns == docs.columns and {r.doc_id for r in same.collect()} == kept


def test_defined_cases(spark):
    rows = [(1, None), (2, ""), (None, "w " * 60), (3, "few words"), (3, "few words"), (4, " ".join(f"w{i}" for i in range(120)))]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, n_words int")
    got = quality.score_quality(docs).collect()
    assert sorted((r.base_failed for r in got), key=str) == [False, True, True, True, True, True]
    assert quality.score_quality(docs.limit(0)).count() == 0 and quality.keep_good(docs.limit(0)).count() == 0
