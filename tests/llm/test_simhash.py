import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from entrygraph.llm import simhash
from tests.oracle import DATA, PRESENT

WORD = re.compile("[^\x20\x09-\x0d]+")


def plain(text, size):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(pairs):
    """component ids of (doc_id, fp) by comparing all pairs."""
    label = {i: k for i, (k, _) in enumerate(pairs)}
    changed = True
    while changed:
        changed = False
        for i, (_, x) in enumerate(pairs):
            for j, (_, y) in enumerate(pairs):
                if (x ^ y).bit_count() <= 2 and label[j] < label[i]:
                    label[i] = label[j]
                    changed = True
    return {k: label[i] for i, (k, _) in enumerate(pairs)}


def test_fingerprints():
    rng = random.Random(2)
    texts = [None, "", "  \n", "one", "A b", "a B c", "é É\x85x y\x1cz w", "a " * 40] + [" ".join(rng.choice(["the", "Of", "é", "x" * 9]) + rng.choice(["", "\t"]) for _ in range(rng.randint(1, 90))) for _ in range(60)]
    for size in (3, 5):
        assert [simhash.fingerprint(t, size) for t in texts] == [plain(t, size) for t in texts]


def test_words_two_bits_apart_share_a_codeword():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 1 << 23, 3000)
    far = words ^ (1 << rng.integers(0, 23, 3000)) ^ (1 << rng.integers(0, 23, 3000))
    for a, b in zip(simhash.codewords(words), simhash.codewords(far)):
        assert set(a[a >= 0]) & set(b[b >= 0])
    assert simhash.remainder(simhash.codewords(words)[:, 0] << 11).shape == (3000,)


def spark_classes(spark, fps):
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    table = spark.createDataFrame([(signed(f),) for f in sorted(set(fps))], "fp long")
    roots = {r.node % (1 << 64): r.root % (1 << 64) for r in simhash.components(simhash.links(table)).collect()}
    return {f: roots.get(f, f) for f in fps}


def test_links_and_components_against_all_pairs(spark):
    rng = random.Random(5)
    fps = []
    for _ in range(25):
        x = rng.getrandbits(64)
        for _ in range(6):
            fps.append(x)
            for _ in range(rng.randint(1, 3)):
                x ^= 1 << rng.randrange(64)
    dense = rng.getrandbits(64)  # more in one key than are paired
    fps += [dense ^ (1 << i) ^ (1 << j) for i in range(30, 40) for j in range(41, 50)]
    fps = sorted(set(fps), key=lambda x: x - (1 << 64) if x >> 63 else x)
    want = classes(list(enumerate(fps)))
    got = spark_classes(spark, fps)
    groups = lambda labels: sorted(sorted(i for i in labels if labels[i] == v) for v in set(labels.values()))
    assert groups({i: got[f] for i, f in enumerate(fps)}) == groups(want)


def test_table(spark):
    base = "the quick brown fox jumps over the lazy dog and runs far away from here today with much joy"
    rows = [(4, base), (2, base.upper()), (9, None), (8, ""), (3, "other words entirely stand in this text"), (3, "other words entirely stand in this text"), (None, "")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, fp string")
    got = sorted(((r.doc_id, r.component_id) for r in simhash.near_duplicates(docs, 3).collect()), key=str)
    assert got == sorted([(4, 2), (2, 2), (9, 8), (8, 8), (3, 3), (3, 3), (None, 8)], key=str)
    assert simhash.near_duplicates(docs.limit(0), 3).count() == 0


def test_near_copies_against_all_pairs(spark):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(900)]
    texts = []
    for _ in range(60):
        text = [rng.choice(words) for _ in range(rng.randint(40, 200))]
        for _ in range(4):
            texts.append(" ".join(text))
            text = list(text)
            for _ in range(rng.randint(0, max(1, len(text) // 60))):
                text[rng.randrange(len(text))] = rng.choice(words)
    texts += ["short text", "short text", "a b", "", None, "the same words " * 30, "the same words " * 31]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3])]
    docs = spark.createDataFrame([(*r, "k", i, "t", "d", 1) for i, r in enumerate(rows)], "doc_id long, text string, node string, k long, th string, _doc_id string, _th long")
    kept = simhash.keep_one(docs, 5)
    assert kept.columns == docs.columns and {(r.node, r.th, r["_doc_id"], r["_th"]) for r in kept.collect()} == {("k", "t", "d", 1)}
    sets = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} for i, t in enumerate(texts) if (w := (t or "").split())}
    label = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for i in sets:
            for j in sets:
                if label[j] > label[i] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                    label[j] = label[i]
                    changed = True
    want = sorted([i for i in sets if label[i] == i] + [i for i, t in enumerate(texts) if not (t or "").split()])
    got = sorted(r.doc_id for r in kept.collect())
    assert len(want) < 200 and got == want
    assert simhash.keep_one(docs.limit(0), 5).count() == 0


def all_pairs(sets):
    """Classes by comparing all pairs."""
    label = list(range(len(sets)))
    changed = True
    while changed:
        changed = False
        for i, x in enumerate(sets):
            for j, y in enumerate(sets):
                if label[j] > label[i] and len(x & y) >= 0.8 * len(x | y):
                    label[j], changed = label[i], True
    return label


@pytest.mark.parametrize("pairs_each", [0, 32])
def test_pivots_against_all_pairs(spark, monkeypatch, pairs_each):
    """Large blocks, taken apart over all tasks, have the classes that all pairs give."""
    monkeypatch.setattr(simhash, "BLOCK", 3)
    monkeypatch.setattr(simhash, "PAIRS_EACH", pairs_each)
    monkeypatch.setattr(simhash, "SPLIT", 7)
    rng = random.Random(21)
    words = [f"w{i}" for i in range(4000)]
    shared = [rng.choice(words) for _ in range(60)]  # a passage that unlike texts hold
    texts = []
    for g in range(12):
        base = [rng.choice(words) for _ in range(rng.randint(50, 120))] + (shared if g % 2 else [])
        for _ in range(rng.choice([2, 6, 25])):
            text = list(base)
            for _ in range(rng.randint(0, 3)):
                text[rng.randrange(len(text))] = rng.choice(words)
            texts.append(text)
    texts += [shared + [f"x{i}{k}" for k in range(rng.randint(1, 12))] for i in range(40)]
    label = all_pairs([{tuple(t[k : k + 5]) for k in range(len(t) - 4)} for t in texts])
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    assert sorted(r.doc_id for r in simhash.keep_one(docs, 5).collect()) == sorted(set(label))


def test_hot_keys_join_whole(spark):
    left = spark.createDataFrame([(1, i) for i in range(200)] + [(k, 0) for k in range(2, 30)] + [(99, 0)], "k long, x long")
    right = left.groupBy("k").count().filter("k <> 99").selectExpr("k", "k * 2 as y", "count as times")
    got = simhash.join_hot(left, right, "k", "times")
    assert got.columns == ["k", "x", "y"] and got.count() == 228 and got.filter("y <> 2 * k").count() == 0


def test_one_original_with_a_thousand_copies_unlike_each_other(spark):
    rng = random.Random(4)
    base = [f"w{i}" for i in range(300)]
    rows = [(0, " ".join(base))]
    for i in range(1, 1000):
        text = list(base)
        for k in rng.sample(range(0, 300, 6), 5):
            text[k] = f"v{i}x{k}"
        rows.append((i, " ".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert [r.doc_id for r in simhash.keep_one(docs, 5).collect()] == [0]


def test_classes_of_a_block_against_all_pairs():
    rng = random.Random(6)
    for _ in range(60):
        base = [[rng.randrange(1 << 40) for _ in range(rng.randint(1, 60))] for _ in range(4)]
        sets = [{x for x in rng.choice(base) if rng.random() < 0.93} | {rng.randrange(1 << 40) for _ in range(rng.randint(0, 4))} | {1, 2} for _ in range(50)]
        want = list(range(len(sets)))
        for _ in sets:
            for i, x in enumerate(sets):
                for j, y in enumerate(sets):
                    if len(x & y) / len(x | y) >= 0.8:
                        want[i] = want[j] = min(want[i], want[j])
        n = np.array([len(x) for x in sets])
        got = simhash.linked(n, n, np.array([h for x in sets for h in x])).tolist()
        assert got == want


def test_similar_documents_whose_sampled_shingles_differ(spark):
    rng = random.Random(11)
    rows = []
    while len(rows) < 40:
        a = [f"w{rng.randrange(10**6)}" for _ in range(46)]
        b = a[: 42 - rng.randrange(3)] + [f"x{rng.randrange(10**6)}" for _ in range(4)]
        p, q = (simhash._shingle_hashes(" ".join(t), 5) for t in (a, b))
        sampled = p[p % np.uint64(4) == 0]
        if len(set(p) & set(q)) >= 0.8 * len(set(p) | set(q)) and len(sampled) >= 4 and len(np.intersect1d(sampled, q)) < 0.5 * len(sampled):
            rows += [(len(rows), " ".join(a)), (len(rows) + 1, " ".join(b))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.doc_id for r in simhash.keep_one(docs, 5).collect()) == list(range(0, 40, 2))


@pytest.mark.skipif(not PRESENT, reason="needs the driver's tables")
def test_recall_on_the_documents(spark):
    """Documents whose id is divisible by 20 against all: every similar pair, by counting all shared shingles, has one class."""
    docs = spark.read.parquet(DATA.replace("0.001", "0.01") + "/documents.parquet")
    sets = {r.doc_id: set(simhash._shingle_hashes(r.text, 5).tolist()) for r in docs.select("doc_id", "text").collect()}
    holders = defaultdict(list)
    for k, x in sets.items():
        for h in x:
            holders[h].append(k)
    root = {r.doc_id: r.root for r in simhash.near_copies(docs, 5).collect()}
    links = found = 0
    for k in (k for k in sets if k % 20 == 0 and sets[k]):
        shared = Counter(j for h in sets[k] for j in holders[h])
        for j, n in shared.items():
            if j != k and n >= 0.8 * (len(sets[k]) + len(sets[j]) - n):
                links, found = links + 1, found + (root[j] == root[k])
    assert links and found == links


def test_near_copies_begin_with_golay_keys(spark, monkeypatch):
    """Fingerprints link copies first, checked on the sets; what they miss is found by shingles, and classes are whole."""
    rng = random.Random(21)
    texts = []
    for _ in range(12):
        base = [f"w{rng.randrange(5000)}" for _ in range(400)]
        texts += [" ".join(base), " ".join([*base[:-1], "end"]), " ".join([*base[:390], *(f"x{rng.randrange(5000)}" for _ in range(10))])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    asked, own = [], simhash._by_fingerprints
    monkeypatch.setattr(simhash, "_by_fingerprints", lambda *a: asked.append(own(*a)) or asked[-1])
    got = {r.doc_id: r.root for r in simhash.near_copies(docs, 5).collect()}
    assert len({got[i] for i in range(36)}) == 12 and all(got[i] == got[i - i % 3] for i in range(36))
    assert asked[0].count() >= 12
    # a seed joins sets at once
    n, lengths, held = np.array([3, 3, 3]), np.array([0, 0, 0]), np.zeros(0, np.int64)
    assert simhash.linked(n, lengths, held, np.array([7, 5, 7])).tolist() == [0, 1, 0] and simhash.linked(n, lengths, held).tolist() == [0, 1, 2]


def test_hot_join_sends_nothing_without_hot_keys(spark):
    """The driver builds no table to send where no key is hot; where one is, rows are the same."""
    left = spark.range(300).selectExpr("id", "id % 100 as k")
    few, hot = spark.range(100).selectExpr("id as k", "3L as n", "-id as v"), spark.range(100).selectExpr("id as k", "if(id = 5, 64L, 3L) as n", "-id as v")
    plans = [(df := simhash.join_hot(left, right, "k", "n"))._jdf.queryExecution().optimizedPlan().toString() for right in (few, hot)]
    assert "broadcast" not in plans[0] and "broadcast" in plans[1]
    assert all(sorted(map(tuple, simhash.join_hot(left, right, "k", "n").select("id", "v").collect())) == [(i, -(i % 100)) for i in range(300)] for right in (few, hot))


def test_chains_of_seeds_are_one_class(spark, monkeypatch):
    """Each document is linked to the next only: seeds differ along the chain, the class is whole in both forms, without rounds of components for seeds."""
    rng = random.Random(5)
    words = [f"w{rng.randrange(9000)}" for _ in range(400)]
    docs = []
    for k in range(8):
        docs.append((k, " ".join(words)))
        words = words[16:] + [f"w{rng.randrange(9000)}" for _ in range(16)]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    # whatever the fingerprints, neighbours are said to link
    monkeypatch.setattr(simhash, "links", lambda fps: fps.select(simhash.F.col("fp").alias("a")).crossJoin(fps.select(simhash.F.col("fp").alias("b"))).filter("a < b"))
    own, seen = simhash._by_fingerprints, []
    monkeypatch.setattr(simhash, "_by_fingerprints", lambda *a: seen.append(own(*a)) or seen[-1])
    for block in (simhash.BLOCK, 2):
        monkeypatch.setattr(simhash, "BLOCK", block)
        assert len({r.root for r in simhash.near_copies(table, 5).collect()}) == 1
    assert seen[0].select("root").distinct().count() > 1
