import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

from entrygraph.llm import lm

WORD = re.compile("[^\x20\x09-\x0d]+")


def plain(rows):
    low = lambda t: "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
    split = [(k, zlib.crc32(b"" if k is None else str(k).encode()) % 7 == 2, [*WORD.findall(low(t)), "\n"]) for k, t in rows]
    c = Counter(w for _, held, ws in split if not held for w in ws)
    n, v = sum(c.values()), len(c)
    return [(k, held, len(ws), sum(c[w] > 0 for w in ws), n, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws)) for k, held, ws in split]


def rows_of(seed, n):
    rng = random.Random(seed)
    syllables = ["an", "er", "th", "on", "é", "sch", "ó"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 3)))
    return [(i, " ".join(rng.choice(["The", "of", word(), word()]) for _ in range(rng.randint(5, 60)))) for i in range(n)]


def test_base_scores_and_gain_on_held_out(spark, monkeypatch):
    monkeypatch.setattr(lm, "HEAD", 50)  # so that most words count as rare
    monkeypatch.setattr(lm, "FREQUENT", 300)  # and most windows
    rows = rows_of(1, 700) + [(3, None), (None, ""), (None, "x y\x85z"), (8, "same text"), (8, "same text"), (5, "w" * 70000)]
    docs = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, score double").repartition(3)
    got = lm.score_texts(docs).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[2], round(r[5], 6))
    have = sorted([(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got], key=key)
    want = sorted(plain(rows), key=key)
    assert [h[:5] for h in have] == [w[:5] for w in want]
    assert np.allclose([h[5] for h in have], [w[5] for w in want])
    held = [r for r in got if r.held_out and r.n_tokens > 3]
    # fewer bits than bytes by their frequencies alone take
    data = Counter(b for r in rows for b in (r[1] or "").lower().encode())
    entropy = -sum(n / data.total() * math.log2(n / data.total()) for n in data.values())
    assert sum(r.bits_per_byte * r.n_tokens for r in held) / sum(r.n_tokens for r in held) < 0.9 * entropy
    assert all(r.score < 0 for r in got)


def test_scores_do_not_depend_on_partitioning(spark):
    rows = rows_of(2, 200)
    a = {r.doc_id: r.score for r in lm.score_texts(spark.createDataFrame(rows, "doc_id long, text string").repartition(1)).collect()}
    other = sorted(rows, key=lambda r: r[1])
    b = {r.doc_id: r.score for r in lm.score_texts(spark.createDataFrame(other, "doc_id long, text string").repartition(7)).collect()}
    assert len(a) == 200 and all(math.isclose(a[k], b[k], rel_tol=1e-6) for k in a)


def keys_of(text):
    return lm.windows([text])[0]


def test_windows_and_pieces(monkeypatch):
    monkeypatch.setattr(lm, "PIECE", 50)
    texts = [b"", b"a", b"some words " * 3, b"a longer text of many words " * 20]
    words = [t.split() for t in texts]
    want = [[int.from_bytes((b"\n" * 6 + t)[i : i + 6][::-1] + t[i : i + 1]) for i in range(len(t))] for t in (b" ".join(w) + b"\n" for w in words)]
    got = [[] for _ in texts]
    for keys, owner in lm.window_runs(words, 50):
        for k, i in zip(keys.tolist(), owner.tolist()):
            got[i].append(k)
    assert got == want


def counted_windows(seed):
    rng = random.Random(seed)
    text = b"".join(rng.choice([b"the ", b"then ", b"of ", b"often ", b"on "]) for _ in range(800))
    return np.unique(keys_of(text), return_counts=True)


def test_costs_against_plain_contexts():
    """Counts by context, kept in dictionaries, give the same costs as those of sorted windows."""
    keys, counts = counted_windows(3)
    pairs, at = np.unique((keys >> np.uint64(40)) << np.uint64(8) | keys & np.uint64(255), return_inverse=True)
    near = lm.Near(pairs.astype(np.int64), np.bincount(at, counts).astype(np.int64))
    mixer = lm.Mixer()
    rng = np.random.default_rng(1)
    mixer.settle(rng.uniform(0, 0.6, mixer.weights.shape), rng.integers(0, 30, mixer.hits.shape).astype(float))
    sides, seen = defaultdict(lambda: [0, 0]), Counter()
    path = lambda s: [(int(near.tree.node[s, d]), int(near.tree.bit[s, d])) for d in range(near.tree.depth[s])]
    for k, n in zip(keys.tolist(), counts.tolist()):
        for order in lm.ORDERS:
            context = order, k >> 56 - 8 * order
            seen[context] += n
            for node, bit in path(k & 255):
                sides[context, node][bit] += n
    asked = np.unique(np.concatenate([keys, keys_of(b"they often thought of onions"), keys ^ np.uint64(1 << 40)]))
    got = lm.window_costs(near, mixer, keys, counts, asked)
    for k, cost in zip(asked.tolist(), got.tolist()):
        grade = lambda o: sum(seen[o, k >> 56 - 8 * o] >= x for x in (2, 16, 256))  # noqa: B023, E731
        gate, total = grade(4) * 4 + grade(6), 0.0
        for node, bit in path(k & 255):
            odds = 0.0
            for i, o in enumerate(lm.ORDERS):
                zeros, ones = sides[(o, k >> 56 - 8 * o), node]
                odds += mixer.weights[i, gate] * math.log((ones + 0.4) / (zeros + 0.4))
            odds = min(8.0, max(-8.0, odds))
            refined = (odds + float(mixer.map[node, round((odds + 8) * 2)])) / 2
            total += math.log10(1 / (1 + math.exp(-refined if bit else refined)))
        assert math.isclose(cost, total, rel_tol=0.02, abs_tol=2e-3)


def test_bytes_after_a_context_sum_to_one():
    keys, counts = counted_windows(4)
    pairs, at = np.unique((keys >> np.uint64(40)) << np.uint64(8) | keys & np.uint64(255), return_inverse=True)
    near = lm.Near(pairs.astype(np.int64), np.bincount(at, counts).astype(np.int64))
    for context in (keys[0], keys[7], np.uint64(0x61626364656600)):
        every = (context >> np.uint64(8) << np.uint64(8)) | np.arange(256, dtype=np.uint64)
        assert math.isclose(float((10 ** lm.window_costs(near, lm.Mixer(), keys, counts, every)).sum()), 1, rel_tol=1e-4)


def test_known_windows():
    rng = np.random.default_rng(2)
    keys = np.unique(rng.integers(0, 1 << 56, 5000, np.uint64))
    costs = rng.random(len(keys)).astype(np.float32)
    table = lm.Known(keys, costs)
    got, miss = table.look_up(np.append(keys, keys + np.uint64(1 << 57)))
    found = np.setdiff1d(np.arange(len(keys)), miss)
    assert len(found) > 0.95 * len(keys) and (got[found] == costs[found]).all() and set(range(len(keys), 2 * len(keys))) <= set(miss.tolist())
    assert lm.Known(keys[:0], costs[:0]).look_up(keys)[1].tolist() == list(range(len(keys)))


def test_empty(spark):
    assert lm.score_texts(spark.createDataFrame([], "doc_id long, text string")).count() == 0
