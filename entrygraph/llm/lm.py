"""Language-model scores: a base unigram model and logistic context mixing.

A text is taken as its lower-case words, each closed by a blank and the last by
a line end. The mixing model codes each byte as the path to its leaf in a
Huffman tree, one binary decision a node. For each decision several predictors,
one a context (the last 1, 2, 3, 4 and 6 bytes, each met by hash), give their
log odds; these are summed with weights that are picked by a gate (how often
the longer contexts were seen), and an adaptive probability map refines the sum
by node and height. The sum over all decisions is the text's log probability,
and so its bits per byte.

Learning: the predictors count every byte of the training documents but those
of one remainder class (TUNE), whose documents train weights and map online,
batch by batch, as data the predictors have not seen. Scores depend on a text
and the model, and the model on the documents alone: not on their partitioning.

Scale: what a byte costs depends on the byte and the six before it only, a
window of seven bytes. Windows are counted a task and dealt to buckets by their
last three context bytes, so that a bucket holds all that the contexts of 3, 4
and 6 bytes need; those of 1 and 2 bytes are bounded by the alphabet. So the
tables grow with the corpus and no count is lost to a collision. Windows and
words that occur often (at most FREQUENT and HEAD of them) are sent to all
tasks with their results; the others, none of which can be hot, go by bucket
once more with their documents.

Defined cases: a null text is empty, with one token, the end; a null doc_id
counts as the empty string for the remainder, so it trains; repeated rows count
each time in training and get the same scores; no training documents at all
give base_score 0 for N = V = 0 and a model of even odds; long texts are read
in whole, in pieces of bounded size; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entrygraph.llm.common import arrow_map, arrow_schema, dealt, staged

FOLDS, HELD, TUNE = 7, 2, 3
#: Words and windows that all tasks know; others are looked up by bucket.
HEAD, FREQUENT = 50_000, 1_500_000
#: Bytes of text to a bucket; words, windows and look-ups after which a task sends what it has.
BUCKET_BYTES, FLUSH_WORDS, FLUSH_WINDOWS, FLUSH_ASKED = 16 << 20, 300_000, 1_500_000, 2_000_000
#: Context lengths; those from the third on are counted by bucket.
ORDERS, NEAR = (1, 2, 3, 4, 6), 3
PAD, PIECE, CHUNK, BATCHES, RATE = 6, 1 << 20, 100_000, 128, 0.1
GATES, HEIGHTS, LIMIT = 16, 33, 8.0
#: Counts above this are taken as equal when the frequent windows are picked.
COUNTED = 4096
_MIX = np.uint64(0x9E3779B97F4A7C15)


def fold(doc_id: int | None) -> int:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % FOLDS


def row_key(doc_id: int | None, text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode(), seed=xxhash.xxh64_intdigest(repr(doc_id))) >> 1


def model_words(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def _packed(arrays: list[np.ndarray]) -> bytes:
    return b"".join(len(a).to_bytes(4, "little") + a.tobytes() for a in arrays)


def _unpacked(blob: bytes, kinds: str) -> list[np.ndarray]:
    out, at = [], 0
    for kind in kinds.split():
        n = int.from_bytes(blob[at : at + 4], "little")
        a = np.frombuffer(blob, kind, n, at + 4)
        out.append(a)
        at += 4 + a.nbytes
    return out


def _small(batches, rows: int = 256):
    """Slices of batches, so that a task never holds the words of a whole batch."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _rows(schema: pa.Schema, *rows: tuple) -> pa.RecordBatch:
    return pa.record_batch([pa.array(list(c), type=f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _in_buckets(bucket: np.ndarray, buckets: int):
    """The stable order by bucket, and (bucket, begin, end) in it for those that have members."""
    order = np.argsort(bucket, kind="stable")
    cut = np.searchsorted(bucket[order], np.arange(buckets + 1)).tolist()
    return order, [(i, a, b) for i, (a, b) in enumerate(zip(cut, cut[1:])) if a < b]


def _by_bucket(df: DataFrame, buckets: int) -> DataFrame:
    """Buckets dealt evenly to partitions, each in one piece, first by kind."""
    return dealt(df, buckets).sortWithinPartitions("bucket", "kind")


def _streamed(batches):
    """(bucket, rows) of sorted batches, one bucket at a time; rows are read as they come."""

    def rows():
        for batch in batches:
            for i in range(batch.num_rows):
                yield [batch.column(k)[i].as_py() for k in range(batch.num_columns)]

    feed = rows()
    ahead = next(feed, None)
    while ahead is not None:
        now = ahead[0]

        def own(now=now):
            nonlocal ahead
            while ahead is not None and ahead[0] == now:
                row, ahead = ahead, None
                yield row
                ahead = next(feed, None)

        mine = own()
        yield now, mine
        for _ in mine:
            pass


# windows


def windows(runs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """A key for each byte of the runs, in order, and the run it lies in.

    From the highest bits down: the byte before, the one before that, up to
    six, then the byte itself. So keys in order are in the order of contexts.
    """
    data = np.frombuffer(b"".join([b"\n" * PAD + r for r in runs]), np.uint8)
    sizes = np.fromiter(map(len, runs), np.int64, len(runs))
    wide = data.astype(np.uint64)
    keys = wide[PAD:].copy()
    for back in range(1, PAD + 1):
        keys |= wide[PAD - back : -back] << np.uint64(56 - 8 * back)
    owner = np.repeat(np.arange(len(runs)), sizes)
    return keys[np.arange(len(owner)) + PAD * owner], owner


def window_bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    """By the last three bytes of the context."""
    return ((((keys >> np.uint64(32)) * _MIX) >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64)


def summed(keys: np.ndarray, *counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys in order, with the sums of their counts."""
    if not len(keys):
        return (keys, *counts)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return (keys[first], *[np.add.reduceat(c[order], first, dtype=c.dtype) for c in counts])


def pieces(words: list[bytes]):
    """A text as the model reads it, in runs of bounded size; a run begins with the bytes before it."""
    whole = b" ".join(words) + b"\n"
    for at in range(0, len(whole), PIECE):
        yield whole[max(0, at - PAD) : at], whole[at : at + PIECE]


def window_runs(texts: list[list[bytes]], most: int = PIECE):
    """(keys, owner) for stretches of texts of bounded size; owner is the text's place."""
    run, own, size = [], [], 0
    for i, words in enumerate(texts):
        for before, piece in pieces(words):
            if before:  # a later piece of a long text stands alone, without the bytes before it
                keys, _ = windows([before + piece])
                yield keys[len(before) :], np.full(len(piece), i)
                continue
            run.append(piece)
            own.append(i)
            size += len(piece)
            if size >= most:
                keys, owner = windows(run)
                yield keys, np.array(own)[owner]
                run, own, size = [], [], 0
    if run:
        keys, owner = windows(run)
        yield keys, np.array(own)[owner]


# pass 1: counts of words and windows

COUNTS = "bucket int, kind int, part binary, words binary"
WORDS, WINDOWS, PLAIN = range(3)


def counted(docs: DataFrame, buckets: int) -> DataFrame:
    """Rows of kind WORDS (totals and frequent words), WINDOWS (counts) and PLAIN (pairs of bytes before a byte, texts)."""
    schema = arrow_schema(COUNTS)

    def count(batches):
        seen: Counter = Counter()
        pairs: dict[int, int] = {}
        texts, held, size = 0, [], 0
        empty = np.zeros(0, np.uint64), np.zeros(0, np.uint32), np.zeros(0, np.uint32)

        def merged():
            return summed(*[np.concatenate(c) for c in zip(empty, *held)])

        def words_out():
            words = list(seen)
            counts = np.fromiter(seen.values(), np.int64, len(words))
            order, cuts = _in_buckets(np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % buckets, buckets)
            for i, a, b in cuts:
                yield _rows(schema, (i, WORDS, counts[order[a:b]].tobytes(), b" ".join([words[k] for k in order[a:b]])))
            seen.clear()

        def windows_out(keys, train, tune):
            near, by_near = summed((keys >> np.uint64(40)) << np.uint64(8) | keys & np.uint64(255), train.astype(np.int64))
            for k, n in zip(near.tolist(), by_near.tolist()):
                pairs[k] = pairs.get(k, 0) + n
            order, cuts = _in_buckets(window_bucket(keys, buckets), buckets)
            for i, a, b in cuts:
                own = order[a:b]
                yield _rows(schema, (i, WINDOWS, _packed([keys[own], train[own], tune[own]]), b""))

        for batch in _small(batches):
            split = [(f, model_words(t)) for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) if (f := fold(k)) != HELD]
            for _, words in split:
                seen.update(words)
            texts += len(split)
            if len(seen) >= FLUSH_WORDS:
                yield from words_out()
            for tunes in (False, True):
                for keys, _ in window_runs([w for f, w in split if (f == TUNE) == tunes]):
                    keys, n = np.unique(keys, return_counts=True)
                    n, none = n.astype(np.uint32), np.zeros(len(keys), np.uint32)
                    held.append((keys, none, n) if tunes else (keys, n, none))
                    size += len(keys)
            if size >= 2 * FLUSH_WINDOWS:
                one = merged()
                held, size = [one], len(one[0])
                if size >= FLUSH_WINDOWS:
                    yield from windows_out(*one)
                    held, size = [], 0
        if seen:
            yield from words_out()
        if held:
            yield from windows_out(*merged())
        keys = np.array(sorted(pairs), np.uint32)
        yield _rows(schema, (0, PLAIN, _packed([keys, np.array([pairs[k] for k in keys.tolist()], np.int64), np.array([texts])]), b""))

    def add(batches):
        for bucket, rows in _streamed(batches):
            total: Counter = Counter()
            parts: list = []
            plain, texts = None, 0
            for _, kind, part, words in rows:
                if kind == WORDS:
                    for w, c in zip(words.split(b" "), np.frombuffer(part, np.int64).tolist()):
                        total[w] += c
                elif kind == WINDOWS:
                    parts.append(_unpacked(part, "u8 u4 u4"))
                    if sum(len(p[0]) for p in parts) > 2 * FLUSH_WINDOWS + 2 * len(parts[0][0]):
                        parts = [summed(*[np.concatenate(c) for c in zip(*parts)])]
                else:
                    k, n, t = _unpacked(part, "u4 i8 i8")
                    plain = np.zeros(1 << 24, np.int64) if plain is None else plain
                    plain[k] += n
                    texts += int(t[0])
            if total:
                head = total.most_common(HEAD)
                numbers = np.array([sum(total.values()), len(total), *[c for _, c in head]], np.int64)
                yield _rows(schema, (bucket, WORDS, numbers.tobytes(), b" ".join(w for w, _ in head)))
            if parts:
                yield _rows(schema, (bucket, WINDOWS, _packed(list(summed(*[np.concatenate(c) for c in zip(*parts)]))), b""))
            if plain is not None:
                k = np.flatnonzero(plain)
                yield _rows(schema, (bucket, PLAIN, _packed([k.astype(np.uint32), plain[k], np.array([texts])]), b""))

    sent = arrow_map(docs.select("doc_id", "text"), count, COUNTS)
    return staged(arrow_map(_by_bucket(sent, buckets), add, COUNTS))


def frequent_words(counts: DataFrame) -> tuple[dict[bytes, int], int, int]:
    """The words with at least a HEAD-th of all, their number and how many are distinct."""
    schema = arrow_schema(COUNTS)
    words = counts.filter(F.col("kind") == WORDS)
    n = v = 0
    for r in words.select(F.substring("part", 1, 16).alias("part")).collect():  # two numbers a bucket
        a = np.frombuffer(bytes(r.part), np.int64)
        n, v = n + int(a[0]), v + int(a[1])
    least = max(1, n // HEAD)

    def heads(batches):
        for batch in batches:
            for part, own in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                c = np.frombuffer(part, np.int64)[2:]
                k = int((c >= least).sum())
                if k:
                    yield _rows(schema, (0, WORDS, c[:k].tobytes(), b" ".join(own.split(b" ")[:k])))

    head: dict[bytes, int] = {}
    for r in arrow_map(words, heads, COUNTS).collect():  # at most HEAD words in all
        head.update(zip(bytes(r.words).split(b" "), np.frombuffer(r.part, np.int64).tolist()))
    return head, n, v


# the coding tree, the near contexts and the mixer


class Tree:
    """A Huffman tree over bytes: for each byte its path of (node, bit)."""

    def __init__(self, hist: np.ndarray):
        heap = [(int(c) + 1, i, (i,)) for i, c in enumerate(hist)]
        heapq.heapify(heap)
        paths: list[list] = [[] for _ in range(256)]
        node = 0
        while len(heap) > 1:
            (a, _, low), (b, _, high) = heapq.heappop(heap), heapq.heappop(heap)
            for bit, side in ((0, low), (1, high)):
                for s in side:
                    paths[s].append((node, bit))
            heapq.heappush(heap, (a + b, 256 + node, low + high))
            node += 1
        self.depth = np.array([len(p) for p in paths])
        most = int(self.depth.max())
        self.node = np.zeros((256, most), np.uint8)
        self.bit = np.zeros((256, most), bool)
        # [byte, node]: on which side of the node the byte lies, if at all
        self.sides = np.zeros((2, 256, 256), np.float32)
        for s, p in enumerate(paths):
            for d, (k, bit) in enumerate(reversed(p)):
                self.node[s, d], self.bit[s, d] = k, bit
                self.sides[int(bit), s, k] = 1

    def decisions(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place, node, bit) of all decisions that code ``symbols``."""
        deep = self.depth[symbols]
        place = np.repeat(np.arange(len(symbols)), deep)
        level = np.arange(len(place)) - (np.cumsum(deep) - deep)[place]
        return place, self.node[symbols[place], level], self.bit[symbols[place], level]


def stretched(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    return np.log((ones + 0.4) / (zeros + 0.4)).astype(np.float32)


class Near:
    """The tree, and the log odds of a one at each node after the last byte and the last two."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        symbol = keys & 255
        self.tree = Tree(np.bincount(symbol, counts, 256))
        one = np.zeros((256, 256), np.float32)
        np.add.at(one, (keys >> 16, symbol), counts)
        context, at = np.unique(keys >> 8, return_inverse=True)
        two = np.zeros((len(context) + 1, 256), np.float32)  # the last row is for pairs never seen
        np.add.at(two, (at, symbol), counts)
        self.one, self.two = (stretched(c @ self.tree.sides[0], c @ self.tree.sides[1]) for c in (one, two))
        self.row = np.full(1 << 16, len(context), np.int32)
        self.row[context] = np.arange(len(context))


class Far:
    """What a stretch of a bucket's windows tells the contexts of 3, 4 and 6 bytes."""

    SHIFTS = tuple(np.uint64(56 - 8 * k) for k in ORDERS[NEAR - 1 :])

    def __init__(self, tree: Tree, keys: np.ndarray, counts: np.ndarray):
        used = counts > 0
        keys, counts = keys[used], counts[used].astype(np.float64)
        place, node, bit = tree.decisions((keys & np.uint64(255)).astype(np.int64))
        self.odds, self.seen = [], []
        for shift in self.SHIFTS:
            context = keys >> shift
            pair, at = np.unique(context[place] << np.uint64(8) | node, return_inverse=True)
            ones, both = np.bincount(at, counts[place] * bit, len(pair)), np.bincount(at, counts[place], len(pair))
            self.odds.append((pair, stretched(both - ones, ones)))
            self.seen.append(summed(context, counts))

    @staticmethod
    def found(table: tuple, asked: np.ndarray, kind) -> np.ndarray:
        known, values = table
        if not len(known):
            return np.zeros(len(asked), kind)
        at = np.minimum(np.searchsorted(known, asked), len(known) - 1)
        return np.where(known[at] == asked, values[at], kind(0)).astype(kind)


class Decisions:
    """All decisions of some windows: inputs, gate, node and bit."""

    def __init__(self, near: Near, far: Far, keys: np.ndarray):
        symbol = (keys & np.uint64(255)).astype(np.int64)
        self.place, self.node, self.bit = near.tree.decisions(symbol)
        last = (keys >> np.uint64(48)).astype(np.int64)
        pair = (keys >> np.uint64(40)).astype(np.int64)
        self.inputs = [near.one[last[self.place], self.node], near.two[near.row[pair][self.place], self.node]]
        for shift, table in zip(far.SHIFTS, far.odds):
            self.inputs.append(far.found(table, (keys >> shift)[self.place] << np.uint64(8) | self.node, np.float32))
        grades = [np.searchsorted([2, 16, 256], far.found(t, keys >> s, np.float64), side="right") for s, t in list(zip(far.SHIFTS, far.seen))[-2:]]
        self.gate = (grades[0] * 4 + grades[1])[self.place]

    def part(self, at: np.ndarray) -> "Decisions":
        out = object.__new__(Decisions)
        out.inputs = [x[at] for x in self.inputs]
        out.place, out.node, out.bit, out.gate = self.place[at], self.node[at], self.bit[at], self.gate[at]
        return out


class Mixer:
    """The weights by gate and the map by node and height."""

    def __init__(self):
        self.weights = np.full((len(ORDERS), GATES), 0.3, np.float64)
        self.map = np.tile(np.linspace(-LIMIT, LIMIT, HEIGHTS), (256, 1)).astype(np.float32)
        self.hits = np.zeros((2, 256 * HEIGHTS))
        self.decisions = 0

    def odds(self, d: Decisions) -> np.ndarray:
        weights = self.weights.astype(np.float32)
        return np.clip(sum(w[d.gate] * x for w, x in zip(weights, d.inputs)), -LIMIT, LIMIT)

    @staticmethod
    def height(d: Decisions, odds: np.ndarray) -> np.ndarray:
        return d.node.astype(np.int64) * HEIGHTS + np.rint((odds + LIMIT) * ((HEIGHTS - 1) / (2 * LIMIT))).astype(np.int64)

    def learn(self, d: Decisions, times: np.ndarray, order: np.ndarray) -> None:
        """One pass over the decisions in ``order``, a batch at a time; each counts ``times``."""
        step = max(64, -(-len(order) // BATCHES))
        for at in range(0, len(order), step):
            some = order[at : at + step]
            b, t = d.part(some), times[some]
            odds = self.odds(b)
            wrong = t * (b.bit - 1 / (1 + np.exp(-odds)))
            size = np.bincount(b.gate, t, GATES)
            for k, x in enumerate(b.inputs):
                self.weights[k] += RATE * np.bincount(b.gate, wrong * x, GATES) / np.maximum(size, 50)
            place = self.height(b, odds)
            for side in (0, 1):
                self.hits[side] += np.bincount(place[b.bit == side], t[b.bit == side], minlength=256 * HEIGHTS)
        self.decisions += int(times.sum())

    def settle(self, weights: np.ndarray, hits: np.ndarray) -> None:
        """Take averaged weights, and the map from counted outcomes with the unmapped height as prior."""
        self.weights = weights
        prior = 1 / (1 + np.exp(-np.linspace(-LIMIT, LIMIT, HEIGHTS)))
        none, ones = hits[0].reshape(256, -1), hits[1].reshape(256, -1)
        p = (ones + 20 * prior) / (none + ones + 20)
        self.map = np.clip(np.log(p / (1 - p)), -LIMIT - 1, LIMIT + 1).astype(np.float32)

    def costs(self, d: Decisions, n: int) -> np.ndarray:
        """log10 of the probability of each of the ``n`` windows' bytes."""
        odds = self.odds(d)
        refined = (odds + self.map.ravel()[self.height(d, odds)]) * 0.5
        return -np.bincount(d.place, np.log1p(np.exp(np.where(d.bit, -refined, refined).astype(np.float64))), n) / math.log(10)


def stretches(keys: np.ndarray, *others: np.ndarray):
    """Slices of about CHUNK sorted keys that share no context of three bytes, and the same ranges of ``others``."""
    head = keys >> np.uint64(32)
    at = 0
    while at < len(keys):
        to = min(at + CHUNK, len(keys))
        if to < len(keys):
            to = int(np.searchsorted(head, head[to - 1], side="right"))
        low, high = np.uint64(0) if not at else head[at] << np.uint64(32), (head[to] << np.uint64(32)) if to < len(keys) else np.uint64(1 << 56)
        yield slice(at, to), [slice(*np.searchsorted(o, [low, high]).tolist()) for o in others]
        at = to


def window_costs(near: Near, mixer: Mixer, keys: np.ndarray, counts: np.ndarray, asked: np.ndarray) -> np.ndarray:
    """log10 probabilities of sorted ``asked`` windows of a bucket whose windows are ``keys``."""
    out = np.zeros(len(asked))
    if not len(keys):
        keys, counts = asked[:1], np.zeros(1, np.uint32)
    for own, (q,) in stretches(keys, asked):
        for at in range(q.start, q.stop, CHUNK):
            some = slice(at, min(at + CHUNK, q.stop))
            far = Far(near.tree, keys[own], counts[own]) if at == q.start else far
            out[some] = mixer.costs(Decisions(near, far, asked[some]), some.stop - some.start)
    return out


# pass 2: weights, map and frequent windows

MODEL = "bucket int, kind int, part binary"


def tuned(counts: DataFrame, near: Near) -> tuple[Mixer, int]:
    """The mixer, learned online in each bucket and averaged in one task; the least count of a frequent window."""
    shared = counts.sparkSession.sparkContext.broadcast(near)
    schema = arrow_schema(MODEL)

    def learn(batches):
        near = shared.value
        for batch in batches:
            for bucket, kind, part in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if kind != WINDOWS:
                    continue
                keys, train, tune = _unpacked(part, "u8 u4 u4")
                mixer = Mixer()
                for own, () in stretches(keys):
                    asks = np.flatnonzero(tune[own] > 0)
                    if len(asks):
                        far = Far(near.tree, keys[own], train[own])
                        for at in range(0, len(asks), CHUNK):
                            some = asks[at : at + CHUNK]
                            d = Decisions(near, far, keys[own][some])
                            # the order is drawn by the window and the node
                            draw = (keys[own][some][d.place] * np.uint64(256) + d.node) * _MIX
                            mixer.learn(d, tune[own][some].astype(np.float64)[d.place], np.argsort(draw ^ draw >> np.uint64(31), kind="stable"))
                often = np.bincount(np.minimum(train, COUNTED - 1), minlength=COUNTED)
                yield _rows(schema, (bucket, 0, _packed([np.array([mixer.decisions]), mixer.weights.ravel(), mixer.hits.ravel(), often])))

    def add(batches):
        n, weights, hits, often = 0, np.zeros(len(ORDERS) * GATES), np.zeros(2 * 256 * HEIGHTS), np.zeros(COUNTED, np.int64)
        for batch in batches:
            for part in batch.column(2).to_pylist():
                d, w, h, o = _unpacked(part, "i8 f8 f8 i8")
                n, weights, hits, often = n + int(d[0]), weights + d[0] * w, hits + h, often + o
        yield _rows(schema, (0, 0, _packed([np.array([n]), weights, hits, often])))

    learned = arrow_map(counts.select("bucket", "kind", "part"), learn, MODEL)
    whole = arrow_map(learned.repartition(1).sortWithinPartitions("bucket"), add, MODEL).collect()
    mixer, least = Mixer(), 1
    for r in whole:
        n, weights, hits, often = _unpacked(bytes(r.part), "i8 f8 f8 i8")
        mixer.settle((weights / n[0]).reshape(mixer.weights.shape) if n[0] else mixer.weights, hits.reshape(2, -1))
        above = np.cumsum(often[::-1])[::-1]
        fits = np.flatnonzero(above[1:] <= FREQUENT)
        least = int(fits[0]) + 1 if len(fits) else COUNTED
    return mixer, least


def frequent_windows(counts: DataFrame, near: Near, mixer: Mixer, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The windows seen at least ``least`` times with their costs: at most about FREQUENT."""
    shared = counts.sparkSession.sparkContext.broadcast((near, mixer))
    schema = arrow_schema(MODEL)

    def cost(batches):
        near, mixer = shared.value
        for batch in batches:
            for bucket, kind, part in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if kind == WINDOWS:
                    keys, train, _ = _unpacked(part, "u8 u4 u4")
                    asked = keys[train >= least]
                    if len(asked):
                        yield _rows(schema, (bucket, 0, _packed([asked, window_costs(near, mixer, keys, train, asked).astype(np.float32)])))

    found = [_unpacked(bytes(r.part), "u8 f4") for r in arrow_map(counts.select("bucket", "kind", "part"), cost, MODEL).collect()]
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.float32)
    keys, costs = (np.concatenate(c) for c in zip(*found))
    order = np.argsort(keys)
    return keys[order], costs[order]


class Known:
    """Frequent windows in two direct-mapped tables; the few that find no place are looked up by bucket."""

    def __init__(self, keys: np.ndarray, costs: np.ndarray):
        self.tables = []
        for seed in (1, 3):
            bits = max(4, int(2 * len(keys)).bit_length())
            at = self.at(keys, seed, bits)
            held, cost = np.full(1 << bits, np.uint64(0xFFFFFFFFFFFFFFFF)), np.zeros(1 << bits, np.float32)
            held[at], cost[at] = keys, costs
            self.tables.append((seed, bits, held, cost))
            left = held[at] != keys
            keys, costs = keys[left], costs[left]

    @staticmethod
    def at(keys: np.ndarray, seed: int, bits: int) -> np.ndarray:
        h = keys * np.uint64(int(_MIX) * seed & 0xFFFFFFFFFFFFFFFF)
        return ((h ^ h >> np.uint64(32)) * _MIX >> np.uint64(64 - bits)).astype(np.int64)

    def look_up(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The costs, 0 where unknown, and the places of the unknown ones."""
        seed, bits, held, cost = self.tables[0]
        at = self.at(keys, seed, bits)
        out = cost[at]
        miss = np.flatnonzero(held[at] != keys)
        out[miss] = 0
        seed, bits, held, cost = self.tables[1]
        at = self.at(keys[miss], seed, bits)
        there = held[at] == keys[miss]
        out[miss[there]] = cost[at[there]]
        return out, miss[~there]


# pass 3: scores

ASKS = "bucket int, kind int, part binary, words binary"
TABLE, OF_WORDS, OF_WINDOWS, OF_DOCS, SUMS = range(5)
SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, bits_per_byte double"


def scored(docs: DataFrame, counts: DataFrame, buckets: int, head: dict[bytes, int], texts: int, tokens: int, types: int, near: Near, mixer: Mixer, known: tuple) -> DataFrame:
    """The rows of SCORES: what is frequent is summed where a document is read, the rest by bucket, then by home bucket."""
    spark = docs.sparkSession
    asker = spark.sparkContext.broadcast((head, known))
    teller = spark.sparkContext.broadcast((near, mixer))
    schema, out_schema = arrow_schema(ASKS), arrow_schema(SCORES)
    whole = math.log10(tokens + types + 1)

    def send(batches):
        head, known = asker.value
        known = Known(*known)
        logs = {w: math.log10(c + 1) for w, c in head.items()}
        end = math.log10(texts + 1)
        entry_key: list[int] = []  # a row of the table, with whether it trains
        entry_train: list[bool] = []
        words: list[bytes] = []
        word_entry, word_times, asked = [], [], []
        rows: list[tuple] = []

        def flush():
            keys, train = np.array(entry_key, np.int64), np.array(entry_train, np.uint8)
            if words:
                order, cuts = _in_buckets(np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % buckets, buckets)
                of, times = np.array(word_entry), np.array(word_times, np.uint32)
                for i, a, b in cuts:
                    own = order[a:b]
                    used, entry = np.unique(of[own], return_inverse=True)
                    ids: dict[bytes, int] = {}
                    place = np.array([ids.setdefault(words[k], len(ids)) for k in own.tolist()], np.uint32)
                    yield _rows(schema, (i, OF_WORDS, _packed([keys[used], train[used], place, entry.astype(np.uint32), times[own]]), b" ".join(ids)))
            if asked:
                key, of, times = (np.concatenate(c) for c in zip(*asked))
                order, cuts = _in_buckets(window_bucket(key, buckets), buckets)
                for i, a, b in cuts:
                    own = order[a:b]
                    used, entry = np.unique(of[own], return_inverse=True)
                    distinct, place = np.unique(key[own], return_inverse=True)
                    yield _rows(schema, (i, OF_WINDOWS, _packed([keys[used], distinct, place.astype(np.uint32), entry.astype(np.uint32), times[own].astype(np.uint32)]), b""))
            if rows:
                columns = [np.array(c) for c in zip(*rows)]
                order, cuts = _in_buckets(columns[0] % buckets, buckets)
                for i, a, b in cuts:
                    own = order[a:b]
                    kinds = (np.int64, np.int64, np.uint8, np.uint8, np.int64, np.int64, np.float64, np.float64, np.int64)
                    yield _rows(schema, (i, OF_DOCS, _packed([c[own].astype(t) for c, t in zip(columns, kinds)]), b""))
            for x in (entry_key, entry_train, words, word_entry, word_times, asked, rows):
                x.clear()

        for batch in _small(batches):
            ids, raw = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            split = [model_words(t) for t in raw]
            first = len(entry_key)
            model = np.zeros(len(raw))
            for keys, owner in window_runs(split):
                costs, miss = known.look_up(keys)
                model += np.bincount(owner, costs, len(raw))
                if len(miss):
                    lost, at = np.unique(keys[miss], return_inverse=True)
                    pair, times = np.unique(owner[miss] * len(lost) + at, return_counts=True)
                    of = pair // len(lost)
                    asked.append((lost[pair % len(lost)], of + first, times))
            for doc_id, text, own, m in zip(ids, raw, split, model.tolist()):
                rare = Counter([w for w in own if w not in logs])
                common = [logs[w] for w in own if w in logs] if rare else [logs[w] for w in own]
                f = fold(doc_id)
                n = len(entry_key)
                entry_key.append(row_key(doc_id, text or ""))
                entry_train.append(f != HELD)
                words.extend(rare)
                word_entry.extend([n] * len(rare))
                word_times.extend(rare.values())
                size = sum(map(len, own)) + max(len(own), 1)
                rows.append((entry_key[-1], doc_id or 0, doc_id is not None, f == HELD, len(own) + 1, len(common) + (texts > 0), math.fsum(common) + end, m, size))
            if len(words) + sum(len(a[0]) for a in asked) >= FLUSH_ASKED or len(rows) >= 50_000:
                yield from flush()
        yield from flush()

    def tell(batches):
        near, mixer = teller.value
        for bucket, rows in _streamed(batches):
            table = np.zeros(0, np.uint64), np.zeros(0, np.uint32)
            of_words, of_windows = [], []
            ids: dict[bytes, int] = {}
            for _, kind, part, words in rows:
                if kind == TABLE:
                    table = tuple(_unpacked(part, "u8 u4 u4")[:2])
                elif kind == OF_DOCS:
                    home, *_ = _unpacked(part, "i8")
                    yield _rows(schema, (int(home[0]) % buckets, OF_DOCS, part, b""))
                elif kind == OF_WORDS:
                    keys, train, place, entry, times = _unpacked(part, "i8 u1 u4 u4 u4")
                    local = np.array([ids.setdefault(w, len(ids)) for w in words.split(b" ")], np.int64)
                    of_words.append((keys, train, local[place], entry, times))
                else:
                    of_windows.append(_unpacked(part, "i8 u8 u4 u4 u4"))
            if of_words:
                base = np.cumsum([0, *[len(p[0]) for p in of_words]])
                keys, train = (np.concatenate([p[k] for p in of_words]) for k in (0, 1))
                word, times = (np.concatenate([p[k] for p in of_words]) for k in (2, 4))
                entry = np.concatenate([p[3] + b for p, b in zip(of_words, base.tolist())])
                c = np.bincount(word, times * train[entry].astype(np.float64), len(ids))
                yield from told(keys, entry, times, np.log10(c[word] + 1), c[word] > 0, 1)
            if of_windows:
                keys = np.concatenate([p[0] for p in of_windows])
                base, wide = (np.cumsum([0, *[len(p[k]) for p in of_windows]]).tolist() for k in (0, 1))
                distinct, at = np.unique(np.concatenate([p[1] for p in of_windows]), return_inverse=True)
                costs = window_costs(near, mixer, *table, distinct)[at]
                cost = np.concatenate([costs[p[2] + w] for p, w in zip(of_windows, wide)])
                entry = np.concatenate([p[3] + b for p, b in zip(of_windows, base)])
                yield from told(keys, entry, np.concatenate([p[4] for p in of_windows]), cost, np.zeros(len(cost), bool), 0)

    def told(keys, entry, times, value, seen, is_word):
        """Sums by row of the table, to their home buckets; a row that is repeated has equal sums more than once."""
        sums, known = np.bincount(entry, times * value, len(keys)), np.bincount(entry, times * seen, len(keys))
        order, cuts = _in_buckets(keys % buckets, buckets)
        for i, a, b in cuts:
            own = order[a:b]
            yield _rows(schema, (i, SUMS, _packed([keys[own], np.full(b - a, is_word, np.uint8), sums[own], known[own].astype(np.int64)]), b""))

    def add(batches):
        for bucket, rows in _streamed(batches):
            docs_of, sums_of = [], []
            for _, kind, part, _ in rows:
                if kind == OF_DOCS:
                    docs_of.append(_unpacked(part, "i8 i8 u1 u1 i8 i8 f8 f8 i8"))
                else:
                    sums_of.append(_unpacked(part, "i8 u1 f8 i8"))
            if not docs_of:
                continue
            key, doc_id, has_id, held, n_tokens, n_known, base, model, size = (np.concatenate(c) for c in zip(*docs_of))
            if sums_of:
                k, w, s, n = (np.concatenate(c) for c in zip(*sums_of))
                unique, at = np.unique(key, return_inverse=True)
                times = np.bincount(at, minlength=len(unique))
                place = np.searchsorted(unique, k)
                more = lambda x: (np.bincount(place, x, len(unique)) / times)[at]
                base, model, n_known = base + more(s * w), model + more(s * (1 - w)), n_known + np.rint(more(n)).astype(np.int64)
            columns = [
                pa.array(doc_id, mask=has_id == 0), pa.array(held.astype(bool)), pa.array(n_tokens), pa.array(n_known), pa.array(np.full(len(key), tokens)),
                pa.array(base - n_tokens * whole), pa.array(model), pa.array(-model * math.log2(10) / size),
            ]
            yield pa.record_batch(columns, schema=out_schema)

    asks = arrow_map(docs, send, ASKS)
    tables = counts.filter(F.col("kind") == WINDOWS).select("bucket", F.lit(TABLE).alias("kind"), "part", "words")
    sums = arrow_map(_by_bucket(asks.unionByName(tables), buckets), tell, ASKS)
    return arrow_map(_by_bucket(sums, buckets), add, SCORES)


def score_texts(docs: DataFrame) -> DataFrame:
    """One row a document: held_out, n_tokens, n_known, train_tokens, base_score, score and bits_per_byte."""
    docs = docs.select("doc_id", "text")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(6, -(-size // BUCKET_BYTES))
    counts = counted(docs, buckets)
    head, n, v = frequent_words(counts)
    pairs, times, texts = np.zeros(0, np.int64), np.zeros(0, np.int64), 0
    for r in counts.filter(F.col("kind") == PLAIN).select("part").collect():  # one row, bounded by the alphabet
        pairs, times, one = _unpacked(bytes(r.part), "u4 i8 i8")
        pairs, texts = pairs.astype(np.int64), int(one[0])
    near = Near(pairs, times)
    mixer, least = tuned(counts, near)
    known = frequent_windows(counts, near, mixer, least)
    return scored(docs, counts, buckets, head, texts, n + texts, v + (texts > 0), near, mixer, known)
