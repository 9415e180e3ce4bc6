"""Benchmark decontamination: SimHash windows, multi-index blocks, exact check.

A document is contaminated by an item if some window of as many words as the
item has a weighted similarity of at least SIMILAR with it: over shingles of
five words (an item with fewer words is one shingle), the sum of the lesser
counts divided by the sum of the greater counts. A document with fewer words
than the item, but no fewer than a shingle, is one window.

Windows that share no shingle with an item of their size have similarity 0, so
only the others get a fingerprint: the majority of each bit over the hashes of
a window's shingles, from running sums. Fingerprints and items are cut in
BLOCKS blocks of bits; within RADIUS differing bits, some block differs in at
most RADIUS // BLOCKS bits, so looking up each block with so many errors finds
every item within the radius. The exact similarity then decides. At similarity
0.8 the expected distance is under 10 bits of 64 (deviation under 3), so the
radius leaves out about one pair in 100,000 at the very threshold, and fewer
above it.

The benchmark is the query set: it is sent to all tasks in runs of at most
ITEM_BYTES, each run against all documents.

Defined cases: null and empty texts of documents match nothing; items without
words are passed over; a document shorter than a shingle does not match; very
long texts are looked through in stretches of bounded size; repeated items and repeated documents are each reported; of equally
similar windows the first counts; empty tables give an empty result; other
columns are ignored by ``matches`` and carried by ``clean_documents``.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entrygraph.llm.common import arrow_map, arrow_schema

SHINGLE, SIMILAR = 5, 0.8
RADIUS, BLOCKS, BITS = 22, 16, 64
#: Bytes of benchmark text that are sent to tasks at once.
ITEM_BYTES = 16 << 20
SCHEMA = "doc_id long, item_id long, start_word long, n_words long, similarity double"
_M = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def hashed(words: list[bytes]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(w) for w in words], np.uint64)


def shingled(h: np.ndarray, size: int) -> np.ndarray:
    """A hash of each run of ``size`` words."""
    n = len(h) - size + 1
    out = np.zeros(max(n, 0), np.uint64)
    for k in range(size if n > 0 else 0):
        out = (out ^ h[k : n + k]) * _M[0]
        out ^= out >> np.uint64(32)
    return out * _M[1] ^ out >> np.uint64(29)


def similarity(a: list[bytes], b: list[bytes], size: int) -> float:
    """Sum of lesser over sum of greater shingle counts."""
    x = Counter(tuple(a[i : i + size]) for i in range(len(a) - size + 1))
    y = Counter(tuple(b[i : i + size]) for i in range(len(b) - size + 1))
    both = sum((x & y).values())
    return both / (x.total() + y.total() - both)


def prints(hashes: np.ndarray, starts: np.ndarray, count: int) -> np.ndarray:
    """Fingerprints of the windows of ``count`` shingles that begin at ``starts``."""
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    sums = np.zeros((len(hashes) + 1, BITS), np.int32)
    np.cumsum(bits, axis=0, out=sums[1:])
    return np.packbits(2 * (sums[starts + count] - sums[starts]) > count, axis=1, bitorder="little").view("<u8").ravel()


class Sized:
    """The items of one size: fingerprints with block tables."""

    def __init__(self, items: list[int], fingerprints: np.ndarray):
        self.items, self.prints = items, fingerprints
        width, errors = BITS // BLOCKS, RADIUS // BLOCKS
        values = np.arange(1 << width)
        near = np.bitwise_count(values[:, None] ^ values) <= errors
        #: [block][value] -> items whose block is within the errors of the value
        self.tables = [near[:, (fingerprints >> np.uint64(width * b)).astype(np.int64) & ((1 << width) - 1)] for b in range(BLOCKS)]
        self.width = width

    def near(self, fingerprints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) pairs within RADIUS."""
        found = np.zeros((len(fingerprints), len(self.items)), bool)
        for b, table in enumerate(self.tables):
            found |= table[(fingerprints >> np.uint64(self.width * b)).astype(np.int64) & ((1 << self.width) - 1)]
        w, i = np.nonzero(found)
        close = np.bitwise_count(fingerprints[w] ^ self.prints[i]) <= RADIUS
        return w[close], i[close]


class Items:
    """A run of benchmark items ready to be looked for."""

    def __init__(self, items: list[tuple[int | None, str]]):
        self.ids = [i for i, _ in items]
        self.words = [words_of(t) for _, t in items]
        self.vocabulary: dict[bytes, int] = {}
        for ws in self.words:
            for w in ws:
                self.vocabulary.setdefault(w, len(self.vocabulary))
        by_size: dict[int, list[int]] = {}
        for i, ws in enumerate(self.words):
            if ws:
                by_size.setdefault(len(ws), []).append(i)
        self.sized, posts = {}, {}
        for size, own in by_size.items():
            k = min(SHINGLE, size)
            hashes = [shingled(hashed(self.words[i]), k) for i in own]
            self.sized[size] = Sized(own, np.concatenate([prints(h, np.array([0]), len(h)) for h in hashes]))
            for h in hashes:
                for x in h.tolist():
                    posts.setdefault((k, x), set()).add(size)
        #: for each shingle length the shingles' hashes, sorted, and the sizes of the items that hold them
        self.posts = {}
        for k in {k for k, _ in posts}:
            keys = sorted(x for j, x in posts if j == k)
            self.posts[k] = np.array(keys, np.uint64), [sorted(posts[k, x]) for x in keys]

    def matches(self, text: str | None) -> list[tuple]:
        words = words_of(text)
        if not words:
            return []
        known = np.fromiter([w in self.vocabulary for w in words], bool, len(words))
        best: dict[int, tuple[float, int]] = {}
        for k, (keys, sizes) in self.posts.items():
            if len(words) < k:
                continue
            run = known[: len(words) - k + 1].copy()
            for j in range(1, k):
                run &= known[j : len(words) - k + 1 + j]
            at = np.flatnonzero(run)
            if not len(at):
                continue
            # hashes of words are needed around these places only
            span = max(s for s in self.sized if min(SHINGLE, s) == k)
            for a, b in _cut(_stretches(at, span, len(words)), span):
                h = shingled(hashed(words[a:b]), k)
                place = np.searchsorted(keys, h)
                hits = np.flatnonzero(keys[np.minimum(place, len(keys) - 1)] == h)
                starts: dict[int, list[np.ndarray]] = {}
                for p in hits.tolist():
                    for s in sizes[place[p]]:
                        # a whole document that is shorter than the item is its only window
                        wide = min(s, len(words))
                        starts.setdefault(s, []).append(np.arange(max(0, p - (wide - k)), min(p, len(h) - 1 - (wide - k)) + 1))
                for s, parts in starts.items():
                    begin = np.unique(np.concatenate(parts))
                    if not len(begin):
                        continue
                    sized, wide = self.sized[s], min(s, len(words))
                    w, i = sized.near(prints(h, begin, wide - k + 1))
                    for x, item in zip((begin[w] + a).tolist(), (sized.items[j] for j in i)):
                        score = similarity(words[x : x + wide], self.words[item], k)
                        if score >= SIMILAR and (item not in best or (-score, x) < (-best[item][0], best[item][1])):
                            best[item] = score, x
        return [(self.ids[i], x, min(len(self.words[i]), len(words)), score) for i, (score, x) in sorted(best.items())]


def _stretches(at: np.ndarray, span: int, n: int) -> list[tuple[int, int]]:
    """Stretches of words that hold every window around the places."""
    lo, hi = np.maximum(at - span, 0), np.minimum(at + span, n)
    cut = np.flatnonzero(np.append(True, lo[1:] > hi[:-1]))
    return list(zip(lo[cut].tolist(), hi[np.append(cut[1:], len(hi)) - 1].tolist()))


def _cut(stretches: list[tuple[int, int]], span: int, most: int = 1 << 15) -> Iterator[tuple[int, int]]:
    """Long stretches in parts, each with the words that windows which begin in it need."""
    for a, b in stretches:
        for c in range(a, b, most):
            yield c, min(c + most + span, b)


def _small(batches, rows: int = 512):
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _runs(benchmark: DataFrame) -> list[Items]:
    """The benchmark in runs of bounded size."""
    runs, run, size = [], [], 0
    for r in benchmark.select("item_id", "text").orderBy("item_id", "text").toLocalIterator():
        run.append((r.item_id, r.text or ""))
        size += len(run[-1][1])
        if size >= ITEM_BYTES:
            runs.append(Items(run))
            run, size = [], 0
    return runs + ([Items(run)] if run else [])


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each document and item that contaminates it, with the best window."""
    spark = docs.sparkSession
    schema = arrow_schema(SCHEMA)
    out = spark.createDataFrame([], SCHEMA)
    for items in _runs(benchmark):
        shared = spark.sparkContext.broadcast(items)

        def run(batches, shared=shared):
            items = shared.value
            for batch in _small(batches):
                rows = [(k, *m) for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for m in items.matches(t)]
                if rows:
                    yield pa.record_batch([pa.array(list(c), type=f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

        out = out.unionByName(arrow_map(docs.select("doc_id", "text"), run, SCHEMA))
    return out


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that no item contaminates, with all their columns."""
    for items in _runs(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches, shared=shared):
            items = shared.value
            for batch in _small(batches):
                clean = [not items.matches(t) for t in batch.column(batch.schema.get_field_index("text")).to_pylist()]
                yield batch.filter(pa.array(clean, pa.bool_()))

        docs = arrow_map(docs, run, docs.schema)
    return docs


ORACLE = """
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \\t-\\r]+'), lambda x: x <> '') AS words
  FROM documents),
d AS (SELECT doc_id, words, len(words) AS n FROM w),
bw AS (
  SELECT item_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \\t-\\r]+'), lambda x: x <> '') AS words
  FROM benchmark),
b AS (SELECT item_id, words, len(words) AS m, least(5, len(words)) AS k FROM bw WHERE len(words) > 0),
ish AS (
  SELECT item_id, m, k, sh, count(*) AS c FROM (
    SELECT item_id, m, k, unnest(list_transform(range(1, m - k + 2), lambda i: array_to_string(words[i:i + k - 1], ' '))) AS sh FROM b)
  GROUP BY ALL),
dsh AS (
  SELECT doc_id, n, k, p, sh FROM (
    SELECT doc_id, n, k, unnest(range(0, n - k + 1)) AS p, unnest(list_transform(range(1, n - k + 2), lambda i: array_to_string(words[i:i + k - 1], ' '))) AS sh
    FROM d, (SELECT DISTINCT k FROM b) WHERE n >= k)
  SEMI JOIN ish USING (k, sh)),
hit AS (SELECT doc_id, n, p, item_id, m, ish.k, sh, c FROM dsh JOIN ish USING (k, sh)),
win AS (
  SELECT doc_id, item_id, m, k, s, wide, sh, c, count(*) AS cw FROM (
    SELECT doc_id, item_id, m, k, sh, c, unnest(range(greatest(0, p - (least(m, n) - k)), least(p, n - least(m, n)) + 1)) AS s, least(m, n) AS wide FROM hit)
  GROUP BY ALL),
sim AS (SELECT doc_id, item_id, m, k, s, wide, sum(least(c, cw)) AS i FROM win GROUP BY ALL),
scored AS (SELECT doc_id, item_id, s, wide AS m, i::DOUBLE / (m - k + 1 + wide - k + 1 - i)::DOUBLE AS similarity FROM sim)
SELECT doc_id, item_id, s::BIGINT AS start_word, m::BIGINT AS n_words, similarity FROM scored WHERE similarity >= 0.8
QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, s) = 1
"""
