"""Exact removal of repeated byte strings: a depth-limited radix sort of suffixes.

A byte goes if a SPAN-byte string that covers it also starts earlier in the
corpus. Suffixes need sorting only through SPAN bytes, most significant digit
first, and only groups of equal prefixes go on to the next pass. Not every
suffix has to be sorted: each window of SPAN bytes is represented by the place
of its least CORE-byte hash, so equal windows are represented at equal offsets,
and about 1 place in 31 is ever used. The passes:

1. digit one, the CORE bytes at the anchor: places alone with theirs drop out.
   Places whose whole stretch of represented windows is equal are settled: all
   but the earliest are repeats. This is also done before the exchange, in each
   task, so that thousands of copies send one row a task.
2. digit two, the SIDE bytes before or after the core: of differing stretches
   only those go on that share one of these with another.
3. the last digits, the whole windows of what is left, by 128 hash bits.

Exchanges carry packed arrays in buckets whose number grows with the input;
texts go by document. Documents are ordered by doc_id, nulls last, then by
their text's hash.

Defined cases: a null text is empty; a text under SPAN bytes loses nothing;
rows with equal doc_id and text are one document, so each gets the same result
and neither repeats the other; long texts are handled in pieces that overlap by
SPAN - 1 bytes; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entrygraph.llm.common import arrow_map, arrow_schema, dealt, staged

SPAN, CORE, SIDE = 100, 40, 30
REACH = SPAN - CORE  # a window's core starts within so many bytes of it
PIECE = 1 << 17
#: Bytes of text to a bucket of anchors, windows to a bucket, anchors held before a task sends them.
BUCKET_BYTES, BUCKET_WINDOWS, HELD = 48 << 20, 1_500_000, 1_000_000
SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
_LAST = np.iinfo(np.int64).max


def _powers(base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """base**i and its inverses modulo 2**64, and a random value for each byte."""
    n = PIECE + SPAN
    inverse = pow(base, -1, 1 << 64)
    with np.errstate(over="ignore"):
        up = np.cumprod(np.append(np.uint64(1), np.full(n, base, np.uint64)), dtype=np.uint64)
        down = np.cumprod(np.append(np.uint64(1), np.full(n, inverse, np.uint64)), dtype=np.uint64)
    of = np.array([xxhash.xxh64_intdigest(bytes([i]), base & 0xFFFF) for i in range(256)], np.uint64)
    return up, down, of


_TABLES: dict[int, tuple] = {}
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Hashes:
    """Hashes of any substring of at most PIECE bytes of text, from prefix sums."""

    def __init__(self, data: np.ndarray, which: int = 0):
        if which not in _TABLES:
            _TABLES[which] = _powers(BASES[which])
        up, self.down, of = _TABLES[which]
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(of[data] * up[: len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mixed((self.sums[end] - self.sums[start]) * self.down[start])

    def every(self, size: int) -> np.ndarray:
        n = len(self.sums) - size
        return _mixed((self.sums[size:] - self.sums[:n]) * self.down[:n])


def pieces(sizes: list[int]) -> Iterator[list[tuple[int, int, int]]]:
    """Runs of (text, from, to) of at most PIECE bytes in all; long texts are cut with SPAN - 1 bytes in common."""
    run, held = [], 0
    for i, n in enumerate(sizes):
        if n < SPAN:
            continue
        at = 0
        while True:
            to = min(n, at + PIECE)
            if run and held + to - at > PIECE:
                yield run
                run, held = [], 0
            run.append((i, at, to))
            held += to - at
            if to == n:
                break
            at = to - SPAN + 1
    if run:
        yield run


def anchors(texts: list[bytes]) -> Iterator[tuple[np.ndarray, ...]]:
    """Arrays (text, place, back to the first window, back to the last, digit one, stretch, side before, side after)."""
    for run in pieces([len(t) for t in texts]):
        data = np.frombuffer(b"".join([texts[i][a:b] for i, a, b in run]), np.uint8)
        sizes = np.array([b - a for _, a, b in run])
        begins = np.cumsum(sizes) - sizes
        hashes = Hashes(data)
        core = hashes.every(CORE)
        places = np.arange(len(core), dtype=np.uint64)
        low = np.uint64(PIECE - 1)
        least = (core & ~low) | (places & low)
        width = 1
        while width * 2 <= REACH + 1:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        rest = REACH + 1 - width
        if rest:
            least = np.minimum(least[:-rest], least[rest:])
        # windows that lie in one text
        whole = np.concatenate([np.arange(b, b + n - SPAN + 1) for b, n in zip(begins.tolist(), sizes.tolist())])
        at = (least[whole] & low).astype(np.int64)
        edge = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        place, first, last = at[edge], whole[edge], whole[np.append(edge[1:], len(whole)) - 1]
        part = np.searchsorted(begins, first, side="right") - 1
        shape = _mixed(((place - first) * 128 + (place - last)).astype(np.uint64) + np.uint64(1))
        stretch = hashes.of(first, last + SPAN) ^ shape
        before = np.where(place - first >= SIDE, hashes.of(np.maximum(place - SIDE, 0), place) >> np.uint64(48), 0).astype(np.uint16)
        end = np.minimum(place + CORE + SIDE, len(data))
        after = np.where(last + SPAN >= place + CORE + SIDE, hashes.of(place + CORE, end) >> np.uint64(48), 0).astype(np.uint16)
        of, start = np.array([i for i, _, _ in run]), np.array([a for _, a, _ in run])
        yield of[part], place - begins[part] + start[part], (place - first).astype(np.uint8), (place - last).astype(np.uint8), core[place], stretch, before, after


def text_hash(data: bytes) -> int:
    return xxhash.xxh3_64_intdigest(data)


def packed(arrays: list[np.ndarray]) -> bytes:
    return b"".join(len(a).to_bytes(4, "little") + a.tobytes() for a in arrays)


def unpacked(blob: bytes, kinds: str) -> list[np.ndarray]:
    out, at = [], 0
    for kind in kinds.split():
        n = int.from_bytes(blob[at : at + 4], "little")
        out.append(np.frombuffer(blob, kind, n, at + 4))
        at += 4 + out[-1].nbytes
    return out


def ranks(ids: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """The order of documents given as (doc_id, hash); equal ones share a rank."""
    order = np.lexsort((texts, ids))
    fresh = np.concatenate([[False], (ids[order][1:] != ids[order][:-1]) | (texts[order][1:] != texts[order][:-1])])
    out = np.empty(len(ids), np.int64)
    out[order] = fresh.cumsum()
    return out


# what is known of documents goes to them as rows (bucket, kind, part): parts hold (doc_id, hash, start, end)
COVER, WINDOWS = 0, 1
PARTS = "bucket int, kind int, n long, part binary"


def addressed(kind: int, ids: np.ndarray, texts: np.ndarray, starts: np.ndarray, ends: np.ndarray, homes: int) -> Iterator[tuple]:
    """Rows of PARTS by the documents' home buckets; stretches that touch are joined."""
    if not len(ids):
        return
    order = np.lexsort((starts, texts, ids))
    ids, texts, starts, ends = ids[order], texts[order], starts[order], ends[order]
    same = (ids[1:] == ids[:-1]) & (texts[1:] == texts[:-1])
    if kind == COVER:
        # the furthest end so far, kept apart by document through a shift that grows with each
        group = np.concatenate([[0], (~same).cumsum()])
        shift = group * (int(ends.max()) + 2)
        reach = np.maximum.accumulate(ends + shift) - shift
        cut = np.concatenate([[True], ~same | (starts[1:] > reach[:-1])])
        at = np.flatnonzero(cut)
        ids, texts, starts, ends = ids[at], texts[at], starts[at], reach[np.append(at[1:], len(reach)) - 1]
    home = np.mod(ids, homes)
    by = np.argsort(home, kind="stable")
    cut = np.flatnonzero(np.concatenate([[True], home[by][1:] != home[by][:-1]]))
    for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(by)]):
        own = by[a:b]
        yield int(home[own[0]]), kind, int((ends[own] - starts[own]).sum()), packed([ids[own], texts[own], starts[own].astype(np.uint32), ends[own].astype(np.uint32)])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.record_batch([pa.array(list(c), type=f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def anchor_pass(docs: DataFrame, buckets: int, homes: int) -> DataFrame:
    """Passes 1 and 2: PARTS with stretches known to be repeats and windows that have to be compared."""
    schema = arrow_schema(PARTS)

    def send(batches):
        held: list[list[np.ndarray]] = []
        ids: list[int] = []
        hashes: list[int] = []
        count = 0

        def flush():
            doc, place, back, stop, core, stretch, before, after = (np.concatenate(c) for c in zip(*held))
            i, h = np.array(ids, np.int64), np.array(hashes, np.uint64)
            order = np.lexsort((place, ranks(i, h)[doc]))
            doc, place, back, stop, core, stretch, before, after = (x[order] for x in (doc, place, back, stop, core, stretch, before, after))
            # of equal stretches the earliest is sent, the others are repeats; equal documents send the same
            both = core ^ (stretch * np.uint64(BASES[1]))
            by = np.argsort(both, kind="stable")
            again = np.zeros(len(by), bool)
            again[by[1:]] = both[by][1:] == both[by][:-1]
            begin = np.flatnonzero(~again[by])
            lead = by[np.repeat(begin, np.diff(np.append(begin, len(by))))]
            leader = np.empty(len(by), np.int64)
            leader[by] = lead
            twin = again & (i[doc] == i[doc[leader]]) & (h[doc] == h[doc[leader]]) & (place == place[leader])
            gone = again & ~twin
            d, p = doc[gone], place[gone].astype(np.int64)
            rows = list(addressed(COVER, i[d], h[d], p - back[gone], p - stop[gone] + SPAN, homes))
            rows = [(buckets + r[0] % buckets, *r[1:]) for r in rows]
            keep = np.flatnonzero(~again)
            bucket = (core[keep] % np.uint64(buckets)).astype(np.int64)
            by = keep[np.argsort(bucket, kind="stable")]
            ends = np.searchsorted(np.sort(bucket), np.arange(buckets + 1)).tolist()
            for k in range(buckets):
                own = by[ends[k] : ends[k + 1]]
                if len(own):
                    used, local = np.unique(doc[own], return_inverse=True)
                    rows.append((k, COVER, 0, packed([i[used], h[used], core[own], stretch[own], local.astype(np.uint32), place[own].astype(np.uint32), back[own], stop[own], before[own], after[own]])))
            for x in (held, ids, hashes):
                x.clear()
            return _batch(rows, schema)

        for batch in batches:
            texts = [(t or "").encode() for t in batch.column(1).to_pylist()]
            first = len(ids)
            ids += [_LAST if k is None else k for k in batch.column(0).to_pylist()]
            hashes += map(text_hash, texts)
            for doc, *more in anchors(texts):
                held.append([doc + first, *more])
                count += len(doc)
            if count >= HELD:
                yield flush()
                count = 0
        if held:
            yield flush()

    def receive(batches):
        cols: list[list[np.ndarray]] = []
        ids, hashes, docs_seen = [], [], 0
        for batch in batches:
            forward = []
            for bucket, kind, n, part in zip(*(batch.column(c).to_pylist() for c in range(4))):
                if bucket >= buckets:
                    home = unpacked(part, "i8 u8 u4 u4")[0][0]
                    forward.append((int(np.mod(home, homes)), kind, n, part))
                    continue
                i, h, core, stretch, doc, place, back, stop, before, after = unpacked(part, "i8 u8 u8 u8 u4 u4 u1 u1 u2 u2")
                ids.append(i)
                hashes.append(h)
                cols.append([core, stretch, doc + np.int64(docs_seen), place, back, stop, before, after])
                docs_seen += len(i)
            if forward:
                yield _batch(forward, schema)
        if not cols:
            return
        core, stretch, doc, place, back, stop, before, after = (np.concatenate(c) for c in zip(*cols))
        cols.clear()
        i, h = np.concatenate(ids), np.concatenate(hashes)
        by = np.argsort(core, kind="stable")
        same = core[by][1:] == core[by][:-1]
        more = np.zeros(len(by), bool)
        more[1:] |= same
        more[:-1] |= same
        by = by[more]
        core, stretch, doc, place, back, stop, before, after = (x[by] for x in (core, stretch, doc, place, back, stop, before, after))
        rank = ranks(i, h)
        by = np.lexsort((place, rank[doc], stretch, core))
        core, stretch, doc, place, back, stop, before, after = (x[by] for x in (core, stretch, doc, place, back, stop, before, after))
        if not len(core):
            return
        again = np.concatenate([[False], (core[1:] == core[:-1]) & (stretch[1:] == stretch[:-1])])
        begin = np.flatnonzero(~again)
        leader = np.repeat(begin, np.diff(np.append(begin, len(again))))
        twin = again & (rank[doc] == rank[doc[leader]]) & (place == place[leader])
        gone = again & ~twin
        p = place.astype(np.int64)
        rows = list(addressed(COVER, i[doc[gone]], h[doc[gone]], p[gone] - back[gone], p[gone] - stop[gone] + SPAN, homes))
        # differing stretches with one core: those that share a side with another go on
        lone = np.flatnonzero(~again)
        for side, fits in ((before, back[lone] >= SIDE), (after, stop[lone] <= REACH - SIDE)):
            own = lone[fits]
            key = core[own] ^ _mixed(side[own].astype(np.uint64) + np.uint64(7))
            _, at, n = np.unique(key, return_inverse=True, return_counts=True)
            own = own[n[at] > 1]
            if side is before:
                start, end = p[own] - back[own], p[own] - np.maximum(stop[own], SIDE)
            else:
                start, end = p[own] - np.minimum(back[own], REACH - SIDE), p[own] - stop[own]
            rows += addressed(WINDOWS, i[doc[own]], h[doc[own]], start, end + 1, homes)
        if rows:
            yield _batch(rows, schema)

    sent = arrow_map(docs.select("doc_id", "text"), send, PARTS)
    return staged(arrow_map(dealt(sent, buckets), receive, PARTS))


def with_texts(docs: DataFrame, parts: DataFrame, homes: int) -> DataFrame:
    """Documents and what is known of them in one home partition, the knowledge first."""
    home = F.pmod(F.coalesce("doc_id", F.lit(int(_LAST))), F.lit(homes)).cast("int")
    texts = docs.select(home.alias("bucket"), F.lit(9).alias("kind"), "doc_id", F.col("text").cast("binary").alias("part"))
    known = parts.select("bucket", "kind", F.lit(None).cast("long").alias("doc_id"), "part")
    return dealt(known.unionByName(texts), homes).sortWithinPartitions("kind")


class Known:
    """Stretches by document, from parts."""

    def __init__(self):
        self.parts: dict[int, list] = {COVER: [], WINDOWS: []}
        self.tables: dict[int, tuple] = {}

    def add(self, kind: int, part: bytes) -> None:
        self.parts[kind].append(unpacked(part, "i8 u8 u4 u4"))

    def of(self, kind: int, doc_id: int | None, text: int) -> tuple[np.ndarray, np.ndarray]:
        if kind not in self.tables:
            if not self.parts[kind]:
                self.tables[kind] = None
            else:
                i, h, a, b = (np.concatenate(c) for c in zip(*self.parts[kind]))
                key = h ^ _mixed(i.astype(np.uint64))
                order = np.argsort(key, kind="stable")
                self.tables[kind] = key[order], a[order], b[order]
            self.parts[kind] = []
        if self.tables[kind] is None:
            return np.zeros(0, np.uint32), np.zeros(0, np.uint32)
        keys, a, b = self.tables[kind]
        key = np.uint64(text) ^ _mixed(np.array([_LAST if doc_id is None else doc_id]).astype(np.uint64))[0]
        lo, hi = np.searchsorted(keys, key), np.searchsorted(keys, key, side="right")
        return a[lo:hi], b[lo:hi]


def window_pass(docs: DataFrame, parts: DataFrame, homes: int, buckets: int) -> DataFrame:
    """Pass 3: PARTS with the windows, of those asked for, that start earlier elsewhere."""
    schema = arrow_schema(PARTS)

    def send(batches):
        known = Known()
        cols: list[list] = []
        ids, hashes, count = [], [], 0

        def flush():
            doc, place, one, two = (np.concatenate(c) for c in zip(*cols))
            i, h = np.array(ids, np.int64), np.array(hashes, np.uint64)
            bucket = (one % np.uint64(buckets)).astype(np.int64)
            by = np.argsort(bucket, kind="stable")
            ends = np.searchsorted(bucket[by], np.arange(buckets + 1)).tolist()
            rows = []
            for k in range(buckets):
                own = by[ends[k] : ends[k + 1]]
                if len(own):
                    used, local = np.unique(doc[own], return_inverse=True)
                    rows.append((k, WINDOWS, 0, packed([i[used], h[used], local.astype(np.uint32), place[own].astype(np.uint32), one[own], two[own]])))
            for x in (cols, ids, hashes):
                x.clear()
            return _batch(rows, schema)

        for batch in batches:
            for kind, doc_id, part in zip(*(batch.column(c).to_pylist() for c in (1, 2, 3))):
                if kind != 9:
                    if kind == WINDOWS:
                        known.add(kind, part)
                    continue
                if not part or len(part) < SPAN:
                    continue
                text = text_hash(part)
                starts, ends = known.of(WINDOWS, doc_id, text)
                if not len(starts):
                    continue
                mark = np.zeros(len(part) + 1, np.int32)
                np.add.at(mark, starts, 1)
                np.add.at(mark, ends, -1)
                asked = np.flatnonzero(mark.cumsum()[:-1] > 0)
                ids.append(_LAST if doc_id is None else doc_id)
                hashes.append(text)
                for at in range(0, len(part), PIECE - SPAN + 1):
                    some = asked[(asked >= at) & (asked < at + PIECE - SPAN + 1)]
                    if len(some):
                        data = np.frombuffer(part, np.uint8)[at : at + PIECE]
                        one, two = (Hashes(data, n).of(some - at, some - at + SPAN) for n in (0, 1))
                        cols.append([np.full(len(some), len(ids) - 1), some, one, two])
                        count += len(some)
                if count >= HELD:
                    yield flush()
                    count = 0
        if cols:
            yield flush()

    def receive(batches):
        cols: list[list] = []
        ids, hashes, docs_seen = [], [], 0
        for batch in batches:
            for part in batch.column(3).to_pylist():
                i, h, doc, place, one, two = unpacked(part, "i8 u8 u4 u4 u8 u8")
                ids.append(i)
                hashes.append(h)
                cols.append([doc + np.int64(docs_seen), place, one, two])
                docs_seen += len(i)
        if not cols:
            return
        doc, place, one, two = (np.concatenate(c) for c in zip(*cols))
        cols.clear()
        i, h = np.concatenate(ids), np.concatenate(hashes)
        by = np.argsort(one, kind="stable")
        same = one[by][1:] == one[by][:-1]
        more = np.zeros(len(by), bool)
        more[1:] |= same
        more[:-1] |= same
        by = by[more]
        doc, place, one, two = doc[by], place[by], one[by], two[by]
        rank = ranks(i, h)
        by = np.lexsort((place, rank[doc], two, one))
        doc, place, one, two = doc[by], place[by], one[by], two[by]
        if not len(doc):
            return
        again = np.concatenate([[False], (one[1:] == one[:-1]) & (two[1:] == two[:-1])])
        begin = np.flatnonzero(~again)
        leader = np.repeat(begin, np.diff(np.append(begin, len(again))))
        gone = again & ~((rank[doc] == rank[doc[leader]]) & (place == place[leader]))
        p = place[gone].astype(np.int64)
        rows = list(addressed(COVER, i[doc[gone]], h[doc[gone]], p, p + SPAN, homes))
        if rows:
            yield _batch(rows, schema)

    sent = arrow_map(with_texts(docs, parts.filter(F.col("kind") == WINDOWS), homes), send, PARTS)
    return staged(arrow_map(dealt(sent, buckets), receive, PARTS))


def repeated_spans(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """One row a document: sizes, removed bytes and runs, digest of what is kept; with_text adds the kept bytes."""
    docs = docs.select("doc_id", "text")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(6, -(-size // BUCKET_BYTES))
    homes = buckets | 1
    parts = anchor_pass(docs, buckets, homes)
    windows = parts.filter(F.col("kind") == WINDOWS).agg(F.sum("n")).first()[0] or 0
    cover = parts.filter(F.col("kind") == COVER)
    if windows:
        cover = cover.unionByName(window_pass(docs, parts, homes, max(6, -(-windows // BUCKET_WINDOWS))))
    ddl = SCHEMA + (", kept binary" if with_text else "")
    schema = arrow_schema(ddl)

    def finish(batches):
        known = Known()
        for batch in batches:
            rows = []
            for kind, doc_id, part in zip(*(batch.column(c).to_pylist() for c in (1, 2, 3))):
                if kind != 9:
                    known.add(kind, part)
                    continue
                part = part or b""
                starts, ends = known.of(COVER, doc_id, text_hash(part))
                n = runs = 0
                if len(starts):
                    mark = np.zeros(len(part) + 1, np.int32)
                    np.add.at(mark, starts, 1)
                    np.add.at(mark, ends, -1)
                    gone = mark.cumsum()[:-1] > 0
                    n = int(gone.sum())
                    runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                    kept = np.frombuffer(part, np.uint8)[~gone].tobytes()
                else:
                    kept = part
                row = (doc_id, len(part), n, runs, hashlib.sha256(kept).hexdigest())
                rows.append((*row, kept) if with_text else row)
            if rows:
                yield _batch(rows, schema)

    return arrow_map(with_texts(docs, cover, homes), finish, ddl)
