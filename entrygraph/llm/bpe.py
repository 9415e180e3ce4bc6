"""Byte-level BPE encoding and decoding.

Pre-tokenisation takes no regular expression. Every code point has a class
(letter, number, blank, other white space, rest). The splitting automaton's
transition functions over these classes are constant after one symbol, except
inside a contraction, so their scan needs no more than the neighbouring
classes: all boundaries of a block of texts come from a few array operations.
The slices then go through a cache of pair merges; those of a block that are
not in it are merged all at once, a merge of each a step, with pairs met in a
hashed table. The cached ids of a slice are a decimal string, and decoding goes
the same way back by id sequence.

Defined cases: a null text is empty; an empty text has no tokens and the
digests of nothing; long texts are handled in whole; repeated rows give
repeated results; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import sys
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from entrygraph.llm.common import arrow_map, arrow_schema

OTHER, LETTER, NUMBER, BLANK, SPACE = range(5)
#: The code points of Unicode's White_Space besides the blank.
WHITE = [*range(9, 14), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
#: Code points in a block of texts that is split at once, and slices that a cache holds.
BLOCK, CACHED = 1 << 20, 200_000
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


@lru_cache(1)
def classes() -> np.ndarray:
    """The class of every code point."""
    out = np.zeros(sys.maxunicode + 1, np.uint8)
    kinds = {"L": LETTER, "N": NUMBER}
    out[:] = np.frombuffer(bytes(kinds.get(unicodedata.category(chr(i))[0], OTHER) for i in range(sys.maxunicode + 1)), np.uint8)
    out[WHITE] = SPACE
    out[32] = BLANK
    return out


def boundaries(points: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Where slices start in the code points of texts laid end to end; ``begins`` has the texts' first places."""
    n = len(points)
    kind = classes()[points]
    white = kind >= BLANK
    first = np.zeros(n + 3, bool)
    first[begins] = True
    first[n:] = True
    before, after = np.empty_like(kind), np.empty_like(white)
    before[0], before[1:] = OTHER, kind[:-1]
    after[-1], after[:-1] = True, white[1:] | first[1:n]
    start = np.where(white, (before < BLANK) | ~after, np.where(before >= BLANK, before == SPACE, kind != before))
    # an apostrophe that opens a slice may take letters along
    quote = np.flatnonzero((points == 39) & (start | first[:n]))
    if len(quote):
        far = np.append(points, [0, 0, 0])
        a, b = far[quote + 1], far[quote + 2]
        a = np.where(first[quote + 1], 0, a)
        b = np.where(first[quote + 2] | (a == 0), 0, b)
        one = np.isin(a, [ord(c) for c in "stmd"])
        two = ((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l")))
        start[quote[one | two] + 1] = False
        start = np.append(start, [False] * 3)
        start[quote[one] + 2] = True
        start[quote[two] + 3] = True
        start = start[:n]
    start |= first[:n]
    return np.flatnonzero(start)


def slices(texts: list[str]) -> list[list[str]]:
    """The slices of each text."""
    whole = "".join(texts)
    ends = np.cumsum([len(t) for t in texts])
    if not whole:
        return [[] for _ in texts]
    begins = ends - [len(t) for t in texts]
    points = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)
    at = boundaries(points, begins[begins < ends])
    cut = np.searchsorted(at, ends).tolist()
    at = at.tolist()
    parts = [whole[i:j] for i, j in zip(at, [*at[1:], len(whole)])]
    return [parts[i:j] for i, j in zip([0, *cut], cut)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class Pairs:
    """Which two ids merge to which, in two direct-mapped tables and a small sorted one for the rest."""

    NONE = np.int32(2**31 - 1)

    def __init__(self, ranks: dict[bytes, int]):
        found = [(x << 32 | y, i) for t, i in ranks.items() if len(t) > 1 for k in range(1, len(t)) if (x := ranks.get(t[:k])) is not None and (y := ranks.get(t[k:])) is not None]
        keys, ids = np.array([k for k, _ in found], np.uint64), np.array([i for _, i in found], np.int32)
        self.bits = max(4, int(4 * len(keys)).bit_length())
        self.tables = []
        for seed in (1, 3):
            at = self.place(keys, seed)
            held, merged = np.full(1 << self.bits, np.uint64(2**64 - 1)), np.full(1 << self.bits, self.NONE)
            held[at], merged[at] = keys, ids
            self.tables.append((seed, held, merged))
            left = held[at] != keys
            keys, ids = keys[left], ids[left]
        order = np.argsort(keys)
        self.rest = np.append(keys[order], np.uint64(2**64 - 1)), np.append(ids[order], self.NONE)

    def place(self, keys: np.ndarray, seed: int) -> np.ndarray:
        h = keys * np.uint64(0x9E3779B97F4A7C15 * seed & 2**64 - 1)
        return ((h ^ h >> np.uint64(32)) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(64 - self.bits)).astype(np.int64)

    def merged(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The id that a and b merge to, which is its rank too; NONE for none, or where one is below 0."""
        keys = a.astype(np.uint32).astype(np.uint64) << np.uint64(32) | b.astype(np.uint32)
        out = np.full(len(keys), self.NONE)
        todo = np.flatnonzero((a >= 0) & (b >= 0))
        for seed, held, merged in self.tables:
            at = self.place(keys[todo], seed)
            hit = held[at] == keys[todo]
            out[todo[hit]] = merged[at[hit]]
            todo = todo[~hit & (held[at] != np.uint64(2**64 - 1))]
        at = np.searchsorted(self.rest[0], keys[todo])
        out[todo] = np.where(self.rest[0][at] == keys[todo], self.rest[1][at], self.NONE)
        return out


class Encoder(dict):
    """Slice -> its ids as decimals joined by commas; misses are merged and kept."""

    #: Bytes of a slice that is merged with others; longer ones are merged alone.
    WIDE = 32

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.ranks = ranks
        self.before: dict[str, str] = {}
        self.pairs, self.names = Pairs(ranks), {i: str(i) for i in ranks.values()}
        self.bytes = np.array([ranks[bytes([i])] for i in range(256)], np.int32)

    def learn(self, slices: list[list[str]]) -> None:
        """Merge all slices of a block that are not known."""
        if len(self) >= CACHED:
            self.before = dict(self)
            self.clear()
        new = set().union(*slices).difference(self)
        # those that come again are taken over from the generation before
        again = new.intersection(self.before)
        self.update({p: self.before[p] for p in again})
        new = [p for p in new - again if len(p) < self.WIDE]
        datas, names = [p.encode("utf-8", "replace") for p in new], self.names
        # of like lengths together, so that rows are about full
        short = sorted([k for k, d in enumerate(datas) if len(d) <= self.WIDE], key=lambda k: len(datas[k]))
        for at in range(0, len(short), 1 << 14):
            some = short[at : at + (1 << 14)]
            for k, ids in zip(some, self.merge_many([datas[k] for k in some])):
                self[new[k]] = ",".join([names[i] for i in ids])

    def merge_many(self, datas: list[bytes]) -> list[list[int]]:
        """The ids of slices of few bytes, merging one pair of each at a time."""
        sizes = np.fromiter(map(len, datas), np.int64, len(datas))
        wide = int(sizes.max(initial=1))
        tokens = np.full((len(datas), wide + 1), -1, np.int32)
        tokens[np.arange(wide + 1) < sizes[:, None]] = self.bytes[np.frombuffer(b"".join(datas), np.uint8)]
        out, rows = tokens.copy(), np.arange(len(datas))
        ranks = self.pairs.merged(tokens[:, :-1].ravel(), tokens[:, 1:].ravel()).reshape(len(datas), wide)
        while True:
            at = ranks.argmin(1)
            low = ranks[np.arange(len(rows)), at]
            done = low == Pairs.NONE
            if done.any():
                out[rows[done], : tokens.shape[1]] = tokens[done]
                out[rows[done], tokens.shape[1] :] = -1
                rows, tokens, ranks, at, low = (x[~done] for x in (rows, tokens, ranks, at, low))
            if not len(rows):
                break
            each = np.arange(len(rows))
            # what stands behind the pair moves up by one
            columns = np.arange(tokens.shape[1] - 1)
            tokens = np.take_along_axis(tokens, columns + (columns > at[:, None]), 1)
            tokens[each, at] = low
            columns = columns[:-1]
            if not len(columns):
                ranks = np.full((len(rows), 1), Pairs.NONE)
                continue
            ranks = np.take_along_axis(ranks, columns + (columns > at[:, None]), 1)
            here = np.flatnonzero(at < len(columns))
            ranks[here, at[here]] = self.pairs.merged(tokens[here, at[here]], tokens[here, at[here] + 1])
            there = np.flatnonzero(at > 0)
            ranks[there, at[there] - 1] = self.pairs.merged(tokens[there, at[there] - 1], tokens[there, at[there]])
        ends = (out >= 0).sum(1)
        flat, cut = out[out >= 0].tolist(), np.cumsum(ends).tolist()
        return [flat[i:j] for i, j in zip([0, *cut], cut)]

    def merge(self, data: bytes) -> list[int]:
        ranks = self.ranks
        if (whole := ranks.get(data)) is not None:
            return [whole]
        parts = [data[i : i + 1] for i in range(len(data))]
        if len(parts) > 200:
            return self.merge_long(parts)
        far = len(ranks) + 1
        pairs = [ranks.get(a + b, far) for a, b in zip(parts, parts[1:])]
        while pairs:
            low = min(pairs)
            if low == far:
                break
            i = pairs.index(low)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i:
                pairs[i - 1] = ranks.get(parts[i - 1] + parts[i], far)
            if i < len(pairs):
                pairs[i] = ranks.get(parts[i] + parts[i + 1], far)
        return [ranks[p] for p in parts]

    def merge_long(self, parts: list[bytes]) -> list[int]:
        """The same by a heap over a linked list, for slices where the plain way would take the square."""
        import heapq

        ranks, n = self.ranks, len(parts)
        after, prior = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, parts[i], parts[i + 1]) for i in range(n - 1) if (r := ranks.get(parts[i] + parts[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if parts[i] is not a or j >= n or parts[j] is not b:
                continue
            parts[i], parts[j] = a + b, None
            after[i] = after[j]
            if after[j] < n:
                prior[after[j]] = i
            for x, y in ((prior[i], i), (i, after[i])):
                if x >= 0 and y < n and (r := ranks.get(parts[x] + parts[y])) is not None:
                    heapq.heappush(heap, (r, x, parts[x], parts[y]))
        return [ranks[p] for p in parts if p is not None]

    def __missing__(self, part: str) -> str:
        return ",".join(map(str, self.merge(part.encode("utf-8", "replace"))))


class Decoder(dict):
    """Ids as decimals joined by commas -> their bytes."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.bytes_of = {str(i): b for b, i in ranks.items()}
        self.before: dict[str, bytes] = {}

    def __missing__(self, ids: str) -> bytes:
        if len(self) >= CACHED:
            self.before = dict(self)
            self.clear()
        if (out := self.before.get(ids)) is None:
            out = b"".join([self.bytes_of[i] for i in ids.split(",")]) if ids else b""
        if len(ids) < 256:
            self[ids] = out
        return out


_models: dict[str, tuple[Encoder, Decoder]] = {}


def models(ranks_file: bytes) -> tuple[Encoder, Decoder]:
    """Caches live as long as the Python worker."""
    key = hashlib.sha256(ranks_file).hexdigest()
    if key not in _models:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks_file.splitlines())}
        _models[key] = Encoder(ranks), Decoder(ranks)
    return _models[key]


def encode_documents(docs: DataFrame, path: str, with_ids: bool = False, with_offsets: bool = False) -> DataFrame:
    """One row a document: token count and digests of the ids and of the decoded bytes.

    with_ids adds ids; with_offsets adds them and, for each slice, where it
    starts in the text (starts, in code points) and where its ids end (ends).
    """
    with_ids = with_ids or with_offsets
    with open(path, "rb") as f:  # a small file of the tokenizer library, on the driver
        ranks_file = docs.sparkSession.sparkContext.broadcast(f.read())
    ddl = SCHEMA + (", ids array<int>" if with_ids else "") + (", starts array<int>, ends array<int>" if with_offsets else "")
    schema = arrow_schema(ddl)

    def run(batches):
        encoder, decoder = models(ranks_file.value)
        for batch in batches:
            doc_ids, texts = batch.column(0), [t or "" for t in batch.column(1).to_pylist()]
            i = 0
            while i < len(texts):
                j, size = i, 0
                while j < len(texts) and (j == i or size + len(texts[j]) <= BLOCK):
                    size += len(texts[j])
                    j += 1
                rows, ids, starts, ends = [], [], [], []
                split = slices(texts[i:j])
                encoder.learn(split)
                for parts in split:
                    coded = [encoder[p] for p in parts]
                    line = ",".join(coded)
                    decoded = hashlib.sha256(b"".join([decoder[c] for c in coded]))
                    rows.append((line.count(",") + 1 if line else 0, hashlib.sha256(line.encode()).hexdigest(), decoded.hexdigest()))
                    if with_ids:
                        ids.append(np.fromstring(line, np.int32, sep=","))
                    if with_offsets:
                        starts.append(np.cumsum([0, *map(len, parts)][:-1], dtype=np.int32) if parts else np.zeros(0, np.int32))
                        ends.append(np.cumsum([c.count(",") + 1 for c in coded], dtype=np.int32))
                columns = [pa.array(list(c), type=f.type) for c, f in zip(zip(*rows), list(schema)[1:4])]
                columns += [_lists(x) for x in ([ids] if with_ids else []) + ([starts, ends] if with_offsets else [])]
                yield pa.record_batch([doc_ids.slice(i, j - i), *columns], schema=schema)
                i = j

    return arrow_map(docs.select("doc_id", "text"), run, ddl)


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(arrays).astype(np.int32))).cast(pa.list_(pa.int32()))


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and text from rows with doc_id, ids and, where there are, starts and ends.

    With offsets each slice is decoded by itself and must begin where it began;
    null ids are no ids; ids that no rank has end the read.
    """
    with open(path, "rb") as f:
        ranks_file = encoded.sparkSession.sparkContext.broadcast(f.read())
    ddl = "doc_id long, text string"
    schema = arrow_schema(ddl)
    sliced = "starts" in encoded.columns

    def run(batches):
        bytes_of = {int(i): b for i, b in models(ranks_file.value)[1].bytes_of.items()}
        for batch in batches:
            texts = []
            for row in zip(*(batch.column(k).to_pylist() for k in range(1, batch.num_columns))):
                ids = row[0] or []
                if not sliced:
                    texts.append(b"".join([bytes_of[i] for i in ids]).decode("utf-8"))
                    continue
                begin = [0, *(row[2] or [])]
                parts = [b"".join([bytes_of[i] for i in ids[a:b]]).decode("utf-8") for a, b in zip(begin, begin[1:])]
                at = 0
                for start, part in zip(row[1] or [], parts):
                    if start != at:
                        raise ValueError(f"a slice that began at {start} decodes to begin at {at}")
                    at += len(part)
                texts.append("".join(parts))
            yield pa.record_batch([batch.column(0), pa.array(texts, pa.string())], schema=schema)

    return arrow_map(encoded.select("doc_id", "ids", *(["starts", "ends"] if sliced else [])), run, ddl)
