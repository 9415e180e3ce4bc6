"""Alignment of two tokenizers' ids over the same bytes, by a dangling-suffix transducer.

Read side by side, one of the two id sequences is ahead at any time; the bytes
by which it is are the residual. The transducer's state is that residual and the
side that leads. The next token of the side behind either uses it up, which
leaves the rest or nothing, or outruns it, so that the other side leads.
Transitions are kept by state and token. An empty residual closes a group. Two
tokens are linked if they share bytes: the token read and the one that leads.

Both tokenizers cut a text where white space ends a word: no token reaches over
the end of a word into a blank (checked for the pieces when they are read, given
by the splitting pattern for the other). So a text is cut there, and each
distinct slice is encoded and aligned once a worker; a text with a slice whose
bytes do not come back is encoded whole, which decides.

How often two ids are linked is counted over the whole corpus. Texts go in
blocks of BLOCK characters. A block brings each of its distinct pairs once, with
its count, to the tables of counts; what comes back meets the block's documents,
kept as compressed arrays of places in the block's list of pairs. So no key has
more rows than there are blocks, and a task holds a block at most.

Defined cases: null and empty texts, and texts whose bytes do not come back from
either side, have no tokens: zeros and an empty digest; long texts are handled
in whole, a block of their own; ties for the highest count all count as best;
repeated rows give repeated results; other columns are ignored; an empty table
gives an empty one.
"""

from __future__ import annotations

import hashlib
import json
import os
import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from entrygraph.llm.common import arrow_map, arrow_schema, give_back, ship, staged

#: Characters of a block of documents, slices that a worker keeps, and transitions.
BLOCK, SLICES, MOVES = 6 << 20, 250_000, 1_000_000
#: Pairs are one number: the first side's id times this, plus the second's.
SIDE = 1 << 20
SCHEMA = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
BLOCKS = "block long, pairs array<long>, times array<long>, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, sha array<string>, cut array<long>, places binary"
WORD_ENDS = re.compile(r"(?<=\S)(?= )")
EMPTY = (0, 0, "", 0, b"")


class Transducer:
    """Aligns two sequences of tokens given by their bytes; transitions are kept by residual and token."""

    def __init__(self, a: list[bytes], b: list[bytes]):
        self.sides = a, b
        self.forget()

    def forget(self) -> None:
        # state 0 is the empty residual; others are (leading side, residual) by number
        self.names: list[tuple[int, bytes]] = [(0, b"")]
        self.numbers: dict[tuple[int, bytes], int] = {(0, b""): 0}
        self.moves: dict[int, int] = {}

    def move(self, state: int, token: int) -> int | None:
        """The state after the side behind (the second if none leads) read ``token``; None if the bytes differ."""
        lead, residual = self.names[state]
        read = self.sides[1 - lead][token]
        if residual.startswith(read):
            name = (lead, residual[len(read) :])
        elif read.startswith(residual):
            name = (1 - lead, read[len(residual) :])
        else:
            return None
        if not name[1]:
            name = (0, b"")
        if (number := self.numbers.get(name)) is None:
            number = self.numbers[name] = len(self.names)
            self.names.append(name)
        return number

    def begun(self, token: int) -> int:
        """The state after the first side read ``token`` with nothing dangling."""
        name = (0, self.sides[0][token])
        if (number := self.numbers.get(name)) is None:
            number = self.numbers[name] = len(self.names)
            self.names.append(name)
        return number

    def align(self, a: list[int], b: list[int]) -> tuple[list[tuple[int, int, int, int]], list[tuple[int, int]]] | None:
        """(groups, links): places from and to on both sides, and linked places; None if the bytes differ."""
        if len(self.moves) > MOVES:
            self.forget()
        groups, links = [], []
        i = j = from_a = from_b = 0
        while i < len(a) and j < len(b):
            # nothing dangles: the first side reads, and leads
            state = self.begun(a[i])
            held_a, held_b = i, None
            i += 1
            while state:
                lead = self.names[state][0]
                if lead == 0:
                    if j >= len(b):
                        return None
                    token, held_b = b[j], j
                    j += 1
                else:
                    if i >= len(a):
                        return None
                    token, held_a = a[i], i
                    i += 1
                links.append((held_a, held_b))
                key = state * SIDE + token
                if (after := self.moves.get(key)) is None:
                    after = self.move(state, token)
                    if after is None:
                        return None
                    self.moves[key] = after
                state = after
            groups.append((from_a, i, from_b, j))
            from_a, from_b = i, j
        return (groups, links) if i == len(a) and j == len(b) else None


def byte_level() -> dict[str, int]:
    """The printable character that byte-level vocabularies write for each byte: itself, or the next from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [i for i in range(256) if i not in set(plain)]
    return {chr(i): i for i in plain} | {chr(256 + k): i for k, i in enumerate(others)}


def _no_utf8(text: str) -> bool:
    try:
        text.encode()
    except UnicodeEncodeError:
        return True
    return False


class Pair:
    """Both tokenizers, and the aligned slices that a worker has seen."""

    def __init__(self, a_json: str, b_model: bytes):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a_json)
        self.a.encode_special_tokens = True
        vocabulary, letters = json.loads(a_json)["model"]["vocab"], byte_level()
        tokens: list[bytes] = [b""] * (1 + max(vocabulary.values()))
        for token, i in vocabulary.items():
            tokens[i] = bytes([letters[c] for c in token]) if all(c in letters for c in token) else token.encode()
        self.b = SentencePieceProcessor(model_proto=b_model)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.blank = self.b.piece_to_id("▁")
        others = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        #: Whether a word's end is a cut of the second side too.
        self.cuts = not any("▁" in p.lstrip("▁") for p in pieces)
        self.tokens = tokens, others
        self.transducer = Transducer(tokens, others)
        self.known: dict[str, tuple | None] = {}
        self.before: dict[str, tuple | None] = {}

    def ids(self, slices: list[str]) -> list[tuple[list[int], list[int]]]:
        """Ids of both sides for texts that begin with a blank each; the second side adds that blank itself."""
        a = [e.ids for e in self.a.encode_batch_fast(slices, add_special_tokens=False)]
        b = self.b.encode([s[1:] for s in slices], num_threads=1)
        return [(x, y if s != " " else [self.blank]) for s, x, y in zip(slices, a, b)]

    def aligned(self, slice_: str, a: list[int], b: list[int]) -> tuple | None:
        """(tokens of both sides, groups as text, how many, links as bytes), or None if the bytes do not come back."""
        data = slice_.encode()
        if b"".join([self.tokens[0][i] for i in a]) != data or b"".join([self.tokens[1][i] for i in b]) != data:
            return None
        if (found := self.transducer.align(a, b)) is None:
            return None
        groups, links = found
        told = ";".join([f"{','.join(map(str, a[w:x]))}|{','.join(map(str, b[y:z]))}" for w, x, y, z in groups])
        return len(a), len(b), told, len(groups), np.array([a[i] * SIDE + b[j] for i, j in links], np.int64).tobytes()

    def learn(self, slices: set[str]) -> None:
        if len(self.known) >= SLICES:
            self.before, self.known = self.known, {}
        new = slices.difference(self.known)
        again = new.intersection(self.before)
        self.known.update({s: self.before[s] for s in again})
        fresh = sorted(new - again)
        for at in range(0, len(fresh), 20_000):
            some = fresh[at : at + 20_000]
            for s, (a, b) in zip(some, self.ids(some)):
                self.known[s] = self.aligned(s, a, b)

    def documents(self, texts: list[str | None]) -> list[tuple]:
        """(tokens of both sides, digest of the groups, how many, links as bytes) of each text."""
        cut = [[] if not t or _no_utf8(t) else WORD_ENDS.split(" " + t) if self.cuts else [" " + t] for t in texts]
        self.learn({s for parts in cut for s in parts})
        known, out = self.known, []
        for text, parts in zip(texts, cut):
            if not parts:
                out.append(EMPTY)
                continue
            found = [known[s] for s in parts]
            if None in found:
                # the whole text decides: a slice alone may not come back where the text does
                whole = " " + text
                found = [self.aligned(whole, *self.ids([whole])[0])]
                if found == [None]:
                    out.append(EMPTY)
                    continue
            a, b, told, groups, links = zip(*found)
            out.append((sum(a), sum(b), hashlib.sha256(";".join(told).encode()).hexdigest(), sum(groups), b"".join(links)))
        return out


_pairs: dict[str, Pair] = {}


def pair_of(a_json: str, b_model: bytes) -> Pair:
    """The tokenizers live as long as the Python worker."""
    key = hashlib.sha256(a_json.encode() + b_model).hexdigest()
    if key not in _pairs:
        _pairs[key] = Pair(a_json, b_model)
    return _pairs[key]


def _packed(numbers: np.ndarray) -> bytes:
    """Small numbers, compressed: low bytes and high bytes apart."""
    raw = numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()
    return len(numbers).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unpacked(data: bytes) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    raw = pa.decompress(data[8:], decompressed_size=4 * n, codec="zstd", asbytes=True) if n else b""
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, n).T).view("<u4").ravel().astype(np.int64)


def _block(block: int, keys: list[int], found: list[tuple]) -> list:
    """A row of BLOCKS: distinct pairs with counts, and the places of each document's links among them."""
    sizes = np.array([len(x[4]) // 8 for x in found], np.int64)
    links = np.frombuffer(b"".join([x[4] for x in found]), np.int64)
    pairs, places = np.unique(links, return_inverse=True)
    times = np.bincount(places, minlength=len(pairs))
    # within a document in order, so that differences are small
    order = np.lexsort((places, np.repeat(np.arange(len(sizes)), sizes)))
    steps = np.diff(places[order], prepend=0)
    starts = (np.cumsum(sizes) - sizes)[sizes > 0]
    steps[starts] = places[order][starts]
    return [block, pairs, times, keys, [x[0] for x in found], [x[1] for x in found], [x[3] for x in found], [x[2] for x in found], sizes, _packed(steps)]


def _blocks(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    context = docs.sparkSession.sparkContext
    with open(a_path, encoding="utf-8") as f, open(b_path, "rb") as g:  # small files of the tokenizers, on the driver
        files = context.broadcast((f.read(), g.read()))
    schema = arrow_schema(BLOCKS)

    def run(batches):
        pair = pair_of(*files.value)
        task, number = TaskContext.get().partitionId(), 0
        keys, found, size = [], [], 0

        def row():
            values = _block(task << 32 | number, keys, found)
            return pa.record_batch([pa.array([v], f.type) for v, f in zip(values, schema)], schema=schema)

        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            at = 0
            while at < len(texts):
                # a part of the batch, such that a block is full or the batch is over
                begin = at
                while at < len(texts) and size < BLOCK:
                    size += len(texts[at] or "")
                    at += 1
                found += pair.documents(texts[begin:at])
                keys += ids[begin:at]
                if size >= BLOCK:
                    yield row()
                    keys, found, size, number = [], [], 0, number + 1
        if keys:
            yield row()

    return arrow_map(docs.select("doc_id", "text"), run, BLOCKS)


def _met(answers: pa.Table, blocks: pa.Table) -> pa.Table:
    """Rows of SCHEMA from a block's documents and what is known of its pairs."""
    schema = arrow_schema(SCHEMA)
    out = []
    for row in blocks.to_pylist():
        n = row["n_pairs"]
        times, best = np.zeros(n, np.int64), np.zeros(n, np.int64)
        at = answers.column("at").to_numpy()
        times[at], best[at] = answers.column("times").to_numpy(), answers.column("best").to_numpy()
        sizes, steps = np.array(row["cut"], np.int64), _unpacked(row["places"])
        starts = np.cumsum(sizes) - sizes
        # running sums begin anew at each document
        run = np.cumsum(steps)
        some = sizes > 0
        first = starts[some]
        places = run - np.repeat(run[first] - steps[first], sizes[some])
        total, top = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
        if len(places):
            total[some], top[some] = np.add.reduceat(times[places], first), np.add.reduceat(best[places], first)
        columns = [row["doc_id"], row["n_a"], row["n_b"], row["n_groups"], sizes, top, total, row["sha"]]
        out.append(pa.table([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema))
    return pa.concat_tables(out) if out else schema.empty_table()


def pair_counts(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """a, b, links and best: how often two ids are linked in the corpus, and whether b is with no other more often."""
    return _counts(staged(_blocks(docs, a_path, b_path))).select(F.shiftright("pair", 20).cast("int").alias("a"), F.col("pair").bitwiseAND(SIDE - 1).cast("int").alias("b"), F.col("times").alias("links"), (F.col("best") == 1).alias("best"))


def _counts(blocks: DataFrame) -> DataFrame:
    """pair, times and best (0 or 1) of each linked pair."""
    each = blocks.select(F.inline(F.arrays_zip("pairs", "times"))).groupBy(F.col("pairs").alias("pair")).agg(F.sum("times").alias("times"))
    # an id of the second side is linked with no more ids than the first side has
    top = F.max("times").over(Window.partitionBy(F.col("pair").bitwiseAND(SIDE - 1)))
    return each.withColumn("best", (F.col("times") == top).cast("long"))


def aligned(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """SCHEMA for each row of ``docs``: tokens of both sides, groups, links, and how often these are met corpus-wide."""
    spark = docs.sparkSession
    ship(spark)
    blocks = staged(_blocks(docs, a_path, b_path))
    counts = staged(_counts(blocks))
    asked = blocks.select(F.col("block").alias("of"), F.posexplode("pairs").alias("at", "pair"))
    answers = asked.join(counts, "pair").select("of", "at", "times", "best")
    payload = blocks.withColumn("n_pairs", F.size("pairs")).drop("pairs", "times")

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        try:
            return _met(left, right)
        finally:
            give_back()

    return answers.groupBy("of").cogroup(payload.groupBy("block")).applyInArrow(meet, SCHEMA)
