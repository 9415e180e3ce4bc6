"""Periodic runs of words, by a suffix automaton whose end positions are merged small to large.

Each text's words are numbered. States of its suffix automaton are visited from
the longest to the shortest, and the ordered end positions of each go into those
of its suffix link, the smaller set into the larger. Where that makes two
positions neighbours that are d apart, and the state's longest string has at
least d words, there is a square of period d, which is extended to the run.

A run of at least ``exponent`` periods holds each of its words that often. So a
text is first cut at the words that it (and then a piece of it) has too few
times: no run is lost, and the automaton is built over what is left only.
States whose strings are too short for any such run are not merged.

Defined cases: a null or empty text has no words and no runs; long texts are
handled in whole; of intervals with several periods the smallest counts; equal
exponents are decided by the smallest start, then period; repeated rows give
repeated results; other columns are ignored; an empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left, bisect_right
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from entrygraph.llm.common import arrow_map, arrow_schema, map_rows

#: A run has at least LEAST words and EXPONENT periods.
LEAST, EXPONENT = 6, 4
#: Cuts of a piece before the automaton takes what is left as it is.
CUTS = 30
SCHEMA = "doc_id long, n_words long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
RUNS = "doc_id long, start long, length long, period long"


class Automaton:
    """The suffix automaton of a sequence: length, suffix link and first end position of each state."""

    def __init__(self, sequence: list[int]):
        length, link, first, following = [0], [-1], [-1], [{}]
        last = 0
        for at, x in enumerate(sequence):
            here = len(length)
            length.append(length[last] + 1)
            first.append(at)
            following.append({})
            link.append(0)
            p = last
            while p >= 0 and x not in following[p]:
                following[p][x] = here
                p = link[p]
            if p >= 0:
                q = following[p][x]
                if length[q] == length[p] + 1:
                    link[here] = q
                else:
                    clone = len(length)
                    length.append(length[p] + 1)
                    first.append(-1)
                    following.append(following[q].copy())
                    link.append(link[q])
                    while p >= 0 and following[p].get(x) == q:
                        following[p][x] = clone
                        p = link[p]
                    link[q] = link[here] = clone
            last = here
        self.length, self.link, self.first = length, link, first

    def squares(self, least: int):
        """(end, period, length): the words up to ``end`` have the period over length + period words.

        Only states with strings of ``least`` words and more are merged.
        """
        length, link = self.length, self.link
        ends: list[list[int] | None] = [[e] if e >= 0 else [] for e in self.first]
        for v in sorted(range(1, len(length)), key=length.__getitem__, reverse=True):
            up, mine = link[v], ends[v]
            ends[v] = None
            size = length[up]
            if size < least or not mine:
                continue
            held = ends[up]
            if len(held) < len(mine):
                held, mine = mine, held
            ends[up] = held
            for e in mine:
                at = bisect_left(held, e)
                if at and e - held[at - 1] <= size:
                    yield e, e - held[at - 1], size
                if at < len(held) and held[at] - e <= size:
                    yield held[at], held[at] - e, size
                held.insert(at, e)


def _runs(s: list[int], least: int, exponent: int) -> list[tuple[int, int, int]]:
    """Runs of one piece: squares extended as far as they go, each interval with its smallest period."""
    n = len(s)
    found: dict[tuple[int, int], int] = {}
    known: dict[int, tuple[list[int], list[int]]] = {}
    # a run of period q repeats a string of its length less q
    shortest = min(max(least, exponent * q) - q for q in range(1, least + 1))
    for end, d, size in Automaton(s).squares(shortest):
        start = end - d - size + 1
        begins, stops = known.setdefault(d, ([], []))
        at = bisect_right(begins, start) - 1
        if at >= 0 and stops[at] >= end:
            continue
        while start and s[start - 1] == s[start - 1 + d]:
            start -= 1
        while end + 1 < n and s[end + 1] == s[end + 1 - d]:
            end += 1
        at = bisect_left(begins, start)
        begins.insert(at, start)
        stops.insert(at, end)
        if d < found.get((start, end), n + 1):
            found[start, end] = d
    return [(i, j - i + 1, q) for (i, j), q in found.items() if j - i + 1 >= max(least, exponent * q)]


def _pieces(ids: np.ndarray, least: int, exponent: int):
    """(from, words) of what is left of a text when cut at words that are too rare for a run."""
    todo = [(0, ids, 0)]
    while todo:
        begin, part, cuts = todo.pop()
        rare = np.flatnonzero(np.bincount(part)[part] < exponent) if cuts == 0 else None
        if rare is None:
            listed = part.tolist()
            times = Counter(listed)
            rare = [i for i, x in enumerate(listed) if times[x] < exponent] if min(times.values()) < exponent else []
            rare = np.array(rare, np.int64)
        if not len(rare) or cuts >= CUTS:
            if len(part) >= least:
                yield begin, part.tolist()
            continue
        edges = np.concatenate([[-1], rare, [len(part)]])
        wide = np.flatnonzero(np.diff(edges) > least)
        todo += [(begin + int(edges[k]) + 1, part[edges[k] + 1 : edges[k + 1]], cuts + 1) for k in wide.tolist()]


def runs_of(words: list, least: int = LEAST, exponent: int = EXPONENT) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of at least ``least`` words and ``exponent`` periods, by start, then period."""
    if exponent < 3:
        raise ValueError("below three periods a run's ends need not become neighbours")
    if len(words) < least:
        return []
    first = {w: i for i, w in enumerate(dict.fromkeys(words))}
    if len(first) > len(words) - exponent + 1:
        return []
    ids = np.fromiter(map(first.__getitem__, words), np.int64, len(words))
    out = [(begin + i, n, q) for begin, part in _pieces(ids, least, exponent) for i, n, q in _runs(part, least, exponent)]
    return sorted(out, key=lambda r: (r[0], r[2]))


def planted(words: list[bytes], doc_id: int) -> list[bytes]:
    """The words as the query wants them: the tail of every tenth document, by a hash of its id, made periodic."""
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def collapsed(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words without what repeats a run's first period."""
    if not runs:
        return words
    keep = np.ones(len(words), bool)
    for start, length, period in runs:
        keep[start + period : start + length] = False
    return [words[i] for i in np.flatnonzero(keep).tolist()]


def summary(words: list[bytes], least: int = LEAST, exponent: int = EXPONENT) -> tuple:
    """Count of words and runs, the run with most periods, and the digests of all runs and of the collapsed text."""
    runs = runs_of(words, least, exponent)
    best: tuple = (None, None, None)
    for r in runs:
        if best[0] is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    milli = None if best[0] is None else 1000 * best[1] // best[2]
    lines = "".join([f"{i},{n},{q}\n" for i, n, q in runs])
    kept = b" ".join(collapsed(words, runs))
    return (len(words), len(runs), *best, milli, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def _words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").split()


def run_report(docs: DataFrame, plant: bool = False, least: int = LEAST, exponent: int = EXPONENT) -> DataFrame:
    """SCHEMA for each row of ``docs``; ``plant`` makes the tails periodic first that the query asks for."""

    def make():
        def one(k, t):
            words = _words(t)
            return (k, *summary(planted(words, k) if plant else words, least, exponent))

        return one

    return map_rows(docs, ["doc_id", "text"], make, SCHEMA, arrow_schema(SCHEMA))


def all_runs(docs: DataFrame, least: int = LEAST, exponent: int = EXPONENT) -> DataFrame:
    """One row a run: doc_id, start (word number from 0), length and period in words."""
    schema = arrow_schema(RUNS)

    def run(batches):
        for batch in batches:
            rows = [(k, *r) for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for r in runs_of(_words(t), least, exponent)]
            if rows:
                yield pa.record_batch([pa.array(list(c), pa.int64()) for c in zip(*rows)], schema=schema)

    return arrow_map(docs.select("doc_id", "text"), run, RUNS)


def collapse(docs: DataFrame, least: int = LEAST, exponent: int = EXPONENT) -> DataFrame:
    """``docs`` with all its columns, texts that hold a run without its repetitions (words joined by blanks then)."""
    def shorter(text):
        if text is None:
            return None
        words = _words(text)
        runs = runs_of(words, least, exponent)
        return b" ".join(collapsed(words, runs)).decode() if runs else text

    def run(batches):
        for batch in batches:
            at = batch.schema.get_field_index("text")
            texts = pa.array([shorter(t) for t in batch.column(at).to_pylist()], batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays([texts if i == at else c for i, c in enumerate(batch.columns)], names=batch.schema.names)

    return arrow_map(docs, run, docs.schema)
