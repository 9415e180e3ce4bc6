"""Quality rules by weak supervision.

Each rule votes good (1), bad (-1) or abstains (0) on a document. Expectation
maximisation over the counts of all vote patterns estimates, without labels,
how often each rule votes right for good and for bad documents; the posterior
probability of good quality then decides, instead of a list of filters that
all must pass. There are at most 3**9 = 19683 patterns, whatever the corpus, so
their counts are the only thing the driver sees.

Defined cases: a null text counts as no words; empty and short texts (under 50
words) fail; repeated rows are judged alike, each on its own; an empty table
gives an empty result; columns besides doc_id and text are carried by
``keep_good`` and ignored by ``score_quality``.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from entrygraph.llm.common import arrow_map, arrow_schema, map_rows, staged

FEATURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, n_upper long, n_letters long, n_digits long, n_closed long, n_symbol_words long"
RULES = ("length", "symbols", "dup_lines", "repeats", "word_length", "upper", "digits", "closed", "symbol_words")
#: Votes of a class below this many documents do not move a rule's accuracy far: add-one smoothing.
SMOOTH, ROUNDS, PRIOR = 1.0, 200, 0.8
#: Where iteration starts: the shares of bad, no and good votes on bad and on good documents. Each
#: kind of bad text sets off a few of the rules; on good text bad votes are rare.
START = ((0.4, 0.1, 0.5), (0.002, 0.098, 0.9))
KEEP_FROM = 0.5
#: What the names of columns begin with that are put beside a caller's own.
MARK = "_quality_"

_SPACE = b" \t\n\x0b\x0c\r"
_SYMBOLS = b"#*$%&|<>"
_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_DIGITS = bytes(range(48, 58))


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window found at least twice in ``words``."""
    n = len(words)
    if n < 4:
        return 0
    first = {w: i for i, w in enumerate(dict.fromkeys(words))}
    if len(first) == n:
        return 0
    ids = np.fromiter(map(first.__getitem__, words), np.int64, n)
    # pairs are renumbered before the third word is joined, so no product leaves 64 bits
    pairs = ids[:-1] * len(first) + ids[1:]
    if len(first) > 2_000_000:
        pairs = np.unique(pairs, return_inverse=True)[1].astype(np.int64)
    windows = pairs[:-1] * len(first) + ids[2:]
    order = np.argsort(windows, kind="stable")
    same = windows[order][1:] == windows[order][:-1]
    if not same.any():
        return 0
    twice = np.zeros(n - 2, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(n, bool)
    for k in range(3):
        covered[k : n - 2 + k] |= twice
    return int(covered.sum())


def features(text: str | None) -> tuple:
    """What the rules look at, in the order of FEATURES."""
    data = (text or "").encode()
    words = data.split()
    without = lambda s: len(data) - len(data.translate(None, s))
    seen: set[bytes] = set()
    dup = lines = closed = 0
    for line in data.split(b"\n"):
        if bare := line.strip():
            lines += 1
            closed += bare[-1] in b".!?\"'):;"
            dup += line in seen
            seen.add(line)
    symbols, upper = without(_SYMBOLS), without(_UPPER)
    marked = sum(len(w.translate(None, _SYMBOLS)) < len(w) for w in words) if symbols else 0
    return (len(words), len(text or "") - without(_SPACE), symbols, dup, repeated_words(words), lines, upper, upper + without(_LOWER), without(_DIGITS), closed, marked)


def _votes(mark: str = "") -> list:
    """One column of -1, 0 or 1 for each of RULES, from features whose names begin with ``mark``."""
    c = lambda name: F.col(mark + name)
    vote = lambda bad, good: F.when(bad, -1).when(good, 1).otherwise(0)
    none = c("n_words") == 0
    return [
        vote(c("n_words") < 50, c("n_words") >= 80),
        vote(c("n_symbols") * 100 > c("n_words") * 10, c("n_symbols") * 100 < c("n_words") * 4),
        vote((c("n_dup_lines") > 1) & (c("n_dup_lines") * 100 > c("n_lines") * 30), (c("n_lines") > 2) & (c("n_dup_lines") * 100 < c("n_lines") * 10)),
        vote(c("n_repeat_words") * 100 > c("n_words") * 40, ~none & (c("n_repeat_words") * 100 < c("n_words") * 15)),
        vote(none | (c("word_chars") < c("n_words") * 3) | (c("word_chars") > c("n_words") * 12), ~none),
        vote(c("n_upper") * 100 > c("n_letters") * 30, (c("n_letters") > 0) & (c("n_upper") * 100 < c("n_letters") * 12)),
        vote(c("n_digits") * 100 > c("word_chars") * 15, ~none & (c("n_digits") * 100 < c("word_chars") * 4)),
        vote((c("n_lines") > 0) & (c("n_closed") * 100 < c("n_lines") * 30), (c("n_lines") > 0) & (c("n_closed") * 100 >= c("n_lines") * 60)),
        vote(c("n_symbol_words") * 100 > c("n_words") * 10, ~none & (c("n_symbol_words") * 100 < c("n_words") * 4)),
    ]


def fit(patterns: list[tuple[tuple[int, ...], int]]) -> dict:
    """Expectation maximisation over (votes, count); gives the log odds of the prior and of each vote.

    Rules are taken as independent given the quality. START also
    fixes which of the two classes is called good.
    """
    k = len(RULES)
    votes = np.array([p for p, _ in patterns], int).reshape(-1, k)
    counts = np.array([n for _, n in patterns], float)
    prior = PRIOR
    # [class good?][rule][vote + 1]: the share of documents of the class that get the vote
    rate = np.array([[START[0]] * k, [START[1]] * k])
    index = np.arange(k)
    for _ in range(ROUNDS if len(counts) else 0):
        log = np.stack([np.log(p) + np.log(rate[c][index, votes + 1]).sum(1) for c, p in ((0, 1 - prior), (1, prior))], 1)
        log -= log.max(1, keepdims=True)
        post = np.exp(log)
        post = post[:, 1] / post.sum(1)
        prior = (counts @ post + SMOOTH) / (counts.sum() + 2 * SMOOTH)
        fresh = np.empty_like(rate)
        for c, w in ((0, counts * (1 - post)), (1, counts * post)):
            for v in (-1, 0, 1):
                fresh[c, :, v + 1] = ((votes == v) * w[:, None]).sum(0) + SMOOTH
        fresh /= fresh.sum(2, keepdims=True)
        done = np.abs(fresh - rate).max() < 1e-9
        rate = fresh
        if done:
            break
    return {"prior": math.log(prior / (1 - prior)), "odds": np.log(rate[1] / rate[0]).tolist()}


def _judged(found: DataFrame, model: dict, mark: str = "") -> DataFrame:
    """``found`` (with the features and votes) with p_good, base_failed and kept."""
    odds = F.lit(model["prior"])
    for i, by_vote in enumerate(model["odds"]):
        v = F.col(mark + "votes")[i]
        odds = odds + F.when(v == -1, by_vote[0]).when(v == 0, by_vote[1]).otherwise(by_vote[2])
    words = F.col(mark + "n_words")
    failed = (words < 50) | (F.col(mark + "n_repeat_words") * 100 > words * 50)
    return found.withColumn(mark + "p_good", 1 / (1 + F.exp(-odds))).withColumn(mark + "base_failed", failed).withColumn(mark + "kept", ~failed & (F.col(mark + "p_good") >= KEEP_FROM))


def _fitted(found: DataFrame) -> dict:
    return fit([(tuple(r[0]), r[1]) for r in found.groupBy("votes").count().collect()])


def score_quality(docs: DataFrame) -> DataFrame:
    """doc_id, the features, the posterior p_good, base_failed and kept, for each row of ``docs``."""
    schema = f"doc_id long, {FEATURES}"
    found = map_rows(docs, ["doc_id", "text"], lambda: (lambda k, t: (k, *features(t))), schema, arrow_schema(schema))
    found = staged(found.withColumn("votes", F.array(*_votes())))
    return _judged(found, _fitted(found))


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""
    names = [part.split()[0] for part in FEATURES.split(", ")]
    plain = arrow_schema(FEATURES)
    votes = map_rows(docs, ["text"], lambda: features, FEATURES, plain)
    model = _fitted(votes.select(F.array(*_votes()).alias("votes")))
    schema = StructType([*docs.schema.fields, *[StructField(MARK + n, LongType()) for n in names]])

    def widen(batches):
        for batch in batches:
            if batch.num_rows:
                found = zip(*[features(t) for t in batch.column(batch.schema.get_field_index("text")).to_pylist()])
                columns = [*batch.columns, *[pa.array(list(c), pa.int64()) for c in found]]
                yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, *[MARK + n for n in names]])

    wide = arrow_map(docs, widen, schema).withColumn(MARK + "votes", F.array(*_votes(MARK)))
    return _judged(wide, model, MARK).filter(MARK + "kept").select(*docs.columns)
