"""SimHash near-duplicates with Golay-code keys.

A text's fingerprint has 64 bits, by majority over the XXH64 of its shingles.
Two fingerprints link at MOST differing bits or fewer. Distinct fingerprints
are cut in segments of 23, 23 and 18 bits. With two errors among three segments
one segment is free of errors; another segment, decoded with the binary Golay
code, gives the indices of all codewords within 4 bits of it (one or six), and
two words at most 2 bits apart always share such a codeword: the word halfway
between them lies within 3 of a codeword, so both lie within 4 of it. Each
fingerprint therefore gets keys (error-free segment, codeword index); equal
keys make candidates and the full fingerprints verify them.

Where a key holds more than PAIRED fingerprints, its pairs would grow with the
square of its size. There each member is linked through the words one bit away
(64 and itself): two fingerprints are within 2 bits just if they share such a
word, and a star around the least member joins all that share it. That is the
same set of links' closure, in linear space.

Defined cases: a null text is empty; an empty text (no words) has fingerprint
zero and is linked like any other; a text with fewer words than a shingle has
one shingle, the whole sequence; repeated rows share a fingerprint; a null
doc_id takes part but is never the smallest unless alone; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import itertools
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entrygraph.llm.common import arrow_map, arrow_schema, carried, join_checked, join_hot, map_rows, released, staged

SEED, MOST, PAIRED = 42, 2, 32
#: The Golay code's generator polynomial (a fixed value) and its length and check bits.
GENERATOR, LENGTH, CHECK = 0b110001110101, 23, 11


def fingerprint(text: str | None, size: int) -> int:
    """The majority of each bit over the hashes of all shingles of ``size`` words, repeats included."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    whole = b" ".join(words)
    if len(words) <= size:
        return xxhash.xxh64_intdigest(whole, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    digest = xxhash.xxh64_intdigest
    return majority(np.array([digest(whole[a:b], SEED) for a, b in zip(starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist())], np.uint64))


def majority(hashes: np.ndarray) -> int:
    """The bits set in over half of the hashes."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 14):  # bounded working memory for very long texts
        ones += np.unpackbits(hashes[at : at + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, size: int) -> DataFrame:
    """doc_id and fp (the 64 bits as a signed long)."""
    ddl = "doc_id long, fp long"
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    return map_rows(docs, ["doc_id", "text"], lambda: (lambda k, t: (k, signed(fingerprint(t, size)))), ddl, arrow_schema(ddl))


def remainder(words: np.ndarray) -> np.ndarray:
    """The 11 check bits of 23-bit words."""
    w = words.astype(np.int64)
    for bit in range(LENGTH - 1, CHECK - 1, -1):
        w = np.where(w >> bit & 1, w ^ (GENERATOR << (bit - CHECK)), w)
    return w


@lru_cache(1)
def decoding() -> np.ndarray:
    """For each syndrome up to six error patterns that lead to a codeword within 4 bits; -1 where there is none."""
    out = np.full((1 << CHECK, 6), -1, np.int64)
    filled = np.zeros(1 << CHECK, int)
    for weight in range(5):
        for places in combinations(range(LENGTH), weight):
            pattern = sum(1 << p for p in places)
            s = int(remainder(np.array([pattern]))[0])
            out[s, filled[s]] = pattern
            filled[s] += 1
    return out


def codewords(words: np.ndarray) -> np.ndarray:
    """Indices of the codewords within 4 bits of each 23-bit word, -1 for none."""
    patterns = decoding()[remainder(words)]
    near = words.astype(np.int64)[:, None] ^ patterns
    return np.where(patterns >= 0, near >> CHECK, -1)


def golay_keys(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) for the three ways to pick the error-free segment."""
    u = fp.astype(np.int64).view(np.uint64)
    a, b, c = (u & np.uint64(0x7FFFFF)).astype(np.int64), (u >> np.uint64(23) & np.uint64(0x7FFFFF)).astype(np.int64), (u >> np.uint64(46)).astype(np.int64)
    rows, keys = [], []
    for n, (exact, loose) in enumerate(((a, b), (b, a), (c, a))):
        near = codewords(loose)
        r, k = np.nonzero(near >= 0)
        rows.append(r)
        keys.append(np.int64(n) << 36 | exact[r] << 12 | near[r, k])
    return np.concatenate(rows), np.concatenate(keys)


def _keyed(fps: DataFrame) -> DataFrame:
    ddl = "key long, fp long"
    schema = arrow_schema(ddl)

    def run(batches):
        for batch in batches:
            fp = batch.column(0).to_numpy()
            if len(fp):
                rows, keys = golay_keys(fp)
                yield pa.record_batch([pa.array(keys), pa.array(fp[rows])], schema=schema)

    return arrow_map(fps.select("fp"), run, ddl)


def links(fps: DataFrame) -> DataFrame:
    """Edges (a, b) with a < b between distinct fingerprints such that linked ones are connected."""
    keyed = staged(_keyed(fps))
    counted = keyed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    held = keyed.join(counted, "key")
    small = held.filter(F.col("n") <= PAIRED).select("key", "fp")
    pairs = (
        small.select("key", F.col("fp").alias("a"))
        .join(small.select("key", F.col("fp").alias("b")), "key")
        .filter((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MOST))
        .select("a", "b")
    )
    large = held.filter(F.col("n") > PAIRED).select("fp").distinct()
    flips = F.array(F.lit(0).cast("long"), *[F.lit((1 << i) - (1 << 64 if i == 63 else 0)).cast("long") for i in range(64)])
    around = large.select("fp", F.explode(F.transform(flips, lambda x: x.bitwiseXOR(F.col("fp")))).alias("mid"))
    least = around.groupBy("mid").agg(F.min("fp").alias("a"), F.count("*").alias("n")).filter("n > 1").select("mid", "a")
    stars = around.join(least, "mid").filter("a < fp").select("a", F.col("fp").alias("b"))
    return pairs.unionByName(stars).distinct()


def components(edges: DataFrame) -> DataFrame:
    """node and root (the least node reachable) for the nodes of ``edges`` (a, b).

    Alternating large and small stars: every round replaces the edges by as
    many or fewer that point to smaller nodes, until each component is a star.
    Only the number of edges that changed reaches the driver.
    """
    edges = staged(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct())
    if edges.isEmpty():
        return edges.select(F.col("a").alias("node"), F.col("a").alias("root"))
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # a star's centre may have most of the edges
        least = staged(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"), F.count_if(F.col("b") > F.col("a")).alias("times")).filter("times > 0"))
        large = join_hot(both.filter("b > a"), least, "a", "times").select(F.col("m").alias("a"), "b").distinct()
        down = large.filter("a < b")
        least = down.groupBy("b").agg(F.min("a").alias("m"))
        moved = down.join(least, "b")
        small = moved.select(F.col("m").alias("a"), F.col("b")).unionByName(moved.filter("a <> m").select(F.col("m").alias("a"), F.col("a").alias("b")))
        fresh = staged(small.filter("a < b").distinct())
        # done when every node has one edge and no root points on
        done = fresh.groupBy("b").count().filter("count > 1").isEmpty() and fresh.join(fresh.select(F.col("b").alias("a")), "a", "left_semi").isEmpty()
        edges = fresh
        if done:
            break
    roots = edges.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return roots.unionByName(edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())


def near_duplicates(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, fp and component_id (the smallest doc_id reachable) for each row of ``docs``."""
    fp = staged(fingerprints(docs, size))
    own = staged(fp.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")))
    rooted = staged(components(links(own.select("fp"))))
    linked_fps = staged(rooted.join(own, rooted["node"] == own["fp"]).select("fp", "root", "least", "n"))
    classes = staged(linked_fps.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("fps")))
    # neither a fingerprint of many rows nor a class of many fingerprints meets its result in one task
    many = join_hot(linked_fps, classes, "root", "fps").select("fp", "component_id", "n")
    alone = own.join(rooted, own["fp"] == rooted["node"], "left_anti").select("fp", F.col("least").alias("component_id"), "n")
    return join_hot(fp, staged(many.unionByName(alone)), "fp", "n").select("doc_id", "fp", "component_id")


# near copies by shingle similarity: prefix keys, candidates' components, exact classes within them

SIMILAR = 0.8
#: Documents of a block that is compared in one task.
BLOCK = 256
#: Pairs for each member of a key from which pivots are sent, rounds of them at least, and members to a part of a key.
PAIRS_EACH, LEAST_TURNS, SPLIT = 32, 3, 4096


def prefix(n):
    """How many of a set's n members, in any order common to all sets, hold one in common with each similar set."""
    return n - np.ceil(SIMILAR * n - 1e-9).astype(np.int64) + 1


def _shingle_hashes(text: str | None, size: int) -> np.ndarray:
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    whole = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - size + 1)
    last = ends[min(size, len(words)) - 1 :]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(whole[a:b], SEED) for a, b in zip(starts[:n].tolist(), last.tolist())], np.uint64)


def _signed(values: np.ndarray) -> list[int]:
    return values.view(np.int64).tolist()


def near_copies(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, th and root for each row of ``docs`` with words: root is the class of its near copies.

    Two documents link if their texts are equal or the similarity of their sets
    of shingles (shared by all) is at least SIMILAR. Fingerprints and their Golay
    keys join first what is within MOST bits, and an exact check follows; these
    classes stay together. What fingerprints further apart may link is looked for
    by the shingles themselves, so that no link is lost. Two such sets share a
    member among the first ``prefix`` of each, in whatever order, as long as it
    is the same for all, and k among the first ``prefix`` - 1 + k. The order by
    hash, with k as large as the prefix itself (as the least partner's, when
    counted), finds the documents that may have a partner; for these the order
    is anew by how many of them hold a shingle, rarest first. What meets by
    such keys is joined to blocks, and within a block the similarities
    themselves decide.
    """
    ddl = "doc_id long, th long, node long, fp long, need long, first array<long>"
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    keyed = docs.select("doc_id", F.xxhash64("text").alias("th"), F.xxhash64("doc_id", "text").alias("node"), "text")

    def one(doc_id, th, node, text):
        every = _shingle_hashes(text, size)
        h = np.unique(every)
        if not len(h):
            return doc_id, th, node, None, None, None
        n = np.int64(len(h))
        return doc_id, th, node, signed(majority(every)), int(prefix(n - prefix(n) + 1)), _signed(h[: 2 * prefix(n) - 1])

    read = staged(map_rows(keyed, ["doc_id", "th", "node", "text"], lambda: one, ddl, arrow_schema(ddl)).filter("first is not null"))
    # the least node stands for all of equal texts
    texts = staged(read.groupBy("th").agg(F.min("node").alias("one"), F.min("need").alias("need"), F.min("fp").alias("fp")))
    # one exchange for both sides: those two texts hold, and who holds them
    keys = read.select("th", F.explode("first").alias("h")).repartition("h")
    shared = keys.groupBy("h").agg(F.min("th").alias("x"), F.max("th").alias("y")).filter("x <> y").select("h")
    told = keys.join(shared, "h").groupBy("th").agg(F.count("*").alias("n_shared"))
    met = staged(told.join(texts, "th").filter("n_shared >= need").select(F.col("one").alias("node")))
    company = _company(keyed, met, size)
    seeds = _by_fingerprints(texts.select(F.col("one").alias("node"), "fp"), company)
    company = staged(company.join(seeds.withColumnRenamed("root", "seed"), "node", "left").withColumn("seed", F.coalesce("seed", "node")))
    rooted = staged(_classes(company)).withColumnRenamed("node", "one")
    return read.select("doc_id", "th", "node").join(texts.select("th", "one"), "th").join(rooted, "one", "left").select("doc_id", "th", "node", F.coalesce("root", "one").alias("root"))


def _company(keyed: DataFrame, met: DataFrame, size: int) -> DataFrame:
    """node, n, held, n_keys for the documents ``met`` that may have a partner among them.

    ``n`` counts the shingles, ``held`` are those that others of ``met`` hold
    too, rarest first; the first ``n_keys`` of them lie in the prefix. The
    shingles nobody else holds come before and are only counted.
    """
    ddl = "node long, n long, hashes array<long>"

    def one(node, text):
        h = np.unique(_shingle_hashes(text, size))
        return node, len(h), _signed(h)

    texts = join_checked(keyed.select("node", "text"), met, ["node"], "left_semi").dropDuplicates(["node"])
    sets = staged(map_rows(texts, ["node", "text"], lambda: one, ddl, arrow_schema(ddl)))
    shingles = sets.select("node", F.explode("hashes").alias("h")).repartition("h")
    counted = shingles.groupBy("h").agg(F.count("node").alias("df")).filter("df > 1")
    held = shingles.join(counted, "h").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("df", "h"))).h.alias("held")).join(sets.select("node", "n"), "node")
    n_keys = F.size("held") - F.ceil(SIMILAR * F.col("n") - 1e-9) + 1
    return staged(held.withColumn("n_keys", n_keys.cast("int")).filter("n_keys > 0"))


def _by_fingerprints(texts: DataFrame, company: DataFrame) -> DataFrame:
    """node and root of documents of ``company`` whose fingerprints (in ``texts``) link and whose sets are similar enough.

    Equal fingerprints are checked against their least document, linked ones by
    their least documents. The root is the least document linked to the node, or
    the node itself: all of one root are linked by it. Roots linked to others are
    found again by the shingles, so that no rounds of components are run here.
    """
    held = staged(texts.join(company.select("node"), "node"))
    own = staged(held.groupBy("fp").agg(F.min("node").alias("least"), F.count("*").alias("times")))
    equal = join_hot(held, own, "fp", "times").filter("least <> node").select(F.col("least").alias("a"), F.col("node").alias("b"))
    named = lambda x: own.select(F.col("fp").alias(x), F.col("least").alias(f"{x}_node"))
    near = links(own.select("fp")).join(named("a"), "a").join(named("b"), "b").select(F.col("a_node").alias("a"), F.col("b_node").alias("b"))
    found = _similar(staged(equal.unionByName(near).distinct()), company).select(F.least("a", "b").alias("root"), F.greatest("a", "b").alias("node"))
    return found.unionByName(found.select("root", F.col("root").alias("node"))).groupBy("node").agg(F.min("root").alias("root"))


def _classes(company: DataFrame) -> DataFrame:
    """node and root for the documents that meet others; linked ones, and those of one seed, have one root.

    Documents that meet by keys, directly or over others, make a block. Blocks
    of at most BLOCK documents are compared in one task each, larger ones by
    pivots over all tasks.
    """
    keys = staged(company.select("node", F.explode(F.slice("held", F.lit(1), F.col("n_keys"))).alias("h")))
    least = keys.groupBy("h").agg(F.min("node").alias("a"), F.count("*").alias("n")).filter("n > 1").select("h", "a")
    blocks = staged(components(keys.join(least, "h").select("a", F.col("node").alias("b")).filter("a < b").distinct()))
    sizes = staged(blocks.groupBy(F.col("root").alias("block")).agg(F.count("*").alias("times")))
    rows = staged(join_hot(blocks.withColumnRenamed("root", "block"), sizes.withColumn("n_block", F.col("times")), "block", "times"))
    small = company.join(rows.filter(F.col("n_block") <= BLOCK), "node").select("block", "node", "n", "seed", "held")
    ddl = "node long, root long"
    schema = arrow_schema(ddl)

    def closed(parts):
        node, n, seed, lengths, held = (np.concatenate(x) for x in zip(*parts))
        return pa.record_batch([pa.array(node), pa.array(node[linked(n, lengths, held, seed)])], schema=schema)

    def run(batches):
        parts, now = [], None
        for batch in batches:
            block, node, n, seed = (batch.column(i).to_numpy() for i in range(4))
            lengths, held = np.diff(batch.column(4).offsets.to_numpy()), batch.column(4).flatten().to_numpy()
            at = np.concatenate([[0], np.cumsum(lengths)])
            cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(block)]
            for i, j in zip(cuts, cuts[1:]):
                if i == j:
                    continue
                if parts and block[i] != now:
                    yield closed(parts)
                    parts = []
                now = block[i]
                parts.append((node[i:j], n[i:j], seed[i:j], lengths[i:j], held[at[i] : at[j]].copy()))
        if parts:
            yield closed(parts)

    found = arrow_map(small.repartition("block").sortWithinPartitions("block"), run, ddl)
    large = rows.filter(F.col("n_block") > BLOCK).select("node")
    if large.isEmpty():
        return found
    return found.unionByName(_by_pivots(staged(company.join(large, "node", "left_semi"))))


def _by_pivots(company: DataFrame) -> DataFrame:
    """The same for documents of large blocks, without a block or a key in one task.

    Each round, every key in which more than one class is left sends one of its
    documents, the pivot, against its members of other classes, and takes it
    out of the key, as its pairs there are decided. The pivot is the member with
    the most links so far, so that a text from which many were copied is found.
    Copies so join in a few rounds, each with as many pairs as the keys have
    members. When the pairs that are left between classes are few, or get no
    fewer, all of them are verified.
    """
    sets = staged(company.select("node", "n", "held"))
    posts = company.select("node", "n", (F.col("n") - F.size("held")).alias("lone"), F.posexplode(F.slice("held", F.lit(1), F.col("n_keys"))).alias("at", "h"))
    posts = staged(posts)
    found = staged(company.filter("seed <> node").select(F.col("seed").alias("a"), F.col("node").alias("b")))
    classes = company.select("node", F.col("seed").alias("root"))
    before = None
    for turn in itertools.count():
        linked_to = found.select(F.col("a").alias("node")).unionByName(found.select(F.col("b").alias("node"))).groupBy("node").agg(F.count("*").alias("links"))
        now = staged(posts.join(classes, "node").join(linked_to, "node", "left").withColumn("links", F.coalesce("links", F.lit(0))))
        by_class = now.groupBy("h", "root").agg(F.count("*").alias("c"))
        members, c = F.sum("c"), F.col("c")
        keys = by_class.groupBy("h").agg(members.alias("times"), ((members * members - F.sum(c * c)) / 2).alias("apart"), F.max_by("root", "c").alias("main"))
        open_ = staged(keys.filter("apart > 0").withColumn("members", F.col("times")))
        left, posted = open_.agg(F.sum("apart"), F.sum("times")).first()
        if not left:
            return classes
        held = staged(join_hot(now, open_.drop("apart"), "h", "times"))
        last = left <= PAIRS_EACH * posted or (turn >= LEAST_TURNS and left > before / 2)
        if last:
            pairs = _apart(held)
        else:
            order = F.struct("links", F.xxhash64("node", F.lit(turn)).alias("draw"))
            picked = staged(held.groupBy("h").agg(F.max_by(F.struct("node", "root"), order).alias("p"), F.max("members").alias("times")))
            met = staged(join_hot(held, picked, "h", "times"))
            pairs = met.filter("root <> p.root").select(F.col("p.node").alias("a"), F.col("node").alias("b"))
            posts = met.filter("node <> p.node").select("node", "n", "lone", "at", "h")
        found = staged(found.unionByName(_similar(staged(pairs.distinct()), sets)))
        joined = staged(components(found))
        classes = staged(sets.select("node").join(joined, "node", "left").select("node", F.coalesce("root", "node").alias("root")))
        if last:
            return classes
        before = left


def _apart(held: DataFrame) -> DataFrame:
    """Pairs (a, b) of members of a key in different classes, but those whose sizes or places rule similarity out.

    The first has no document of the key's main class; it is sent to each of the
    parts that the key's members are split into.
    """
    parts = F.ceil(F.col("members") / SPLIT).cast("int")
    named = lambda x: [F.col(c).alias(f"{x}_{c}") for c in ("node", "n", "lone", "at", "root")]
    a = held.filter("root <> main").select("h", *named("a"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"))
    b = held.select("h", "main", *named("b"), F.pmod(F.xxhash64("node"), parts).cast("int").alias("part"))
    met = a.join(b, ["h", "part"]).filter("a_root <> b_root and (b_root = main or a_node < b_node)")
    # members stand in one order: before the key and behind it no more can be shared than the shorter part holds
    behind = lambda x: F.col(f"{x}_n") - F.col(f"{x}_lone") - F.col(f"{x}_at") - 1
    most = F.least("a_at", "b_at") + 1 + F.least(behind("a"), behind("b"))
    enough = F.ceil(SIMILAR / (1 + SIMILAR) * (F.col("a_n") + F.col("b_n")) - 1e-9)
    return met.filter(most >= enough).select(F.col("a_node").alias("a"), F.col("b_node").alias("b"))


def _similar(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough; one a may have many pairs. ``pairs`` is staged."""
    named = lambda x: [F.col("node").alias(x), F.col("n").alias(f"{x}n"), F.col("held").alias(f"{x}h")]
    times = pairs.groupBy("a").agg(F.count("*").alias("times"))
    first = staged(sets.select(*named("a")).join(times, "a"))
    met = join_hot(pairs, first, "a", "times").join(sets.select(*named("b")), "b")
    both = F.size(F.array_intersect("ah", "bh"))
    return met.withColumn("both", both).filter(F.col("both") / (F.col("an") + F.col("bn") - F.col("both")) >= SIMILAR).select("a", "b")


def linked(n: np.ndarray, lengths: np.ndarray, held: np.ndarray, seed: np.ndarray | None = None) -> np.ndarray:
    """For each set the index of its class's first: the closure of all pairs similar enough.

    Set i has ``n[i]`` members, of which others may hold the next ``lengths[i]``
    of ``held``. A set reached is compared with all not yet reached that share a
    key of the block's own rarest-first prefixes; those linked are reached next.
    So no link is lost, and sets reached already are not compared again. Sets of
    one ``seed`` are known to be linked, and are reached together.
    """
    _, label = np.unique(np.arange(len(n)) if seed is None else seed, return_inverse=True)
    mates = np.split(np.argsort(label, kind="stable"), np.cumsum(np.bincount(label))[:-1])
    _, ids, df = np.unique(held, return_inverse=True, return_counts=True)
    order = np.argsort(df, kind="stable")
    rank = np.empty(len(df), np.int64)
    rank[order] = np.arange(len(df))
    ids, df, owner = rank[ids], df[order], np.repeat(np.arange(len(n)), lengths)
    ids = ids[np.lexsort((ids, owner))]
    ids, owner = ids[df[ids] > 1], owner[df[ids] > 1]
    lengths = np.bincount(owner, minlength=len(n))
    starts = np.cumsum(lengths) - lengths
    n_keys = np.maximum(prefix(n) - (n - lengths), 0)
    key = np.arange(len(ids)) - starts[owner] < n_keys[owner]
    by_id = np.argsort(ids[key], kind="stable")
    posts = np.split(owner[key][by_id], np.searchsorted(ids[key][by_id], np.arange(1, len(df))))
    root, mark, left = np.full(len(n), -1), np.zeros(len(df), bool), len(n)
    for first in range(len(n)):
        if root[first] >= 0:
            continue
        todo = mates[label[first]].tolist()
        root[todo], left = first, left - len(todo)
        while todo and left:
            x = todo.pop()
            mine = ids[starts[x] : starts[x] + lengths[x]]
            for e in mine[: n_keys[x]].tolist():
                posts[e] = posts[e][root[posts[e]] < 0]
            near = np.unique(np.concatenate([posts[e] for e in mine[: n_keys[x]].tolist()] or [mine[:0]]))
            mark[mine] = True
            for at in range(0, len(near), 4096):
                some = near[at : at + 4096]
                size = lengths[some]
                begin = np.cumsum(size) - size
                same = np.add.reduceat(mark[ids[np.repeat(starts[some] - begin, size) + np.arange(size.sum())]].astype(np.int64), begin)
                some = some[same / (n[x] + n[some] - same) >= SIMILAR]
                some = np.concatenate([mates[i] for i in np.unique(label[some]).tolist()] or [some])
                some = some[root[some] < 0]
                root[some], left = first, left - len(some)
                todo += some.tolist()
            mark[mine] = False
    return root


def keep_one(docs: DataFrame, size: int) -> DataFrame:
    """The rows of ``docs`` that are their class's smallest doc_id, one a class, with all their columns.

    Rows without a word are no copies of each other: all stay. Where doc_ids
    repeat in a class, the row with the least text hash stays, once.
    """
    marked = staged(near_copies(docs, size))
    first = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("th"))
    kept = staged(marked.groupBy("root").agg(F.min(first).alias("first"), F.count("*").alias("n")).filter("n > 1"))
    met = staged(join_hot(marked, kept, "root", "n").select(F.col("doc_id").alias("k"), "th", (F.col("first") < first).alias("gone")).distinct())
    left = join_checked(carried(docs), met.filter("gone"), ["k", "th"], "left_anti")
    # the row that stays may itself be there more than once
    again = staged(marked.groupBy("doc_id", "th").count().filter("count > 1").select(F.col("doc_id").alias("k"), "th"))
    if not again.isEmpty():
        copies = join_checked(left, again, ["k", "th"], "left_semi").dropDuplicates(["k", "th"])
        left = join_checked(left, again, ["k", "th"], "left_anti").unionByName(copies)
    return released(left, docs)


def hex_of(fp) -> F.Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
