"""Similarity join of keys by an inverted index of their numbered letters.

Keys with n and m letters are similar by ``least`` (Indel similarity in percent)
if they have a common subsequence of L = ceil((n + m) * least / 200) letters. So
they share at least L letters, counted with their repetitions. Letters are put
in one order, the rarest first; then the first n - L + k of the one key and the
first m - L + k of the other have at least k in common. These pairs or triples
of letters are what keys meet by, within their lengths; the shared letters are
counted on the spot, and what is left is compared in full.

Keys that share too few letters never meet, whatever their lengths. At a low
cutoff many do meet, because many are near; ``falling`` therefore goes down only
for keys that have not found enough at a higher one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entrygraph.functions import similarity
from entrygraph.plans.staging import dealt, written

#: Letters whose counts order them: the most common ones; others come before these. It bounds what is broadcast.
COMMON = 4096
#: Letters (of the first ones) that similar keys have in common at least, and by which they meet: three where cutoffs
#: are high, as few letters are first then; two below, where three of many would make too many rows.
HIGH = 85
#: Pairs of distinct keys up to which all are compared at once: that takes less time than the steps of the index.
FEW = 4_000_000


def near_enough(least: int) -> Column:
    """By the unrounded similarity."""
    return F.lit(100) * F.col("gap") <= F.lit(100 - least) * F.col("total")


def distinct(keys: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Each distinct key (of a scope) once."""
    return keys.select("key", *scope).filter("key is not null").distinct()


def all_pairs(left: DataFrame, right: DataFrame, least: int, scope: Sequence[str] = ()) -> DataFrame:
    """What ``candidates`` gives, without the index and with the places of a key's letters: all pairs of keys whose lengths allow similarity of ``least``. One side is sent to all tasks."""
    a = left.select("key", F.length("key").alias("n"), similarity.places(F.col("key")).alias("_places"), *scope)
    # few keys lie in few files: they are dealt anew, so that all tasks compare
    b = dealt(right.select(F.col("key").alias("g_key"), F.length("key").alias("m"), *[F.col(c).alias(f"_{c}") for c in scope]), "g_key")
    shorter, both = F.least("n", "m"), F.col("n") + F.col("m")
    met = F.lit(200) * shorter >= F.lit(least) * both
    for c in scope:
        met = met & (F.col(c) == F.col(f"_{c}"))
    return b.join(F.broadcast(a), met).select("key", "g_key", *scope, "n", "m", "_places")


def _numbered(key: Column) -> Column:
    """The letters of a key with their occurrence: aba is a1, a2, b1."""
    letters = F.array_sort(F.regexp_extract_all(key, F.lit("(?s)(.)"), F.lit(1)))
    return F.transform(letters, lambda c, i: F.concat(c, (i - F.array_position(letters, c) + 2).cast("string")))


def numbered(keys: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Each distinct key (of a scope) once, with n, its length, and its numbered letters."""
    each = keys.select("key", *scope).filter("key is not null").distinct()
    return each.withColumn("letters", _numbered(F.col("key"))).withColumn("n", F.size("letters"))


def common_letters(keys: DataFrame) -> DataFrame:
    """(letter, times) of the COMMON most frequent letters of ``keys``, which are ``numbered``."""
    return keys.select(F.explode("letters").alias("letter")).groupBy("letter").agg(F.count("*").alias("times")).orderBy(F.desc("times"), "letter").limit(COMMON)


def lettered(keys: DataFrame, common: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """``numbered`` keys with their letters in order, the rarest first; these meet a bounded table of common ones."""
    by = ["key", *scope, "n"]
    met = keys.select(*by, F.explode_outer("letters").alias("letter")).join(F.broadcast(common), "letter", "left")
    order = F.array_sort(F.collect_list(F.when(F.col("letter").isNotNull(), F.struct(F.coalesce("times", F.lit(0)).alias("t"), "letter"))))
    return met.groupBy(*by).agg(F.transform(order, lambda x: x.letter).alias("letters"))


def ordered(left: DataFrame, right: DataFrame, scope: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Both tables of keys as ``candidates`` takes them, in the order that the right side's letters give; written once."""
    first, second = numbered(left, scope), written(numbered(right, scope))
    common = written(common_letters(second))
    return written(lettered(first, common, scope)), written(lettered(second, common, scope))


def _least_common(n: Column, m: Column, least: int) -> Column:
    return F.ceil((n + m) * F.lit(least) / F.lit(200)).cast("int")


def _meeting(keys: DataFrame, least: int, first: bool) -> DataFrame:
    """A row for each length that a similar key may have, and each of the few letters to meet it by."""
    n, other = F.col("n"), F.col("_other")
    low, high = F.ceil(n * least / (200 - least)).cast("int"), F.floor(n * (200 - least) / least).cast("int")
    k = keys.withColumn("_other", F.explode(F.sequence(low, high)))
    most = 3 if least >= HIGH else 2
    shared = F.least(F.lit(most), _least_common(n, other, least))
    k = k.withColumn("_shared", shared).withColumn("_first", F.slice("letters", 1, n - _least_common(n, other, least) + shared))
    sizes = (n, other) if first else (other, n)
    behind = lambda i: F.slice("_first", i + 2, n)
    # keys of a letter or two have no more in common, and empty ones none
    signs = F.when(F.col("_shared") == 0, F.array(F.xxhash64(*sizes))).when(F.col("_shared") == 1, F.transform("_first", lambda x: F.xxhash64(*sizes, x)))
    pairs = F.flatten(F.transform("_first", lambda x, i: F.transform(behind(i), lambda y: F.xxhash64(*sizes, x, y))))
    if most == 2:
        signs = signs.otherwise(pairs)
    else:
        thirds = lambda x, i: F.flatten(F.transform(behind(i), lambda y, j: F.transform(behind(i + j + 1), lambda z: F.xxhash64(*sizes, x, y, z))))
        signs = signs.when(F.col("_shared") == 2, pairs).otherwise(F.flatten(F.transform("_first", thirds)))
    return k.withColumn("_sign", F.explode(signs)).drop("_shared", "_first", "_other")


def candidates(left: DataFrame, right: DataFrame, least: int, scope: Sequence[str] = ()) -> DataFrame:
    """(key, g_key, n, m and the scope) of ``ordered`` keys that share as many letters as similarity of ``least`` needs."""
    a = _meeting(left, least, True).withColumnRenamed("n", "_n").withColumnRenamed("letters", "_letters")
    b = _meeting(right, least, False).select(F.col("key").alias("g_key"), F.col("n").alias("_m"), F.col("letters").alias("_others"), "_sign", *scope)
    met = a.join(b, ["_sign", *scope])
    # equal signs may be chance; the count decides
    enough = F.size(F.array_intersect("_letters", "_others")) >= _least_common(F.col("_n"), F.col("_m"), least)
    return met.filter(enough).select("key", "g_key", *scope, F.col("_n").alias("n"), F.col("_m").alias("m")).distinct()


def scored(met: DataFrame, least: int, scope: Sequence[str] = ()) -> DataFrame:
    """(key, g_key, score, and gap and total, which decide) of candidates that are similar by at least ``least``.

    The edit distance, computed no further than it may go (it is never above the
    Indel distance), cuts most of the rest in compiled code; the exact score is
    computed for what is left: without Python where the places of letters are
    known, as for few pairs its start takes longer than all of them.
    """
    met = met.withColumn("total", F.col("n") + F.col("m")).withColumn("_most", F.floor(F.lit(100 - least) * F.col("total") / 100).cast("int"))
    met = met.filter(F.expr("levenshtein(key, g_key, _most) >= 0"))
    key, other = F.col("key"), F.col("g_key")
    lcs = similarity.lcs_by_places(key, F.col("_places"), other) if "_places" in met.columns else similarity.lcs_batched(key, other)
    met = met.withColumn("_lcs", lcs).withColumn("gap", F.col("total") - 2 * F.col("_lcs"))
    return met.filter(near_enough(least)).select("key", "g_key", *scope, similarity.ratio(F.col("_lcs"), F.col("total")).alias("score"), "gap", "total")


def similar(left: DataFrame, right: DataFrame, least: int, scope: Sequence[str] = ()) -> DataFrame:
    """``scored`` candidates of two tables of keys (key, and the scope's columns)."""
    return scored(candidates(*ordered(left, right, scope), least, scope), least, scope)


def falling(left: DataFrame, right: DataFrame, weights: DataFrame, levels: Sequence[int], wanted: int, found: DataFrame, scope: Sequence[str] = ()) -> list[DataFrame]:
    """For each key of ``left`` all similar keys down to the first of ``levels`` at which their weights reach ``wanted``.

    left, right: ``ordered``; weights: g_key, the scope and weight; found: what
    ``similar`` gives for the first, highest level. One table a level, each with
    the keys that were settled there; those that never find enough are in the
    last one. Of the ``wanted`` best by score none is missing, as what a lower
    level would add scores less. Levels stop where no key is left.
    """
    by, out = ["key", *scope], []
    for level, following in zip(levels, [*levels[1:], None]):
        here = found.join(left.select(*by), by, "left_semi")
        if following is None:
            return [*out, here]
        # scores are rounded: what scores more than the cutoff comes before anything below it
        full = here.filter(F.col("score") > level).join(weights, ["g_key", *scope]).groupBy(*by).agg(F.sum("weight").alias("_w")).filter(F.col("_w") >= wanted).select(*by)
        out.append(here.join(full, by, "left_semi"))
        left = written(left.join(full, by, "left_anti"))
        if left.isEmpty():
            return out
        found = written(scored(candidates(left, right, following, scope), following, scope))
    return out
