"""Line dedup by a deletion-neighbourhood join, in DataFrame functions only.

A line, without blanks, tabs and carriage returns around it, goes if an earlier
line of the corpus is equal or, where both have at least ``least`` characters,
at most one edit (a character put in, left out or replaced) away. In shorter
lines one character often is the content (a number, a unit, a short heading),
hence LEAST; with ``least`` 1 all lines are compared. Earlier is by doc_id, then
place in the document. Blank lines stay.

Equal lines are met by 128 hash bits and a partial aggregate, so a line that
makes up a third of the corpus sends one row a task. Of the distinct lines only
those go on that share a half with another of fitting length: with one edit,
either the first or the second half is untouched. What is left is halved the
same way, until it is short, and then emits its deletion neighbourhood, each
variant hashed with all that is shared: so a line of a million characters emits
as few as one of a hundred. Lines of equal length that meet at a deleted place differ in that place only; a line
that equals another's variant lacks one of its characters. So the earliest line
of a variant is the only partner its lines need, and no pairs are spread out;
that no more than one edit lies between them is then verified on the lines.

Defined cases: a null text has no lines and stays null; empty lines and texts
stay; rows with equal doc_id and text are one document, both get its result;
rows with equal doc_id and other texts are ordered by their text's hash; a null
doc_id comes first; very long lines take part; an empty table gives an empty
result; columns besides doc_id and text are carried by ``clean_lines``, clashing
names included.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entrygraph.llm.common import carried, join_checked, staged, text_or_empty

#: Characters from which a line is also compared with lines one edit away.
LEAST = 20
#: How often what may differ is halved again at least, and the rest's length from which halving goes on.
NARROWED, REST = 2, 32
#: Bytes of removed lines' places that may be broadcast: 24 a document and 4 a line.
PLACES_BYTES = 8 << 20
AROUND = " \t\r"


def _lines(docs: DataFrame) -> DataFrame:
    """Lines with a word: doc_id, th (the text's hash), line_no, norm, n."""
    # the outer form, here and below: Spark would filter by the size of the array first, and compute it once more for that
    at = docs.select("doc_id", F.xxhash64("text").alias("th"), F.posexplode_outer(F.split("text", "\n")).alias("line_no", "line"))
    return at.withColumn("norm", F.btrim("line", F.lit(AROUND))).drop("line").filter("norm <> ''").withColumn("n", F.length("norm"))


def _half(m: Column, side: str, norm: Column) -> Column:
    """The half that a pair whose shorter line has m characters may share, hashed."""
    half = F.floor(m / 2)
    text = F.substring(norm, F.lit(1), half) if side == "p" else F.right(norm, m - half)
    return F.xxhash64(F.lit(side), m, text)


def _distinct(lines: DataFrame, least: int) -> DataFrame:
    n, norm = F.col("n"), F.col("norm")
    long = n >= least
    halves = {f"{side}{less}": F.when(long, _half(n - less, side, norm)) for side in "ps" for less in (0, 1)}
    seen = lines.select(
        F.xxhash64("norm").alias("h1"), F.xxhash64(F.lit(7), "norm").alias("h2"), "n", F.struct("doc_id", "th", "line_no").alias("at"), *[c.alias(k) for k, c in halves.items()]
    )
    return seen.groupBy("h1", "h2", "n").agg(F.min("at").alias("first"), F.count("*").alias("times"), *[F.first(k).alias(k) for k in halves])


def _sharing(distinct: DataFrame, least: int) -> DataFrame:
    """(line, half) for the halves that lines of fitting length share; m is the shorter line's length."""
    options = F.array(*[F.struct(F.col(f"{side}{less}").alias("k"), F.lit(side).alias("side"), (F.col("n") - less).alias("m")) for side in "ps" for less in (0, 1)])
    keyed = distinct.filter(F.col("n") >= least).select("h1", "h2", "n", "first", F.inline(options))
    return _in_company(keyed)


def _narrowed(held: DataFrame) -> DataFrame:
    """The same lines with half of what may still differ: where the edit is in one half, the other is shared.

    ``held`` has first, k (what is shared so far, hashed), m (the rest's length in the shorter line), n, at (what
    stands before the rest) and rest.
    """
    half = F.floor(F.col("m") / 2).cast("int")
    front, back = F.substring(F.col("rest"), F.lit(1), half), F.right("rest", F.col("m") - half)
    options = F.array(
        F.struct(F.xxhash64("k", F.lit("p"), front).alias("k"), (F.col("m") - half).alias("m"), (F.col("n") - half).alias("n"), (F.col("at") + half).alias("at"), F.substring(F.col("rest"), half + 1, F.col("n")).alias("rest")),
        F.struct(F.xxhash64("k", F.lit("s"), back).alias("k"), half.alias("m"), (F.col("n") - F.col("m") + half).alias("n"), F.col("at"), F.left("rest", F.col("n") - F.col("m") + half).alias("rest")),
    )
    return _in_company(held.select("first", F.inline(options)))


def _in_company(keyed: DataFrame) -> DataFrame:
    """Rows whose key k has another line of fitting length."""
    groups = keyed.groupBy("k").agg(F.count("*").alias("_lines"), F.count_if(F.col("n") == F.col("m")).alias("_exact")).filter("_lines > 1 and _exact > 0").select("k")
    return keyed.join(groups, "k", "left_semi")


def _variants() -> Column:
    """The deletion neighbourhood of the rest, and for the shorter line the rest itself."""
    rest, size, equal = F.col("rest"), F.col("n"), F.col("n") == F.col("m")

    def without(i: Column) -> Column:
        cut = F.concat(F.substring(rest, F.lit(1), i - 1), F.substring(rest, i + 1, size))
        place = F.when(equal, i).otherwise(0)  # a replaced character is met at its place, a left-out one anywhere
        return F.struct(F.xxhash64("k", equal, place, cut).alias("v"), F.when(equal, "same").otherwise("longer").alias("role"), (F.col("at") + i).alias("place"))

    itself = F.array(F.struct(F.xxhash64(F.col("k"), F.lit(False), F.lit(0), rest).alias("v"), F.lit("shorter").alias("role"), F.lit(0).alias("place")))
    none = F.array().cast("array<struct<v:bigint,role:string,place:int>>")
    all_of = F.when(size > 0, F.transform(F.sequence(F.lit(1), F.greatest(size, F.lit(1))), without)).otherwise(none)
    return F.when(equal, F.concat(all_of, itself)).otherwise(all_of)


def _near(lines: DataFrame, distinct: DataFrame, least_length: int) -> DataFrame:
    """The first places (doc_id, th, line_no) of lines that an earlier line is one edit away from."""
    sharing = staged(_sharing(distinct, least_length).select("first.*", "k", "side", "m", "n"))
    places = staged(sharing.select("doc_id", "th", "line_no").distinct())
    texts = join_checked(lines.select("doc_id", "th", "line_no", "norm"), places, ["doc_id", "th", "line_no"], "left_semi")
    # rows that are repeated have a place twice
    texts = staged(texts.dropDuplicates(["doc_id", "th", "line_no"]).withColumnsRenamed({"doc_id": "_d", "th": "_t", "line_no": "_l"}))
    here = F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("th") == F.col("_t")) & (F.col("line_no") == F.col("_l"))
    half = F.floor(F.col("m") / 2).cast("int")
    front = F.col("side") == "p"
    shared = F.when(front, half).otherwise(F.col("m") - half)
    rest = F.when(front, F.substring(F.col("norm"), half + 1, F.col("n"))).otherwise(F.left("norm", F.col("n") - shared))
    held = sharing.join(texts, here).select(F.struct("doc_id", "th", "line_no").alias("first"), "k", (F.col("m") - shared).alias("m"), (F.col("n") - shared).alias("n"), F.when(front, half).otherwise(0).alias("at"), rest.alias("rest"))
    for _ in range(NARROWED):
        held = staged(_narrowed(held))
    short = held.filter(F.col("n") <= REST)
    # few lines, if any, are so long; each round halves what may differ
    while not (held := held.filter(F.col("n") > REST)).isEmpty():
        held = staged(_narrowed(held))
        short = short.unionByName(held.filter(F.col("n") <= REST))
    emitted = short.select("first", F.inline_outer(_variants())).filter("v is not null")
    least = lambda role: F.min(F.when(F.col("role") == role, F.struct("first", "place"))).alias(role)
    met = emitted.groupBy("v").agg(F.count("*").alias("_n"), least("same"), least("shorter"), least("longer")).filter("_n > 1").drop("_n")
    role = F.col("role")
    partner = F.when(role == "same", F.col("same")).when(role == "longer", F.col("shorter")).otherwise(F.col("longer"))
    # the place of the edit in the longer line
    place = F.when(role == "shorter", F.col("longer.place")).otherwise(F.col("place"))
    pairs = emitted.join(met, "v").select("first", partner["first"].alias("partner"), "role", place.alias("place")).filter("partner is not null and partner < first").distinct()
    mine = texts.select(F.struct(F.col("_d").alias("doc_id"), F.col("_t").alias("th"), F.col("_l").alias("line_no")).alias("_at"), F.col("norm").alias("_own"))
    theirs = mine.select(F.col("_at").alias("_its"), F.col("_own").alias("_other"))
    both = pairs.join(mine, F.col("first").eqNullSafe(F.col("_at"))).join(theirs, F.col("partner").eqNullSafe(F.col("_its")))
    # one edit at that place: what stands before and behind it is the same
    behind = lambda text, more: F.substring(F.col(text), F.col("place") + F.when(more, 1).otherwise(0), F.length(text))
    same = (F.left("_own", F.col("place") - 1) == F.left("_other", F.col("place") - 1)) & (behind("_own", role != "shorter") == behind("_other", role != "longer"))
    lengths = F.length("_own") - F.length("_other") == F.when(role == "same", 0).when(role == "longer", 1).otherwise(-1)
    return both.filter(lengths & same).select("first.*").distinct()


def removed_lines(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """A row for each document that loses lines: doc_id, th and the places that go as exact and as near."""
    lines = _lines(docs.select("doc_id", "text"))
    distinct = staged(_distinct(lines, least))
    repeated = distinct.filter("times > 1").select(F.col("h1").alias("_h1"), F.col("h2").alias("_h2"), F.col("first").alias("_first"))
    hashed = lines.select("doc_id", "th", "line_no", F.xxhash64("norm").alias("h1"), F.xxhash64(F.lit(7), "norm").alias("h2"))
    again = hashed.join(repeated, (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2"))).filter(F.struct("doc_id", "th", "line_no") > F.col("_first"))
    exact = again.select("doc_id", "th", "line_no", F.lit(0).alias("near"))
    near = _near(lines, distinct, least).withColumn("near", F.lit(1))
    # rows that are repeated name a line twice, hence the sets
    return exact.unionByName(near).groupBy("doc_id", "th").agg(F.collect_set(F.when(F.col("near") == 0, F.col("line_no"))).alias("exact"), F.collect_set(F.when(F.col("near") == 1, F.col("line_no"))).alias("near"))


def _judged(docs: DataFrame, least: int) -> DataFrame:
    """row (all columns of ``docs``), n_lines, n_exact, n_near and kept (the text that is left) for each row."""
    gone = staged(removed_lines(docs, least)).withColumnRenamed("doc_id", "k")
    keyed = carried(docs)
    none = F.array().cast("array<int>")
    # rows count as many times 24 bytes as their places take
    joined = join_checked(keyed, gone, ["k", "th"], "left", rows=PLACES_BYTES // 24, each=1 + (F.size("exact") + F.size("near")) / 6)
    exact, near, text = F.coalesce("exact", none), F.coalesce("near", none), F.col("row.text")
    parts = F.split(text, "\n")
    left = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.concat(exact, near))
    kept = F.when(F.size(exact) + F.size(near) == 0, text).otherwise(F.array_join(F.transform(left, lambda i: F.get(parts, i)), "\n"))
    return joined.select("row", F.coalesce(F.size(parts), F.lit(0)).alias("n_lines"), F.size(exact).alias("n_exact"), F.size(near).alias("n_near"), F.when(text.isNotNull(), kept).alias("kept"))


def clean_lines(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """``docs``, all its columns, with the repeated lines taken out of text."""
    row = F.col("row")
    return _judged(docs, least).select(*[F.col("kept").alias(c) if c == "text" else row.getField(c).alias(c) for c in docs.columns])


def line_report(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """One row a document: lines, how many went as equal and as one edit away, digest of what is kept."""
    done = _judged(docs.select("doc_id", "text"), least)
    long = lambda c: F.greatest(F.col(c), F.lit(0)).cast("long").alias(c)
    return done.select("row.doc_id", long("n_lines"), long("n_exact"), long("n_near"), F.sha2(text_or_empty(F.col("kept")), 256).alias("kept_sha256"))


ORACLE = """
WITH l AS (
  SELECT doc_id, no, ln, trim(ln, ' ' || chr(9) || chr(13)) AS norm
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS ln, unnest(range(len(string_split(text, chr(10))))) AS no FROM documents)),
f AS (SELECT norm, length(norm) AS n, min({'d': doc_id, 'n': no}) AS spot FROM l WHERE norm <> '' GROUP BY norm),
long AS (SELECT * FROM f WHERE n >= 20),
half AS (
  SELECT norm, n, spot, m, side, CASE side WHEN 'p' THEN left(norm, m // 2) ELSE right(norm, m - m // 2) END AS h
  FROM (SELECT norm, n, spot, unnest([n, n - 1]) AS m FROM long), (SELECT unnest(['p', 's']) AS side)),
pair AS (
  SELECT DISTINCT a.norm AS x, b.norm AS y, a.n AS n, b.n AS k
  FROM half a JOIN half b ON a.m = b.m AND a.side = b.side AND a.h = b.h AND least(a.n, b.n) = a.m
  WHERE a.norm <> b.norm AND b.spot < a.spot),
near AS (
  SELECT DISTINCT x FROM pair
  WHERE len(list_filter(range(0, greatest(n, k)), lambda i:
    CASE WHEN n = k THEN left(x, i) = left(y, i) AND right(x, n - 1 - i) = right(y, n - 1 - i)
         WHEN n > k THEN left(x, i) = left(y, i) AND right(x, n - 1 - i) = right(y, k - i)
         ELSE left(x, i) = left(y, i) AND right(x, n - i) = right(y, k - 1 - i) END)) > 0),
judged AS (
  SELECT l.doc_id, l.no, l.ln, coalesce({'d': l.doc_id, 'n': l.no} > f.spot, false) AS exact, coalesce({'d': l.doc_id, 'n': l.no} = f.spot AND near.x IS NOT NULL, false) AS near
  FROM l LEFT JOIN f ON l.norm = f.norm LEFT JOIN near ON near.x = l.norm)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (exact)::BIGINT AS n_exact, count(*) FILTER (near)::BIGINT AS n_near,
  sha256(coalesce(string_agg(ln, chr(10) ORDER BY no) FILTER (NOT exact AND NOT near), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""
