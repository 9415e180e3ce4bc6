"""From extracted parts to linked entries: ids, parents, waypoints and gaps.

Every window is partitioned by guide_id and ordered by seq, which is unique in
a guide, so results do not depend on how rows are spread.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from entrygraph.functions import slicing, text
from entrygraph.operators import scan

CONTRACT = ("id", "kind", "name", "place_type", "elevation", "peak", "grade", "time", "height_m", "first_ascent", "destination_id", "place_ids", "references", "summary", "description", "description_source")


def in_book_order(guide: str = "guide_id", order: str = "seq"):
    return Window.partitionBy(guide).orderBy(order)


def gap_fill(df: DataFrame, value: str = "value", out: str = "filled") -> DataFrame:
    """Fill runs of missing numbers before a known one, where the run fits above the number before it."""
    here = in_book_order()
    df = df.withColumn("_at", F.row_number().over(here))
    # both are running frames: the one behind runs from the end
    before = here.rowsBetween(Window.unboundedPreceding, 0)
    behind = Window.partitionBy("guide_id").orderBy(F.desc("seq")).rowsBetween(Window.unboundedPreceding, 0)
    seen = F.struct(F.col(value).alias("v"), F.col("_at").alias("p"))
    known = F.when(F.col(value).isNotNull(), seen)
    df = df.withColumn("_before", F.last(known, ignorenulls=True).over(before)).withColumn("_behind", F.last(known, ignorenulls=True).over(behind))
    return _run_filled(df, value, out)


def _run_filled(df: DataFrame, value: str, out: str) -> DataFrame:
    # the number that the first of the run would get has to lie above the one before the run
    lowest = F.col("_behind.v") - (F.col("_behind.p") - (F.coalesce("_before.p", F.lit(0)) + 1))
    fill = F.when(lowest > F.coalesce("_before.v", F.lit(0)), F.col("_behind.v") - (F.col("_behind.p") - F.col("_at")))
    return df.withColumn(out, F.coalesce(F.col(value), fill)).drop("_at", "_before", "_behind")


def gap_fill_blocks(df: DataFrame, value: str = "value", out: str = "filled", rows: int = scan.ROWS) -> DataFrame:
    """``gap_fill`` for guides of any size: by blocks of about ``rows``, not one task a guide."""
    b = scan.positions(scan.blocks(df, rows), "_at")
    known = F.when(F.col(value).isNotNull(), F.struct(F.col(value).alias("v"), F.col("_at").alias("p")))
    return _run_filled(scan.next_known(scan.last_known(b, known, "_before"), known, "_behind"), value, out).drop(scan.BLOCK)


def parents_blocks(entries: DataFrame, rows: int = scan.ROWS) -> DataFrame:
    """``parents`` for guides of any size, by blocks of about ``rows``."""
    place = F.when(F.col("kind") == "place", F.col("id"))
    last = scan.last_known(scan.blocks(entries, rows), place, "_last", here=False)
    return last.withColumn("destination_id", F.when(F.col("kind") == "route", F.col("_last"))).drop("_last", scan.BLOCK)


def assign_ids(entries: DataFrame) -> DataFrame:
    """id, id_source and collision for entries with guide_id, seq, page, position and raw_id.

    The first with a book id keeps it; an inferred id is used if no book id and
    no earlier entry has it; all others get an id of page and position.
    """
    book = text.normalize_entry_id(F.col("raw_id"))
    e = entries.withColumn("_book", book).withColumn("_number", text.entry_id_number(book))
    e = gap_fill(e, "_number", "_filled")
    e = e.withColumn("_guess", F.when(F.col("_book").isNull() & F.col("_filled").isNotNull(), F.concat(F.lit("R"), F.col("_filled").cast("string"))))
    # a key is claimed by book ids first, then by guesses, each in book order
    key = F.coalesce("_book", "_guess")
    claim = Window.partitionBy("guide_id", key).orderBy(F.col("_book").isNull(), "seq")
    first = F.row_number().over(claim) == 1
    e = e.withColumn("_own", key.isNotNull() & first)
    synthetic = text.synthetic_id(F.col("page"), F.col("position"))
    return e.select(
        *entries.columns,
        F.when(F.col("_own"), key).otherwise(synthetic).alias("id"),
        F.when(F.col("_own") & F.col("_book").isNotNull(), "book").when(F.col("_own"), "inferred").otherwise("synthetic").alias("id_source"),
        (F.col("_book").isNotNull() & ~F.col("_own")).alias("collision"),
    )


def parents(entries: DataFrame) -> DataFrame:
    """destination_id: the nearest place before a route in book order; none for places and traverses."""
    earlier = in_book_order().rowsBetween(Window.unboundedPreceding, -1)
    last = F.last(F.when(F.col("kind") == "place", F.col("id")), ignorenulls=True).over(earlier)
    return entries.withColumn("_last", last).withColumn("destination_id", F.when(F.col("kind") == "route", F.col("_last"))).drop("_last")


def place_index(entries: DataFrame) -> DataFrame:
    """The first place of each folded name in a guide."""
    places = entries.filter("kind = 'place'").withColumn("name_key", text.norm_name(F.col("name")))
    return places.groupBy("guide_id", "name_key").agg(F.min_by("id", "seq").alias("place_id"))


def waypoints(entries: DataFrame, index: DataFrame) -> DataFrame:
    """place_ids from place_names through the index, in order, each once and never the destination."""
    named = entries.select("guide_id", "id", "destination_id", F.posexplode("place_names").alias("at", "place_name"))
    named = named.withColumn("name_key", text.norm_name(F.col("place_name")))
    met = named.join(index, ["guide_id", "name_key"], "left")
    listed = F.array_sort(F.collect_list(F.when(F.col("place_id").isNotNull() & ~F.col("place_id").eqNullSafe(F.col("destination_id")), F.struct("at", "place_id"))))
    grouped = met.groupBy("guide_id", "id").agg(F.array_distinct(F.transform(listed, lambda x: x.place_id)).alias("place_ids"))
    return entries.join(grouped, ["guide_id", "id"], "left").withColumn("place_ids", F.coalesce("place_ids", F.array().cast("array<string>")))


def unresolved_waypoints(entries: DataFrame, index: DataFrame) -> DataFrame:
    named = entries.select("guide_id", "id", F.explode("place_names").alias("place_name"))
    return named.withColumn("name_key", text.norm_name(F.col("place_name"))).join(index, ["guide_id", "name_key"], "left_anti").select("guide_id", "id", "place_name")


def dangling_references(references: DataFrame, entries: DataFrame) -> DataFrame:
    """References (guide_id, id, ref_id, surface) whose id no entry has."""
    ids = entries.select("guide_id", F.col("id").alias("ref_id")).distinct()
    return references.filter("ref_id is not null").join(ids, ["guide_id", "ref_id"], "left_anti")


def build_entry(kind: Column, columns: dict[str, Column]) -> dict[str, Column]:
    """The columns of an entry with those of the other kinds null."""
    of_places = ("place_type", "elevation")
    of_routes = ("peak", "grade", "first_ascent", "time", "height_m")
    out = {n: F.when(kind == "place", c) if n in of_places else F.when(kind != "place", c) if n in of_routes else c for n, c in columns.items()}
    return out


def contract(entries: DataFrame) -> DataFrame:
    """The published fields, arrays never null; fields that ``entries`` lacks are null."""
    arrays = {"place_ids": "array<string>", "references": "array<struct<ref_id:string,surface:string>>"}
    have = lambda c: F.col(c) if c in entries.columns else F.lit(None)
    return entries.select(*[F.coalesce(have(c).cast(arrays[c]), F.array().cast(arrays[c])).alias(c) if c in arrays else have(c).cast("string").alias(c) for c in CONTRACT])


def merge_report(entries: DataFrame) -> DataFrame:
    """Counts by kind and id source, with collisions, parentless routes and missing descriptions."""
    return entries.groupBy("guide_id", "kind").agg(
        F.count("*").alias("n_entries"),
        *[F.count_if(F.col("id_source") == s).alias(f"n_{s}") for s in ("book", "inferred", "synthetic")],
        F.count_if("collision").alias("n_collisions"),
        F.count_if((F.col("kind") == "route") & F.col("destination_id").isNull()).alias("n_parentless"),
    )


def section_ranges(sections: DataFrame) -> DataFrame:
    """first_page and last_page of each section, in its map's order; the last one is open (null)."""
    following = F.lead("book_page").over(Window.partitionBy("guide_id").orderBy("position"))
    return sections.withColumn("first_page", F.col("book_page")).withColumn("last_page", following - 1)


def section_faults(sections: DataFrame, roles: Sequence[str], guides: DataFrame | None = None) -> DataFrame:
    """One row a fault: an unknown role, a page before the one before it, no section of traverses, an empty map.

    Equal pages ascend. A guide of ``guides`` (guide_id) without any section has an empty map.
    """
    here = Window.partitionBy("guide_id").orderBy("position")
    s = sections.withColumn("_prior", F.lag("book_page").over(here))
    unknown = s.filter(~F.coalesce(F.col("role").isin(*roles), F.lit(False))).select("guide_id", "position", F.lit("unknown_role").alias("fault"))
    order = s.filter("book_page < _prior").select("guide_id", "position", F.lit("not_ascending").alias("fault"))
    whole = lambda fault: (F.lit(None).cast("int").alias("position"), F.lit(fault).alias("fault"))
    none = s.groupBy("guide_id").agg(F.count_if(F.col("role") == "traverses").alias("_n")).filter("_n = 0").select("guide_id", *whole("no_traverses"))
    out = unknown.unionByName(order).unionByName(none)
    return out if guides is None else out.unionByName(guides.select("guide_id").distinct().join(sections, "guide_id", "left_anti").select("guide_id", *whole("empty")))


def checked_sections(sections: DataFrame, roles: Sequence[str], guides: DataFrame | None = None) -> DataFrame:
    """``sections``; where any guide's map has a fault, the read ends and names the first of them.

    The check is a single row that every section meets, so it also ends a read of
    no sections at all, where ``guides`` says that there should be some.
    """
    told = F.concat_ws(" ", "guide_id", "fault", F.coalesce(F.concat(F.lit("at "), F.col("position").cast("string")), F.lit("")))
    first = section_faults(sections, roles, guides).agg(F.min(told).alias("_fault"))
    refused = first.select(F.when(F.col("_fault").isNotNull(), F.raise_error(F.concat(F.lit("malformed section map: "), F.col("_fault")))).cast("string").alias("_fault"))
    # one row on the left, so that it is read even if no section is
    return refused.join(sections, F.col("_fault").isNull(), "left").filter("guide_id is not null").select(*sections.columns)


def sliced(entries: DataFrame, pages: DataFrame) -> DataFrame:
    """description, description_source and unsliced_reason of entries from their page and the next.

    A page is marked and reflowed once, before its entries meet it; anchors are
    looked up in it as plain text, and a slice is looked for once: what is read
    off it are columns of a step of their own.
    """
    texts = pages.select("guide_id", "page", F.struct(slicing.marked(F.col("text")).alias("page"), slicing.reflow(F.col("text")).alias("flow")).alias("t"))
    # each page counts for its own entries and for those of the page before; one shuffle brings both together
    ends = texts.select("guide_id", F.explode(F.array(F.struct("page", F.lit(True).alias("here")), F.struct((F.col("page") - 1).alias("page"), F.lit(False).alias("here")))).alias("at"), "t")
    met = ends.groupBy("guide_id", F.col("at.page").alias("page")).agg(F.max(F.when(F.col("at.here"), F.col("t"))).alias("_h"), F.max(F.when(~F.col("at.here"), F.col("t"))).alias("_a"))
    here = met.select("guide_id", "page", F.col("_h.page").alias("_page"), F.col("_h.flow").alias("_flow"), F.col("_a.page").alias("_after"), F.col("_a.flow").alias("_after_flow"))
    e = entries.join(here, ["guide_id", "page"], "left")
    e = e.withColumn("_page", F.coalesce("_page", F.lit(""))).withColumn("_flow", F.coalesce("_flow", F.lit("")))
    start, end = F.col("start_quote"), F.col("end_quote")
    e = e.withColumn("_cut", slicing.slice_description(F.col("_page"), F.col("_after"), start, end, F.col("_flow"), F.col("_after_flow"), mark=False))
    e = e.withColumn("_reason", F.when(F.col("_cut").isNull(), slicing.unsliced_reason(F.col("_page"), start, end, F.col("_flow"), mark=False)))
    d, source, reason = slicing.described(F.col("_cut"), F.col("_reason"), start)
    out = e.withColumn("description", d).withColumn("description_source", source).withColumn("unsliced_reason", reason)
    return out.drop("_page", "_flow", "_after", "_after_flow", "_cut", "_reason")
