"""The audit of links: what was matched to what, by which method, and how much was not."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entrygraph.functions import text
from entrygraph.operators import work
from entrygraph.plans.staging import written

#: Characters of a description that a row shows.
WIDTH = 90
COLUMNS = ("title", "excerpt", "osm_name", "delta", "method")
# Rows of a sample and its seed; headings, columns' names and the summary's words of each kind of item.
SAMPLED, SEED = 30, 0
HEADINGS = {"place": "Place → POI matches", "mention": "Entry mentions → POI"}
NAMED = {"place": ("Place (book elev.)", "Übersicht excerpt", "OSM name", "Δ elev.", "method"), "mention": ("Mention", "Prose context", "OSM name", "Δ elev.", "method")}
SUMMED = {"place": "place matches", "mention": "mention links"}


def _told(rows: DataFrame, pois: DataFrame) -> DataFrame:
    """``rows`` (with poi_id) and what is known of their features: _name, _ele, _known."""
    return rows.join(pois.select("poi_id", F.col("name").alias("_name"), F.col("ele").alias("_ele"), F.lit(True).alias("_known")), "poi_id", "left")


def _cells(title: Column) -> list[Column]:
    """COLUMNS of rows that have excerpt, elevation_m, method and what ``_told`` adds; a feature that is gone is marked."""
    lost = F.concat(F.lit("(missing POI "), "poi_id", F.lit(")"))
    there = F.coalesce("_known", F.lit(False))
    delta = F.when(there, text.elevation_delta(F.col("elevation_m"), F.col("_ele"))).otherwise("—")
    return [text.cell(title).alias("title"), F.col("excerpt"), F.when(there, text.cell(F.col("_name"))).otherwise(lost).alias("osm_name"), delta.alias("delta"), F.col("method")]


def place_rows(links: DataFrame, entries: DataFrame, resolved: DataFrame, pois: DataFrame) -> DataFrame:
    """One row a link (place_id, poi_id) of a place that still is one: key, poi_id and COLUMNS.

    entries: id, name, description; resolved: a row an item with entry_id, kind,
    name, elevation_m and method. A link without entry or place item is passed over.
    """
    item = resolved.filter("kind = 'place'").select("entry_id", F.col("name").alias("_item"), "elevation_m", "method").dropDuplicates(["entry_id"])
    # a description is cut before its entry meets the links: only the excerpt goes through joins
    excerpt = text.excerpt_of(text.squeezed(F.col("description")), F.lit(None).cast("string"), WIDTH)
    told = entries.select(F.col("id").alias("entry_id"), F.col("name").alias("_entry"), excerpt.alias("excerpt"))
    rows = _told(links.withColumnRenamed("place_id", "entry_id"), pois).join(told, "entry_id").join(item, "entry_id")
    name = F.coalesce(F.nullif("_entry", F.lit("")), "_item")
    title = F.when(F.col("elevation_m").isNotNull(), F.concat(name, F.lit(", "), text.metres(F.col("elevation_m")))).otherwise(name)
    return rows.select(F.col("entry_id").alias("key"), "poi_id", *_cells(title))


def mention_rows(links: DataFrame, entries: DataFrame, resolved: DataFrame, pois: DataFrame) -> DataFrame:
    """One row a link (entry_id, surface, poi_id) with the method of the entry's first item of that surface.

    A link whose mention is no longer extracted stays, its method a question mark.
    What is told of an entry and a surface is made once, however many links have
    them, and written; links meet it last, so that no text is shuffled with them.
    """
    first = F.min_by(F.struct("elevation_m", "method"), "seq").alias("_item")
    items = resolved.filter("kind = 'mention'").groupBy("entry_id", "surface").agg(first)
    pairs = written(links.select("entry_id", "surface").distinct())
    flat = entries.select(F.col("id").alias("entry_id"), text.squeezed(F.col("description")).alias("_flat"))
    cut = pairs.join(flat, "entry_id").select("entry_id", "surface", text.excerpt_of(F.col("_flat"), F.col("surface"), WIDTH).alias("excerpt"))
    told = cut.join(items.join(pairs, ["entry_id", "surface"], "left_semi"), ["entry_id", "surface"], "left")
    told = written(told.select("entry_id", "surface", "excerpt", F.col("_item.elevation_m").alias("elevation_m"), F.coalesce("_item.method", F.lit("?")).alias("method")))
    key = F.concat_ws("\x1f", "entry_id", "surface", "poi_id")
    return _told(links, pois).join(told, ["entry_id", "surface"]).select(key.alias("key"), "poi_id", *_cells(F.col("surface")))


def methods(rows: DataFrame) -> DataFrame:
    """How many rows each method made."""
    return rows.groupBy("method").agg(F.count("*").alias("n"))


def tally(rows: DataFrame) -> DataFrame:
    """The counts of all methods in one line, by name; a method is one of a few, so one row holds them."""
    counts = F.array_sort(F.collect_list(F.struct("method", "n")))
    return methods(rows).agg(F.array_join(F.transform(counts, lambda x: F.concat(x.method, F.lit(": "), x.n.cast("string"))), ", ").alias("tally"))


def unmatched_by_kind(unmatched: DataFrame) -> DataFrame:
    return unmatched.groupBy("kind").agg(F.count("*").alias("n"))


def section(rows: DataFrame, unmatched: DataFrame, kind: str, size: int, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """(sampled rows with their table line, one row of numbers) for the audit of one kind of item."""
    picked = work.audit_sample(rows, "key", "method", size, seed)
    lines = picked.withColumn("line", F.concat(F.lit("| "), F.concat_ws(" | ", *COLUMNS), F.lit(" |")))
    numbers = rows.agg(F.count("*").alias("n_rows")).crossJoin(picked.agg(F.count("*").alias("n_sampled"))).crossJoin(tally(picked))  # one row each
    return lines, numbers.crossJoin(unmatched.filter(F.col("kind") == kind).agg(F.count("*").alias("n_unmatched"))).withColumn("kind", F.lit(kind))


def rendered(rows: DataFrame, unmatched: DataFrame, kind: str, size: int = SAMPLED, seed: int = SEED) -> DataFrame:
    """One row of (kind, markdown, summary): the table of a sample of ``rows`` in the order of their keys, under its heading.

    Only the sample is put into one row; counts come from all rows.
    """
    # ``size`` rows, read twice
    picked = written(work.audit_sample(rows, "key", "method", size, seed, ("poi_id",)))
    line = F.concat(F.lit("| "), F.concat_ws(" | ", *COLUMNS), F.lit(" |"))
    lines = picked.agg(F.array_sort(F.collect_list(F.struct("key", "poi_id", line.alias("line")))).alias("_lines"), F.count(F.lit(1)).alias("_n"))
    counted = rows.agg(F.count(F.lit(1)).alias("_all")).crossJoin(lines).crossJoin(tally(picked))  # one row each
    counted = counted.crossJoin(unmatched.filter(F.col("kind") == kind).agg(F.count(F.lit(1)).alias("_without")))
    text_of = lambda c: F.col(c).cast("string")
    named = NAMED[kind]
    top = [F.concat(F.lit(f"## {HEADINGS[kind]} ("), text_of("_n"), F.lit(" of "), text_of("_all"), F.lit(" matches)")), *map(F.lit, ("", f"| {' | '.join(named)} |", f"| {' | '.join('---' for _ in named)} |"))]
    markdown = F.concat_ws("\n", *top, F.transform("_lines", lambda x: x.line))
    summary = F.concat(F.lit(f"{SUMMED[kind]}: "), text_of("_all"), F.lit(" matched (sample "), text_of("_n"), F.lit(" — "), F.coalesce("tally", F.lit("")), F.lit("), "), text_of("_without"), F.lit(" without a match"))
    return counted.select(F.lit(kind).alias("kind"), markdown.alias("markdown"), summary.alias("summary"))


def report(sections: DataFrame) -> DataFrame:
    """One row of (markdown, summary) from the rendered sections, places before mentions."""
    order = F.array_sort(F.collect_list(F.struct((F.col("kind") != "place").alias("o"), "markdown", "summary")))
    return sections.agg(order.alias("s")).select(F.array_join(F.transform("s", lambda x: x.markdown), "\n\n").alias("markdown"), F.concat(F.lit("[audit] "), F.array_join(F.transform("s", lambda x: x.summary), "; "), F.lit(".")).alias("summary"))
