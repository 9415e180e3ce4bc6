"""What is still to do: pages, repairs and open cases; checks before work is handed out."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from entrygraph.operators import work

# The reasons for which new anchors may help.
REPAIRABLE = ("start_not_found", "start_ambiguous", "end_mismatch")


def to_clean(pages: DataFrame, cleaned: DataFrame) -> DataFrame:
    """Pages of text (guide_id, page, is_sketch) that no cleaned page exists of."""
    return pages.filter("not is_sketch").join(cleaned.select("guide_id", "page"), ["guide_id", "page"], "left_anti")


def passed_through(pages: DataFrame, cleaned: DataFrame) -> DataFrame:
    """Sketch pages that are taken over as they are: there is no text to clean."""
    return pages.filter("is_sketch").join(cleaned.select("guide_id", "page"), ["guide_id", "page"], "left_anti")


def to_structure(pages: DataFrame, cleaned: DataFrame, structured: DataFrame) -> DataFrame:
    """Cleaned pages of text that no part exists of."""
    ready = pages.filter("not is_sketch").join(cleaned.select("guide_id", "page").distinct(), ["guide_id", "page"], "left_semi")
    return ready.join(structured.select("guide_id", "page"), ["guide_id", "page"], "left_anti")


def extract_summary(pages: DataFrame) -> DataFrame:
    """Per guide: pages of text, sketches, characters and about how many words."""
    chars = F.coalesce(F.sum("char_count"), F.lit(0))
    return pages.groupBy("guide_id").agg(
        F.count("*").alias("n_pages"), F.count_if(~F.col("is_sketch")).alias("n_text"), F.count_if("is_sketch").alias("n_sketch"), chars.alias("n_chars"), F.floor(chars / 6).alias("n_words")
    )


def repair_tasks(unsliced: DataFrame, parts: DataFrame) -> DataFrame:
    """Repairable entries by page, each with the anchors its part has now; null where no part is its own.

    unsliced: seq, entry_id, page, name, kind, reason; parts: page, position,
    raw_id, name, start_quote, end_quote.
    """
    asked = unsliced.filter(F.col("reason").isin(*REPAIRABLE))
    met = work.match_repairs(asked, parts)
    anchors = parts.select("page", "position", "start_quote", "end_quote")
    return met.join(anchors, ["page", "position"], "left").select("entry_id", "page", "name", "kind", "reason", "start_quote", "end_quote", "seq").orderBy("page", "seq")


def queue_of(queue: DataFrame, kind: str = "all") -> DataFrame:
    """The open cases of one kind of item, or all."""
    return queue if kind == "all" else queue.filter(F.col("kind") == kind)


def lost_entries(queue: DataFrame, entries: DataFrame) -> DataFrame:
    """Ids of entries that are queued but not there any more."""
    return queue.select("entry_id").distinct().join(entries.select(F.col("id").alias("entry_id")), "entry_id", "left_anti")


def checked_queue(queue: DataFrame, entries: DataFrame) -> DataFrame:
    """``queue``, read of which fails with the entry's id where its entry is gone."""
    known = entries.select(F.col("id").alias("entry_id"), F.lit(True).alias("_there")).distinct()
    gone = F.raise_error(F.concat(F.lit("queued, but no longer an entry: "), F.col("entry_id")))
    met = queue.join(known, "entry_id", "left")
    return met.withColumn("entry_id", F.when(F.col("_there"), F.col("entry_id")).otherwise(gone)).drop("_there").select(*queue.columns)


def with_part(entries: DataFrame, parts: DataFrame) -> DataFrame:
    """Entries with has_part: whether mentions were extracted of them, be it none."""
    there = parts.select(F.col("entry_id").alias("id"), F.lit(True).alias("_there")).distinct()
    return entries.join(there, "id", "left").withColumn("has_part", F.coalesce("_there", F.lit(False))).drop("_there")


def place_features(links: DataFrame, pois: DataFrame) -> DataFrame:
    """place_id with the feature's columns; of several links the last to a known feature counts."""
    met = links.join(pois, "poi_id")
    last = Window.partitionBy("place_id").orderBy(F.desc("seq"))
    return met.withColumn("_n", F.row_number().over(last)).filter("_n = 1").drop("_n", "seq")


# What readers of pages are told about each role of section, and what stands around it.
ROLE_POLICY = {
    "front_matter": "front matter — holds no Entries; skip.",
    "valley_places": "valley places — Places (towns/localities) and any short Routes filed under them.",
    "huts": "huts — Places (huts) and the Routes (Zugänge) filed under them.",
    "traverses": "TRAVERSES — every itinerary here is kind=traverse: a range-wide tour filed under NO Place (no Destination). Not kind=route.",
    "peaks": "peaks — Places (summits) and the Routes filed under them.",
    "back_matter": "back matter — holds no Entries; skip.",
}
SECTIONS_HEAD = "\n".join(
    (
        "Guidebook structure from the Inhaltsverzeichnis (ADR-0005). Classify each",
        "entry by the section its page falls in — the section title is reprinted",
        "in the running header at the top of every page:",
    )
)
SECTIONS_TAIL = "On a page that straddles two sections (both running headers present), classify each entry by the heading it sits under."
FACTS_HEAD = "Guide facts for this run (the guidebook these scanned pages are from):"


def policies(sections: DataFrame, policy: dict[str, str] = ROLE_POLICY) -> DataFrame:
    """Section rows (title, role, first_page, last_page) with the line that tells a reader what they hold; the last is open."""
    known = F.create_map(*[F.lit(x) for pair in policy.items() for x in pair])
    first = F.col("first_page").cast("string")
    pages = F.when(F.col("last_page").isNull(), F.concat(F.lit("book pp. "), first, F.lit("+"))).otherwise(F.concat(F.lit("book pp. "), first, F.lit("–"), F.col("last_page").cast("string")))
    return sections.withColumn("line", F.concat(F.lit("- "), "title", F.lit(" ("), pages, F.lit(") — "), F.coalesce(F.try_element_at(known, "role"), F.lit(""))))


def section_block(sections: DataFrame) -> DataFrame:
    """guide_id and block: a guide's sections (position, title, role and their ranges) as readers of its pages get them."""
    return block(policies(sections), "guide_id", "position", head=SECTIONS_HEAD, tail=SECTIONS_TAIL)


def block(lines: DataFrame, group: str, order: str, line: str = "line", head: str = "", tail: str = "") -> DataFrame:
    """One text for each group from its lines in order, between a heading and a last line; a group is a guide's few lines."""
    listed = F.transform(F.array_sort(F.collect_list(F.struct(order, line))), lambda x: x[line])
    return lines.groupBy(group).agg(F.concat_ws("\n", *([F.lit(head)] if head else []), listed, *([F.lit(tail)] if tail else [])).alias("block"))
