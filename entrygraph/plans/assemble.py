"""From parts and pages to linked entries, and from a feature dump to the resolved dataset."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entrygraph.functions import text
from entrygraph.operators import entries, gazetteer, matching


def assemble(parts: DataFrame, pages: DataFrame) -> dict[str, DataFrame]:
    """Entries with ids, descriptions, references and targets, and the gaps, each as a table.

    parts: guide_id, page, position and the extracted fields; pages: guide_id, page, text.
    """
    ordered = parts.withColumn("seq", F.col("page").cast("bigint") * 100_000 + F.col("position")).withColumnRenamed("entry_id_raw", "raw_id")
    e = entries.sliced(entries.assign_ids(ordered), pages)
    e = e.withColumn("references", text.parse_references(F.coalesce("description", F.lit(""))))
    e = entries.parents(e)
    index = entries.place_index(e)
    e = entries.waypoints(e, index)
    told = e.select("guide_id", "id", F.inline("references"))
    return {
        "entries": e,
        "contract": entries.contract(e),
        "unsliced": e.filter("unsliced_reason is not null").select("guide_id", "id", F.col("page").alias("source_page"), "name", "kind", F.col("unsliced_reason").alias("reason")),
        "unresolved_places": entries.unresolved_waypoints(e, index),
        "dangling": entries.dangling_references(told, e),
        "report": entries.merge_report(e),
    }


def build_gazetteer(raw: DataFrame, tag_map: Sequence, guarded_map: Sequence, linear_types: Sequence[str], km: float) -> DataFrame:
    """Classified features, guarded ones admitted where they fill a gap, linear ones once."""
    found = gazetteer.parse_elements(raw, tag_map, guarded_map)
    plain, guarded = found.filter("not guarded").drop("guarded"), found.filter("guarded").drop("guarded")
    return gazetteer.dedupe_linear(plain.unionByName(gazetteer.admit_guarded(guarded, plain, km)), linear_types)


def items_of(entries_: DataFrame, mentions: DataFrame) -> DataFrame:
    """What is to be resolved, a place's own name first, then mentions in file order; seq follows entry ids."""
    places = entries_.filter("kind = 'place'").select(
        F.col("id").alias("entry_id"), F.lit(-1).alias("position"), F.lit("place").alias("kind"), F.col("name").alias("surface"), F.col("name"), F.col("place_type").alias("type"), F.coalesce(text.parse_elevation(F.col("elevation")), text.stated_elevation(F.col("name"))).alias("elevation_m")
    )
    told = mentions.select("entry_id", "position", F.lit("mention").alias("kind"), "surface", F.coalesce("name", "surface").alias("name"), "type", F.coalesce("elevation_m", text.stated_elevation(F.col("surface"))).alias("elevation_m"))
    both = places.unionByName(told)
    # a sortable number from the entry's id and the position in it, without one global window
    return both.withColumn("seq", F.concat_ws("\x1f", "entry_id", F.lpad((F.col("position") + 1).cast("string"), 9, "0"))).withColumn("item_id", F.col("seq"))


def match(items: DataFrame, features: DataFrame, decisions: DataFrame, verdicts: DataFrame, patterns: Sequence[tuple[str, str]], scope: Sequence[str] = ()) -> dict[str, DataFrame]:
    """The resolution, written once, and all that is read off it."""
    r = matching.resolve(items, features, decisions, verdicts, patterns, scope)
    pois, places, told = matching.registry(r, scope), matching.place_links(r, scope), matching.entry_links(r, scope)
    return {
        "resolution": r,
        "pois": pois,
        "place_pois": places,
        "entry_pois": told,
        "geojson": matching.geojson(pois, matching.entry_counts(places, told)),
        "funnel": matching.funnel(r),
        "review": matching.review_list(r, features, scope),
        "queue": r.filter("queued"),
        "unmatched": r.filter("method in ('skipped', 'unmatched')"),
    }
