"""Wire records: defaults of what a record leaves out, and the fields each kind has."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHARED = ("id", "id_source", "kind", "source_page", "name", "description", "description_source", "summary", "references")
OF_PLACES = ("place_type", "elevation")
OF_ROUTES = ("peak", "grade", "first_ascent", "time", "height_m", "destination_id", "place_ids")
ARRAYS = {"references": "array<struct<ref_id:string,surface:string>>", "place_ids": "array<string>", "place_names": "array<string>"}
TYPES = {"source_page": "int", **ARRAYS}
#: What a record that leaves the field out means.
DEFAULTS = {"kind": "route", "id_source": "book", "description_source": "none"}


def with_defaults(raw: DataFrame, fields: tuple[str, ...] = SHARED + OF_PLACES + OF_ROUTES) -> DataFrame:
    """All ``fields`` of ``raw``: missing columns and nulls get the default, arrays are never null."""

    def one(name: str) -> Column:
        kind = TYPES.get(name, "string")
        value = (F.col(name) if name in raw.columns else F.lit(None)).cast(kind)
        if name in ARRAYS:
            return F.coalesce(value, F.array().cast(kind)).alias(name)
        return (F.coalesce(value, F.lit(DEFAULTS[name])) if name in DEFAULTS else value).alias(name)

    return raw.select(*[one(f) for f in fields])


def wire(entries: DataFrame) -> DataFrame:
    """id and record: the JSON of an entry, with the fields of its kind only and nulls kept."""
    json = lambda names: F.to_json(F.struct(*SHARED, *names), {"ignoreNullFields": "false"})
    return entries.select("id", F.when(F.col("kind") == "place", json(OF_PLACES)).otherwise(json(OF_ROUTES)).alias("record"))


def largest_image(images: Column) -> Column:
    """The (width, height) of the largest image of a page by area; of equal ones the first."""
    ranked = F.transform(images, lambda d, i: F.struct((d.width.cast("long") * d.height).alias("area"), (-i).alias("at"), d.alias("d")))
    return F.array_max(ranked).d
