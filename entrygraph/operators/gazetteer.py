"""Map features: classification, guarded admission, one row a linear feature."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from entrygraph.functions import text

#: Kilometres in a degree of latitude (a fixed value).
DEGREE_KM = 111.32


def classify(tags: Column, tag_map: Sequence[tuple[str, Sequence[tuple[str, str]]]]) -> Column:
    """The first type, in the map's order, one of whose (key, value) pairs is among the tags; none of an empty map."""
    out = F.when(F.lit(False), F.lit(""))
    for kind, pairs in tag_map:
        met = F.lit(False)
        for k, v in pairs:
            met = met | F.try_element_at(tags, F.lit(k)).eqNullSafe(F.lit(v))
        out = out.when(met, kind)
    return out


def parse_elements(raw: DataFrame, tag_map, guarded_map) -> DataFrame:
    """Named and located elements with their type; guarded ones are marked."""
    e = raw.select(F.explode("elements").alias("e")).select("e.*")
    lat, lon = (F.when(F.col("center").isNotNull(), F.col(f"center.{c}")).otherwise(F.col(c)) for c in ("lat", "lon"))
    plain, guarded = classify(F.col("tags"), tag_map), classify(F.col("tags"), guarded_map)
    name = F.try_element_at("tags", F.lit("name"))
    found = e.select(
        name.alias("name"), F.coalesce(plain, guarded).alias("type"), lat.alias("lat"), lon.alias("lon"), text.parse_elevation(F.try_element_at("tags", F.lit("ele"))).alias("ele"), F.concat_ws("/", "type", F.col("id").cast("string")).alias("osm"), plain.isNull().alias("guarded")
    )
    return found.filter("name <> '' and type is not null and lat is not null and lon is not null")


def dedupe_linear(features: DataFrame, types: Sequence[str]) -> DataFrame:
    """One row for each (type, name) of the given types: relations before ways before nodes, then the least id."""
    kind, number = F.split_part("osm", F.lit("/"), F.lit(1)), F.split_part("osm", F.lit("/"), F.lit(2)).cast("bigint")
    rank = F.when(kind == "relation", 0).when(kind == "way", 1).otherwise(2)
    linear = features.filter(F.col("type").isin(list(types)))
    one = linear.withColumn("_n", F.row_number().over(Window.partitionBy("type", "name").orderBy(rank, number))).filter("_n = 1").drop("_n")
    return features.filter(~F.col("type").isin(list(types))).unionByName(one)


def admit_guarded(candidates: DataFrame, features: DataFrame, km: float) -> DataFrame:
    """Candidates whose name no feature has and that lie at least ``km`` from every settlement.

    Settlements are met by grid cells of ``km`` in latitude and by the meridian
    distance at the cell's outermost latitude, so no candidate is compared with
    all settlements.
    """
    covered = features.select(text.norm_key(F.col("name")).alias("_key")).distinct()
    left = candidates.join(covered, text.norm_key(F.col("name")) == F.col("_key"), "left_anti")
    step = max(km, 1e-6) / DEGREE_KM
    row = lambda c: F.floor(c / step)
    towns = features.filter("type = 'settlement'").select(F.col("lat").alias("_lat"), F.col("lon").alias("_lon"))
    # within a latitude row, longitudes are cut by the width a settlement's reach has there
    spread = lambda r: step / F.greatest(F.cos(F.radians(F.least(F.greatest(F.abs(r), F.abs(r + 1)) * step + step, F.lit(89.9)))), F.lit(1e-3))
    reach = towns.select("*", F.explode(F.array(*[row(F.col("_lat")) + d for d in (-1, 0, 1)])).alias("_row"))
    reach = reach.withColumn("_col", F.explode(F.array(*[F.floor(F.col("_lon") / spread(F.col("_row"))) + d for d in (-1, 0, 1)])))
    placed = left.withColumn("_row", row(F.col("lat")))
    placed = placed.withColumn("_col", F.floor(F.col("lon") / spread(F.col("_row"))))
    near = (placed["_row"] == reach["_row"]) & (placed["_col"] == reach["_col"]) & (text.distance_km(F.col("lat"), F.col("lon"), F.col("_lat"), F.col("_lon")) < km)
    return placed.join(reach, near, "left_anti").drop("_row", "_col")


def query_text(tags: Sequence[tuple[str, str]], bbox: Sequence[float]) -> str:
    """The text of a feature query: a line for each tag pair, named features in the box only."""
    box = ",".join(f"{x:g}" for x in bbox)
    lines = dict.fromkeys(f'  nwr["{k}"="{v}"]["name"]({box});' for k, v in tags)
    return "\n".join(["[out:json][timeout:180];", "(", *lines, ");", "out center tags;"])
