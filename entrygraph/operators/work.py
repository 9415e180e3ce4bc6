"""Work lists: batches, what is still to do, repairs, and the audit sample."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from entrygraph.functions import text


def batches(units: DataFrame, order: str, size: int, done: DataFrame | None = None, stable: bool = True) -> DataFrame:
    """Units with their batch; done ones (by the order column) are left out, after numbering if stable."""
    at = Window.partitionBy("guide_id").orderBy(order)
    number = (F.floor((F.row_number().over(at) - 1) / size) + 1).cast("int")
    if done is None:
        return units.withColumn("batch", number)
    keys = ["guide_id", order]
    if stable:
        return units.withColumn("batch", number).join(done.select(*keys), keys, "left_anti")
    return units.join(done.select(*keys), keys, "left_anti").withColumn("batch", number)


def destination_context(entries: DataFrame, place_pois: DataFrame) -> DataFrame:
    """Entries with the name and the feature of their destination."""
    names = entries.select(F.col("id").alias("destination_id"), F.col("name").alias("destination_name"))
    features = place_pois.select(F.col("place_id").alias("destination_id"), F.col("poi_id").alias("destination_poi"))
    return entries.join(names, "destination_id", "left").join(features, "destination_id", "left")


def match_repairs(repairs: DataFrame, parts: DataFrame) -> DataFrame:
    """Repairs with the part row they mean: by id on the page if just one has it, else by name if just one has it."""
    p = parts.select("page", F.col("position"), text.normalize_entry_id(F.col("raw_id")).alias("_id"), F.col("name").alias("_name"))
    alone = lambda *key: F.count("*").over(Window.partitionBy(*key)) == 1
    by_id = p.filter("_id is not null").withColumn("_one", alone("page", "_id")).filter("_one").select("page", "_id", F.col("position").alias("_by_id"))
    by_name = p.withColumn("_one", alone("page", "_name")).filter("_one").select("page", "_name", F.col("position").alias("_by_name"))
    r = repairs.withColumn("_id", text.normalize_entry_id(F.col("entry_id"))).withColumn("_name", F.col("name"))
    met = r.join(by_id, ["page", "_id"], "left").join(by_name, ["page", "_name"], "left")
    return met.withColumn("position", F.coalesce("_by_id", "_by_name")).drop("_id", "_name", "_by_id", "_by_name")


def apply_repairs(parts: DataFrame, matched: DataFrame) -> DataFrame:
    """Parts with the repaired anchors; the last repair of a part counts."""
    last = matched.filter("position is not null").groupBy("page", "position").agg(F.max_by("start_quote", "seq").alias("_start"), F.max_by("end_quote", "seq").alias("_end"))
    out = parts.join(last, ["page", "position"], "left")
    return out.withColumn("start_quote", F.coalesce("_start", "start_quote")).withColumn("end_quote", F.coalesce("_end", "end_quote")).drop("_start", "_end")


def audit_sample(rows: DataFrame, key: str, method: str, size: int, seed: int, also: Sequence[str] = ()) -> DataFrame:
    """The rows to look at: uncertain methods first, then reviewed ones, in an order drawn by seed and key (then ``also``)."""
    tier = F.when(F.col(method).isin("fuzzy", "llm"), 0).when(F.col(method) == "review", 1).otherwise(2)
    draw = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))
    return rows.withColumn("tier", tier).withColumn("draw", draw).orderBy("tier", "draw", key, *also).limit(size)


def markdown_row(cells: list[Column]) -> Column:
    return F.concat(F.lit("| "), F.concat_ws(" | ", *[text.cell(c) for c in cells]), F.lit(" |"))


# The funnel's columns, and the width of each.
FUNNEL_COLUMNS, FUNNEL_WIDTH = ("mentions", "exact", "fuzzy", "llm", "review", "tie", "skipped", "unmatched"), 11


def _right(cell: Column, width: int = FUNNEL_WIDTH) -> Column:
    return F.lpad(cell, F.greatest(F.length(cell), F.lit(width)), " ")


def funnel_table(funnel: DataFrame) -> DataFrame:
    """One row of text: the funnel (a row a type, totals with type null) as a table, most mentions first, totals last.

    There are a few types, so one row holds them.
    """
    name = F.coalesce("type", F.lit("total"))
    cells = F.concat(*[_right(F.col(c).cast("string")) for c in FUNNEL_COLUMNS])
    row = F.struct(F.col("type").isNull().alias("total"), (-F.col("mentions")).alias("n"), name.alias("name"), cells.alias("cells"))
    told = funnel.agg(F.array_sort(F.collect_list(row)).alias("rows"), F.greatest(F.max(F.length(name)), F.length(F.lit("total"))).alias("width"))
    head = F.concat(F.rpad(F.lit("type"), F.col("width"), " "), *[_right(F.lit(c)) for c in FUNNEL_COLUMNS])
    lines = F.transform("rows", lambda r: F.concat(F.rpad(r["name"], F.col("width"), " "), r.cells))
    return told.select(F.concat_ws("\n", head, lines).alias("text"))


def funnel_summary(funnel: DataFrame, entries: DataFrame, review: str, unmatched: str) -> DataFrame:
    """One row of text: how many entries (with has_part) have mentions, and what is open and left over, with where to look."""
    told = entries.agg(F.count(F.lit(1)).alias("_all"), F.count_if("has_part").alias("_with")).crossJoin(funnel.filter("type is null").select("tie", "unmatched"))  # one row each
    text_of = lambda c: F.col(c).cast("string")
    return told.select(
        F.concat(F.lit("[plan funnel] "), text_of("_with"), F.lit("/"), text_of("_all"), F.lit(" entries have extracted mentions; "), text_of("tie"), F.lit(f" open ties in {review}, "), text_of("unmatched"), F.lit(f" unmatched in {unmatched}.")).alias("text")
    )
