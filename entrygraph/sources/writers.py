"""Sinks: tables by guide, JSON lines in order, GeoJSON and work batches."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entrygraph.sources.files import named_files


def by_guide(df: DataFrame, path: str) -> None:
    """Parquet by guide; only the guides in ``df`` are replaced."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("guide_id").parquet(path)


def json_lines(df: DataFrame, path: str, order: str, keep_nulls: bool = True) -> None:
    """JSON lines in order; nulls are kept unless keys may be left out. Sorted by range, so files follow each other."""
    ordered = df.repartitionByRange(order).sortWithinPartitions(order)
    ordered.write.mode("overwrite").option("ignoreNullFields", not keep_nulls).json(path)


def contract_array(df: DataFrame, order: str) -> DataFrame:
    """One JSON array a guide with its records in order."""
    fields = [c for c in df.columns if c not in ("guide_id", order)]
    rows = F.array_sort(F.collect_list(F.struct(order, F.struct(*fields).alias("r"))))
    return df.groupBy("guide_id").agg(F.to_json(F.transform(rows, lambda x: x.r), {"ignoreNullFields": "false"}).alias("routes"))


def feature_collection(features: DataFrame, path: str) -> None:
    """One GeoJSON collection of features given as text, by poi_id, as the lines of the files under ``path``.

    Read one after another, the files are the collection: a first line opens it,
    a last one closes it, and each feature but the first begins with a comma.
    No row holds more than one feature.
    """
    first = features.agg(F.min("poi_id")).first()[0]
    line = F.concat(F.when(F.col("poi_id") == F.lit(first), "").otherwise(","), "feature")
    lines = features.select(F.lit(1).alias("part"), "poi_id", line.alias("value"))
    spark = features.sparkSession
    frame = spark.createDataFrame([(0, "", '{"type":"FeatureCollection","features":['), (2, "", "]}")], "part int, poi_id string, value string")
    lines.unionByName(frame).repartitionByRange("part", "poi_id").sortWithinPartitions("part", "poi_id").select("value").write.mode("overwrite").text(path)


def page_texts(pages: DataFrame, path: str) -> None:
    """Page texts and their manifest, by guide: pages has guide_id, page, text, char_count, rotation, n_images, largest_image, is_sketch."""
    pages.select("guide_id", "page", "text").write.mode("overwrite").partitionBy("guide_id").parquet(f"{path}/pages")
    meta = pages.select("guide_id", "page", F.format_string("page_%04d", "page").alias("stem"), "char_count", "rotation", "n_images", "largest_image", "is_sketch")
    meta.repartitionByRange("guide_id", "page").sortWithinPartitions("guide_id", "page").write.mode("overwrite").option("ignoreNullFields", False).partitionBy("guide_id").json(f"{path}/manifest")


def match_outputs(tables: dict[str, DataFrame], path: str) -> None:
    """All tables of a matching pass under ``path``, each replaced; the resolution they are read off is written once."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}")


def work_batches(df: DataFrame) -> DataFrame:
    """One JSON line a batch with its units in order."""
    units = F.transform(F.array_sort(F.collect_list("seq")), lambda x: x)
    return df.groupBy("guide_id", "batch").agg(units.alias("units")).select("guide_id", "batch", F.to_json(F.struct("batch", "units")).alias("line"))


def entry_files(entries: DataFrame, path: str) -> None:
    """One JSON file an entry (id and the published fields), named by its id; the folder is built anew, once all are written."""
    value = F.to_json(F.struct(*entries.columns), {"ignoreNullFields": "false"})
    named_files(entries.select(F.concat("id", F.lit(".json")).alias("name"), value.alias("value")), path, indent=2)


def _anchored(values: pd.Series, edits: pd.Series) -> pd.Series:
    """Part files with the anchors of some entries replaced, everything else as it was."""
    out = []
    for value, listed in zip(values, edits):
        part = json.loads(value)
        for e in listed:
            part["entries"][e["position"] - 1] |= {"start_quote": e["start_quote"], "end_quote": e["end_quote"]}
        out.append(json.dumps(part, ensure_ascii=False))
    return pd.Series(out)


def rewrite_parts(spark: SparkSession, path: str, matched: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Write repaired anchors back into the part files (page_NNNN.json) under ``path``; gives (applied, skipped) repairs.

    matched: repairs with seq and the position (from 1) of the entry they mean,
    as ``work.match_repairs`` tells it; of several for one entry the last counts.
    Only files in which an entry is repaired are written, each in one step when
    all are ready; the others stay byte for byte.
    """
    applied, skipped = matched.filter("position is not null"), matched.filter("position is null")
    each = F.struct("seq", "position", "start_quote", "end_quote")
    # a page has few entries, so a row holds its repairs
    edits = applied.groupBy("page").agg(F.array_sort(F.collect_list(each)).alias("edits"))
    edits = edits.select("page", F.transform("edits", lambda e: F.struct(e.position.cast("int").alias("position"), e.start_quote.alias("start_quote"), e.end_quote.alias("end_quote"))).alias("edits"))
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("name"), F.regexp_extract("_metadata.file_name", r"page_(\d+)", 1).cast("int").alias("page"), "value")
    changed = F.pandas_udf(_anchored, "string")("value", "edits")
    named_files(files.join(edits, "page").select("name", changed.alias("value")), path, "append")
    return applied, skipped
