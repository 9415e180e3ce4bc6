"""Sources: pages, manifests, parts, decisions and verdicts, with what is malformed reported or refused."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from entrygraph.operators import entries, graph, planning

PAGE_META = "page int, stem string, char_count int, rotation int, n_images int, largest_image array<int>, is_sketch boolean"
PART_ENTRY = "kind string, entry_id_raw string, name string, summary string, start_quote string, end_quote string, place_type string, elevation string, peak string, grade string, first_ascent string, time string, height_m string, place_names array<string>"
MENTIONS = "entry_id string, mentions array<struct<surface string, name string, type string, elevation_m double>>"
FEATURE = "name string, type string, lat double, lon double, ele double, osm string"
VERDICT = "case_id string, pick string, reason string"
ELEMENTS = "version double, elements array<struct<type string, id bigint, lat double, lon double, center struct<lat double, lon double>, tags map<string, string>>>"


def pages(spark: SparkSession, path: str, min_chars: int = 200) -> DataFrame:
    """Page texts from one file a page (page_NNNN): page, text, char_count, is_sketch."""
    raw = spark.read.text(path, wholetext=True).select(F.regexp_extract(F.input_file_name(), r"page_(\d+)", 1).cast("int").alias("page"), F.col("value").alias("text"))
    size = F.length(F.trim("text"))
    return raw.withColumn("char_count", size).withColumn("is_sketch", size < min_chars)


def strict_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines; a malformed one ends the read."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def permissive_lines(spark: SparkSession, path: str, schema: str, watch: Observation | None = None) -> tuple[DataFrame, DataFrame]:
    """(records, malformed lines) of JSON lines.

    ``watch`` gets n_lines, n_blank and n_bad of the scan that the records come
    from, once these have been read: no second read counts them.
    """
    lines = spark.read.text(path).withColumn("r", _parsed("value", schema))
    blank, bad = F.trim("value") == "", F.col("r._bad").isNotNull()
    seen = lines if watch is None else lines.observe(watch, F.count(F.lit(1)).alias("n_lines"), F.count_if(blank).alias("n_blank"), F.count_if(bad & ~blank).alias("n_bad"))
    return seen.filter(~blank & ~bad).select("r.*").drop("_bad"), lines.filter(~blank & bad).select(F.col("value").alias("line"))


def _parsed(column: str, schema: str):
    return F.from_json(column, f"{schema}, _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})


def parsed_lines(df: DataFrame, column: str, schema: str, watch: Observation | None = None) -> DataFrame:
    """Rows whose column is JSON of the schema, with it as ``record``; blank and bad ones are passed over.

    ``watch`` gets n_lines, n_blank (nulls too) and n_bad of the scan.
    """
    rows = df.withColumn("record", _parsed(column, schema))
    blank = F.coalesce(F.trim(column) == "", F.lit(True))
    bad = ~blank & (F.col("record").isNull() | F.col("record._bad").isNotNull())
    if watch is not None:
        rows = rows.observe(watch, F.count(F.lit(1)).alias("n_lines"), F.count_if(blank).alias("n_blank"), F.count_if(bad).alias("n_bad"))
    return rows.filter(~blank & ~bad)


def parts(spark: SparkSession, path: str, watch: Observation | None = None) -> tuple[DataFrame, DataFrame]:
    """(entries, corrupt files) of one JSON file a page: page, position from 1, and the extracted fields.

    ``watch`` gets n_files and n_corrupt of the scan that the entries come from.
    """
    files = spark.read.text(path, wholetext=True).select(F.regexp_extract(F.input_file_name(), r"page_(\d+)", 1).cast("int").alias("page"), _parsed("value", f"entries array<struct<{PART_ENTRY}>>").alias("r"))
    corrupt = F.col("r._bad").isNotNull()
    seen = files if watch is None else files.observe(watch, F.count(F.lit(1)).alias("n_files"), F.count_if(corrupt).alias("n_corrupt"))
    good = seen.filter(~corrupt).select("page", F.posexplode("r.entries").alias("position", "e"))
    return good.select("page", (F.col("position") + 1).alias("position"), "e.*"), files.filter(corrupt).select("page")


def verdicts(spark: SparkSession, path: str) -> DataFrame:
    """External verdicts, one file a case; any malformed file ends the read and says which.

    A verdict needs a pick (text, or null for none), a reason, and no other case's id.
    """
    files = spark.read.text(path, wholetext=True).select(F.regexp_extract(F.input_file_name(), r"([^/]+)\.json$", 1).alias("_file"), F.try_parse_json("value").alias("_v"), _parsed("value", VERDICT).alias("r"))
    kind = lambda name: F.schema_of_variant(F.try_variant_get("_v", f"$.{name}", "variant"))
    name = F.url_decode("_file")
    picked = F.coalesce(kind("pick").isin("VOID", "STRING"), F.lit(False))
    own = kind("case_id").isNull() | F.col("r.case_id").eqNullSafe(name)
    whole = F.col("_v").isNotNull() & F.col("r._bad").isNull() & picked & own & (F.trim(F.coalesce("r.reason", F.lit(""))) != "")
    checked = F.when(whole, name).otherwise(F.raise_error(F.concat(F.lit("malformed verdict: "), F.col("_file"))))
    return files.select(checked.alias("case_id"), "r.pick", "r.reason")


def decisions(review: DataFrame) -> DataFrame:
    """Human decisions from review rows with seq: skip or one of the row's candidates; the last of a case counts."""
    named = F.col("decision").isNull() | (F.col("decision") == "skip") | F.exists("candidates", lambda c: c.osm == F.col("decision"))
    checked = F.when(named, F.col("decision")).otherwise(F.raise_error(F.concat(F.lit("unknown decision: "), F.col("decision"))))
    r = review.withColumn("decision", checked).withColumn("_row", F.struct("decision", "note"))
    last = r.groupBy("entry_id", "name", "type", "kind").agg(F.max_by("_row", "seq").alias("_row"))
    return last.select("entry_id", "name", "type", "kind", "_row.decision", "_row.note")


def elements(spark: SparkSession, path: str) -> DataFrame:
    """A landed feature dump."""
    return spark.read.schema(ELEMENTS).option("multiLine", True).json(path)


def mentions(spark: SparkSession, path: str) -> DataFrame:
    """Extracted mentions, one row each with their position in the file."""
    return strict_lines(spark, path, MENTIONS).select("entry_id", F.posexplode("mentions").alias("position", "m")).select("entry_id", "position", "m.*")


#: Where a guide's published tables lie under its folder.
PUBLISHED = {
    "entries": "parse-routes/03_structured/routes.json",
    "pois": "fetch-pois/04_final/pois.geojson",
    "place_links": "fetch-pois/04_final/place_pois.jsonl",
    "entry_links": "fetch-pois/04_final/entry_pois.jsonl",
}
ENTRY = (
    "id string, kind string, name string, place_type string, elevation string, peak string, grade string, time string, height_m string, first_ascent string, destination_id string, place_ids array<string>, "
    "references array<struct<ref_id string, surface string>>, summary string, description string, description_source string"
)
POI = "type string, geometry struct<type string, coordinates array<double>>, properties struct<poi_id string, name string, type string, ele double, osm string, aliases array<string>, n_entries bigint>"


def guide_paths(root: str, guide_id: str) -> dict[str, str]:
    """Where a guide's published tables lie."""
    return {n: f"{root}/{guide_id}/{p}" for n, p in PUBLISHED.items()}


def published(spark: SparkSession, root: str, guide_id: str) -> dict[str, DataFrame]:
    """A guide's published tables: entries, pois, place_links and entry_links; a missing one ends the read.

    Bad lines of the links are passed over; links keep their order in seq.
    """
    at = guide_paths(root, guide_id)
    whole = spark.read.option("multiLine", True)
    pois = whole.schema(f"features array<struct<{POI}>>").json(at["pois"]).select(F.inline("features")).select("properties.*", F.col("geometry.coordinates").alias("coordinates"))
    order = F.monotonically_increasing_id().alias("seq")
    links = lambda name, schema: permissive_lines(spark, at[name], schema)[0].select(order, "*")
    return {
        "entries": whole.schema(ENTRY).json(at["entries"]),
        "pois": pois,
        "place_links": links("place_links", "place_id string, poi_id string"),
        "entry_links": links("entry_links", "entry_id string, poi_id string, surface string"),
    }


def guides_manifest(spark: SparkSession, path: str) -> DataFrame:
    """The guides that can be used of a published manifest (a JSON array), in its order by seq; a missing one ends the read."""
    try:
        raw = spark.read.option("multiLine", True).schema("id string, name string, label string, bbox array<double>").json(path)
    except AnalysisException as e:
        if not _missing(e):
            raise
        raise FileNotFoundError(f"no guides manifest at {path}") from e
    return graph.valid_guides(raw.withColumn("seq", F.monotonically_increasing_id()), "seq")


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """The page manifest; a missing or malformed one ends the read."""
    return needed(spark, path, PAGE_META, "extraction")


def gazetteer(spark: SparkSession, path: str) -> DataFrame:
    return needed(spark, path, FEATURE, "the gazetteer")


def entry_index(spark: SparkSession, path: str) -> DataFrame:
    """The entries by id, in the order of code points."""
    return needed(spark, path, ENTRY, "assembly").orderBy("id")


def _missing(e: AnalysisException) -> bool:
    return e.getCondition() == "PATH_NOT_FOUND"


def needed(spark: SparkSession, path: str, schema: str, stage: str) -> DataFrame:
    """JSON lines that an earlier stage wrote; where they are missing, the error names it."""
    try:
        return strict_lines(spark, path, schema)
    except AnalysisException as e:
        if not _missing(e):
            raise
        raise FileNotFoundError(f"missing {path}: run {stage} first") from e


def optional_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines, or no rows where they have not been written yet; any other fault ends the read."""
    try:
        return strict_lines(spark, path, schema)
    except AnalysisException as e:
        if not _missing(e):
            raise
        return spark.createDataFrame([], schema)


def repairs(spark: SparkSession, path: str) -> DataFrame:
    """Repair files, one JSON record or list each, in the order of their names: seq, page, entry_id, name and anchors."""
    raw = spark.read.option("multiLine", True).schema("entry_id string, source_page int, name string, start_quote string, end_quote string").json(path)
    named = raw.select(F.col("_metadata.file_name").alias("_file"), F.monotonically_increasing_id().alias("_at"), F.col("source_page").alias("page"), "entry_id", "name", "start_quote", "end_quote")
    order = F.struct("_file", "_at")
    return named.withColumn("seq", order).drop("_file", "_at")


def section_map(spark: SparkSession, path: str, guide_id: str = "") -> DataFrame:
    """The sections of a guide's contents in their order: guide_id, position, role, title, book_page.

    An empty map, an unknown role, pages that do not ascend or a map without
    traverses end the read; so does a missing file.
    """
    raw = spark.read.option("multiLine", True).schema("sections array<struct<role string, title string, book_page int>>").json(path)
    sections = raw.select(F.lit(guide_id).alias("guide_id"), F.posexplode("sections").alias("position", "s")).select("guide_id", "position", "s.*")
    return entries.checked_sections(sections, list(planning.ROLE_POLICY), raw.select(F.lit(guide_id).alias("guide_id")))
