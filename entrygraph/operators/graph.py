"""Queries over the linked graph of entries and map features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def linked_places(places: DataFrame, links: DataFrame, pois: DataFrame) -> DataFrame:
    """Places with their feature; links to unknown places or features are passed over, the last valid one counts."""
    valid = links.join(pois.select("poi_id"), "poi_id", "left_semi")
    last = valid.groupBy("place_id").agg(F.max_by("poi_id", "seq").alias("poi_id"))
    return places.join(last.withColumnRenamed("place_id", "id"), "id", "left")


def uncoordinated(linked: DataFrame) -> DataFrame:
    return linked.filter("poi_id is null")


def mapped(linked: DataFrame) -> DataFrame:
    return linked.filter("poi_id is not null")


def mentions(entries: DataFrame, links: DataFrame, pois: DataFrame) -> DataFrame:
    """For each entry its mentioned features in the order of the links, repeats kept."""
    met = links.join(pois.select("poi_id"), "poi_id", "left_semi").join(entries.select(F.col("id").alias("entry_id")), "entry_id", "left_semi")
    listed = F.transform(F.array_sort(F.collect_list(F.struct("seq", "poi_id"))), lambda x: x.poi_id)
    return met.groupBy("entry_id").agg(listed.alias("poi_ids"))


def destinations(routes: DataFrame, places: DataFrame) -> DataFrame:
    """Routes with their destination where it is a place."""
    known = places.select(F.col("id").alias("destination_id"), F.col("name").alias("destination_name"))
    return routes.join(known, "destination_id", "left").withColumn("resolved_id", F.when(F.col("destination_name").isNotNull(), F.col("destination_id")))


def route_places(routes: DataFrame, places: DataFrame) -> DataFrame:
    """For each route its place_ids that are places, in order."""
    one = routes.select("id", F.posexplode("place_ids").alias("at", "place_id"))
    met = one.join(places.select(F.col("id").alias("place_id")), "place_id", "left_semi")
    return met.groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "place_id"))), lambda x: x.place_id).alias("places"))


def routes_leading_here(routes: DataFrame, places: DataFrame, order: str = "id") -> DataFrame:
    """Places with how many routes end there, most first; ties in the order of ``order``."""
    n = routes.groupBy("destination_id").agg(F.count("*").alias("n_routes"))
    met = places.join(n, places["id"] == n["destination_id"], "left")
    return met.select(places["id"], places["name"], F.coalesce("n_routes", F.lit(0)).alias("n_routes"), places[order].alias("_order")).orderBy(F.desc("n_routes"), "_order").drop("_order")


def placeless_routes(routes: DataFrame, places: DataFrame) -> DataFrame:
    """Routes with neither a destination nor a waypoint that is a place."""
    met = destinations(routes, places).filter("resolved_id is not null").select("id")
    through = route_places(routes, places).select("id")
    return routes.join(met.unionByName(through).distinct(), "id", "left_anti")


def references(refs: DataFrame, entries: DataFrame) -> DataFrame:
    """References with their target: resolved, dangling, or without an id (anaphora)."""
    target = entries.select(F.col("id").alias("ref_id"), F.col("name").alias("target_name"))
    state = F.when(F.col("ref_id").isNull(), "anaphora").when(F.col("target_name").isNull(), "dangling").otherwise("resolved")
    return refs.join(target, "ref_id", "left").withColumn("state", state)


def entries_by_poi(place_links: DataFrame, links: DataFrame) -> DataFrame:
    """For each feature its entries, each once, in first-seen order: those whose place it is, then those that mention it.

    place_links: (seq, place_id, poi_id); links: (seq, entry_id, poi_id); both
    of known entries and features.
    """
    own = place_links.select("poi_id", F.col("place_id").alias("entry_id"), F.struct(F.lit(0).alias("t"), "seq").alias("o"))
    told = links.select("poi_id", "entry_id", F.struct(F.lit(1).alias("t"), "seq").alias("o"))
    first = own.unionByName(told).groupBy("poi_id", "entry_id").agg(F.min("o").alias("o"))
    return first.groupBy("poi_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("o", "entry_id"))), lambda x: x.entry_id).alias("entry_ids"))


def targets(routes: DataFrame, linked: DataFrame) -> DataFrame:
    """(entry_id, poi_id) of what an entry leads to: a route's destination and waypoint places, a place's own feature.

    routes: id, destination_id, place_ids; linked: places with their poi_id.
    """
    found = mapped(linked).select(F.col("id").alias("place_id"), "poi_id")
    led = routes.select(F.col("id").alias("entry_id"), F.explode(F.concat(F.array("destination_id"), F.coalesce("place_ids", F.array().cast("array<string>")))).alias("place_id"))
    return led.join(found, "place_id").select("entry_id", "poi_id").unionByName(found.select(F.col("place_id").alias("entry_id"), "poi_id")).distinct()


def highlight(entry_id: Column, targets: DataFrame, mentioned: DataFrame) -> DataFrame:
    """(poi_id, role) of a selected entry: what it leads to and what it mentions; a target stays one."""
    t = targets.filter(F.col("entry_id") == entry_id).select("poi_id", F.lit("target").alias("role"))
    m = mentioned.filter(F.col("entry_id") == entry_id).select("poi_id", F.lit("mention").alias("role"))
    return t.unionByName(m.join(t, "poi_id", "left_anti")).distinct()


def visible(pois: DataFrame, place_pois: DataFrame, mentioned: DataFrame) -> DataFrame:
    """Features of places, and those that the selected entry mentions."""
    seen = place_pois.select("poi_id").unionByName(mentioned.select("poi_id")).distinct()
    return pois.join(seen, "poi_id", "left_semi")


def search(rows: DataFrame, columns: list[str], needle: str) -> DataFrame:
    """Rows in whose columns, joined by blanks, the needle stands, in either case."""
    joined = F.concat_ws(" ", *[F.coalesce(c, F.lit("")) for c in columns])
    return rows.filter(F.contains(F.lower(joined), F.lower(F.lit(needle.strip()))))


def extent(points: DataFrame, zoom: int = 12) -> DataFrame:
    """How to frame points: the default view for none, a centre for one, else their bounds."""
    b = points.agg(F.count("*").alias("n"), *[f(c).alias(f"{n}_{c}") for c in ("lon", "lat") for n, f in (("min", F.min), ("max", F.max))])
    kind = F.when(F.col("n") == 0, "default").when(F.col("n") == 1, "center").otherwise("bounds")
    return b.select(kind.alias("kind"), F.when(F.col("n") == 1, zoom).alias("zoom"), "n", "min_lon", "min_lat", "max_lon", "max_lat")


def guide_boxes(guides: DataFrame, colours: int) -> DataFrame:
    """Each guide's box as a closed ring, its centre, and its colour by position."""
    w, s, e, n = (F.col("bbox")[i] for i in range(4))
    ring = F.array(F.array(w, s), F.array(e, s), F.array(e, n), F.array(w, n), F.array(w, s))
    position = F.row_number().over(Window.orderBy("id")) - 1  # a manifest has a row a guide
    return guides.select("id", "name", ring.alias("ring"), ((w + e) / 2).alias("lon"), ((s + n) / 2).alias("lat"), F.pmod(position, F.lit(colours)).alias("colour"))


def peak_labels(pois: DataFrame) -> DataFrame:
    """Peaks with the text of their label, its second line the height as it stands; the highest first."""
    number = F.regexp_replace(F.col("ele").cast("string"), r"\.0$", "")
    label = F.concat("name", F.coalesce(F.concat(F.lit("\n"), number, F.lit(" m")), F.lit("")))
    peaks = pois.filter("type = 'peak'").select("poi_id", label.alias("label"), F.coalesce("ele", F.lit(0.0)).alias("height"))
    return peaks.orderBy(F.desc("height"), "poi_id")


def valid_guides(raw: DataFrame, *also: str) -> DataFrame:
    """Manifest rows with id and label, a name that is not blank and a box of four finite numbers; and their columns ``also``."""
    finite = F.forall("bbox", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return raw.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & (F.trim("name") != "") & (F.size("bbox") == 4) & finite).select("id", "name", "label", "bbox", *also)


def has_value(value: Column) -> Column:
    return value.isNotNull() & ~F.trim(value).isin("", "—", "-")


def colour_of(type_: Column, colours: dict[str, str], default: str) -> Column:
    out = None
    for k, v in colours.items():
        out = F.when(type_ == k, v) if out is None else out.when(type_ == k, v)
    return out.otherwise(default)


def valid_pois(raw: DataFrame, base_url: str) -> DataFrame:
    """Features (poi_id, name, type, ele, osm, coordinates) with an id and a point, and their address under ``base_url``."""
    point = (F.size("coordinates") >= 2) & F.col("coordinates")[0].isNotNull() & F.col("coordinates")[1].isNotNull()
    return raw.filter(F.col("poi_id").isNotNull() & F.coalesce(point, F.lit(False))).withColumn("osm_url", F.concat(F.lit(base_url), "osm"))


def valid_entries(raw: DataFrame, kinds: tuple[str, ...] = ("place", "route")) -> DataFrame:
    """Entries with an id and a known kind; a missing source of the description is inferred from whether there is one."""
    known = raw.filter(F.col("id").isNotNull() & F.col("kind").isin(*kinds))
    inferred = F.when(F.col("description").isNotNull(), "sliced").otherwise("none")
    return known.withColumn("description_source", F.coalesce("description_source", inferred))


def marker_class(is_place: Column, role: Column) -> Column:
    """How a marker is drawn: by its role for the selected entry, else by whether a place lies there."""
    return F.when(role == "target", "target").when(role == "mention", "mention").when(is_place, "place").otherwise("plain")


def deep_link(requests: DataFrame, guides: DataFrame) -> DataFrame:
    """requests (url) with guide_id: the guide that the address names, if the manifest has it."""
    asked = F.try_parse_url("url", F.lit("QUERY"), F.lit("guide"))
    known = guides.select(F.col("id").alias("guide_id"))
    return requests.withColumn("_asked", asked).join(known, F.col("_asked") == F.col("guide_id"), "left").drop("_asked")
