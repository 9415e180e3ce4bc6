"""Text functions on names and ids, as Column builders; all run in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The patterns of names, elevations, stations and ids.
ELEVATION = r"(?U),?\s*\(?(\d{3,4})\s*m\)?\.?\s*$"
STATION_FIRST = r"(?U)^(berg|tal|mittel)station\s+(?:de[rs]\s+)?(.+)$"
STATION_LAST = r"(?U)^(.+?)\s+(berg|tal|mittel)station$"
ENTRY_NUMBER = r"(?U)(\d+)(?:\s*([A-Za-z])(?![A-Za-z]))?"
ELEVATION_TAG = r"-?\d+(?:[.,]\d+)?"
FOOTER_LINE = r"(?md)^[ \t]*\d{1,4}[ \t]*$"
HYPHEN_BREAK = r"(?U)-\n\s*"
ID_TOKEN = r"\d+(?:\s*[A-Za-z](?![A-Za-z]))?"
REFERENCES = rf"(?U)(?<![A-Za-z])(?:R\s*|>-?){ID_TOKEN}(?:\s*(?:,|und)\s*{ID_TOKEN})*|(?:[Ww]eiter\s+)?[Ww]ie\s+dort"


def strip_elevation(surface: Column) -> Column:
    """The name without a trailing elevation, blanks and commas around it cut."""
    return F.btrim(F.regexp_replace(surface, ELEVATION, ""), F.lit(" ,"))


def stated_elevation(surface: Column) -> Column:
    """The trailing elevation in metres, or null."""
    return F.regexp_extract(surface, ELEVATION, 1).try_cast("double")


def casefold(s: Column) -> Column:
    return F.replace(F.lower(s), F.lit("ß"), F.lit("ss"))


def expand_umlauts(s: Column) -> Column:
    for one, two in (("ä", "ae"), ("ö", "oe"), ("ü", "ue"), ("ß", "ss")):
        s = F.replace(s, F.lit(one), F.lit(two))
    return s


def canonical_station(folded: Column) -> Column:
    """Both ways to name a lift's station become one; other names stay."""

    def named(lift: Column, position: Column) -> Column:
        return F.concat(F.regexp_replace(lift, "bahn$", ""), F.lit(" "), position, F.lit("station"))

    first = named(F.regexp_extract(folded, STATION_FIRST, 2), F.regexp_extract(folded, STATION_FIRST, 1))
    last = named(F.regexp_extract(folded, STATION_LAST, 1), F.regexp_extract(folded, STATION_LAST, 2))
    return F.when(folded.rlike(STATION_FIRST), first).when(folded.rlike(STATION_LAST), last).otherwise(folded)


def norm_key(name: Column) -> Column:
    """The key names are matched by."""
    return F.regexp_replace(expand_umlauts(canonical_station(casefold(strip_elevation(name)))), "[^a-z0-9]", "")


def norm_name(name: Column) -> Column:
    """White space collapsed and case folded, letters as they are."""
    return casefold(squeezed(name))


def squeezed(s: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(s, r"(?U)\s+", " "), "^ | $", "")


def slug(name: Column) -> Column:
    return F.btrim(F.regexp_replace(expand_umlauts(casefold(name)), "[^a-z0-9]+", "-"), F.lit("-"))


def case_id(entry_id: Column, name: Column, kind_of_place: Column, kind: Column) -> Column:
    """A file-safe id of an open case; a missing type is hashed as the word None."""
    known = F.coalesce(kind_of_place, F.lit("None"))
    label = F.when(kind == "place", "place").otherwise(known)
    digest = F.substring(F.sha1(F.concat_ws("\x1f", entry_id, name, known, kind)), 1, 8)
    return F.concat_ws("__", entry_id, slug(name), label, digest)


def poi_id(osm: Column) -> Column:
    return F.concat(F.lit("osm-"), F.replace(osm, F.lit("/"), F.lit("-")))


def normalize_entry_id(raw: Column) -> Column:
    """R, the first number without leading zeros, and a lone letter in upper case; null without a number."""
    number = F.regexp_extract(raw, ENTRY_NUMBER, 1)
    digits = F.when(number != "", F.coalesce(F.nullif(F.ltrim(number, F.lit("0")), F.lit("")), F.lit("0")))
    return F.concat(F.lit("R"), digits, F.upper(F.regexp_extract(raw, ENTRY_NUMBER, 2)))


def entry_id_number(entry_id: Column) -> Column:
    return F.regexp_extract(entry_id, r"\d+", 0).try_cast("bigint")


def synthetic_id(page: Column, position: Column) -> Column:
    return F.format_string("p%04d_%02d", page, position)


def page_stem(page: Column) -> Column:
    return F.format_string("page_%04d", page)


def parse_references(text: Column) -> Column:
    """Ordered distinct (ref_id, surface) of the cross-references in a text; ref_id is null for 'wie dort'."""
    found = F.regexp_extract_all(text, F.lit(REFERENCES), F.lit(0))

    def expanded(surface: Column) -> Column:
        ids = F.regexp_extract_all(surface, F.lit(f"(?U){ID_TOKEN}"), F.lit(0))
        shared = F.transform(ids, lambda i: F.struct(normalize_entry_id(i).alias("ref_id"), surface.alias("surface")))
        alone = F.array(F.struct(F.lit(None).cast("string").alias("ref_id"), surface.alias("surface")))
        return F.when(F.size(ids) > 0, shared).otherwise(alone)

    return F.array_distinct(F.flatten(F.transform(F.coalesce(found, F.array().cast("array<string>")), expanded)))


def parse_elevation(tag: Column) -> Column:
    return F.replace(F.regexp_extract(tag, ELEVATION_TAG, 0), F.lit(","), F.lit(".")).try_cast("double")


def escaped(s: Column) -> Column:
    """Backslashes doubled, then bars escaped, so that a table cell stays one cell."""
    return F.replace(F.replace(s, F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\|"))


def cell(value: Column) -> Column:
    """A table cell: white space collapsed, backslashes and bars escaped, a dash for nothing."""
    return F.coalesce(F.nullif(escaped(squeezed(value)), F.lit("")), F.lit("—"))


def short_number(value: Column) -> Column:
    """A number with six significant digits and no trailing zeros."""
    size = F.abs(value)
    out = F.format_string("%.5e", value)
    for limit, digits in ((1e6, 0), (1e5, 1), (1e4, 2), (1e3, 3), (1e2, 4), (1e1, 5)):
        plain = F.bround(value, digits)
        out = F.when(size < limit, F.format_string(f"%.{digits}f", plain)).otherwise(out)
    return F.regexp_replace(F.regexp_replace(out, r"(\.\d*?)0+(?=$|e)", "$1"), r"\.(?=$|e)", "")


def metres(value: Column) -> Column:
    return F.when(value.isNotNull(), F.concat(short_number(value), F.lit(" m"))).otherwise("—")


def elevation_delta(stated: Column, found: Column) -> Column:
    """Stated less found in whole metres, half to even, with its sign; a dash where either is unknown."""
    gap = stated - found
    return F.when(gap.isNotNull(), F.concat(F.when(gap < 0, "-").otherwise("+"), F.abs(F.bround(gap, 0)).cast("bigint").cast("string"), F.lit(" m"))).otherwise("—")


def excerpt(text: Column, needle: Column, width: int) -> Column:
    """At most ``width`` characters of the text on one line, escaped; a dash for no text.

    Around the needle, in either case and with its white space collapsed, where
    it stands; else the head. At the text's end the window moves left.
    """
    return excerpt_of(squeezed(text), needle, width)


def excerpt_of(flat: Column, needle: Column, width: int) -> Column:
    """The same of a text whose white space is collapsed already, which is read several times."""
    flat, sought = F.coalesce(flat, F.lit("")), F.coalesce(squeezed(needle), F.lit(""))
    at = F.when(sought != "", F.instr(F.lower(flat), F.lower(sought))).otherwise(0)

    def cut(v: Column) -> Column:
        """From (text, its length, the needle's place and length), so that the search is done once."""
        first = F.greatest(F.lit(0), v["at"] - 1 - F.floor((F.lit(width) - v["wide"]) / 2).cast("int"))
        end = F.when(v["at"] > 0, F.least(v["size"], first + width)).otherwise(F.least(v["size"], F.lit(width)))
        begin = F.greatest(F.lit(0), end - width)
        return F.concat(F.when(begin > 0, "…").otherwise(""), F.substring(v["text"], begin + 1, end - begin), F.when(end < v["size"], "…").otherwise(""))

    found = F.array(F.struct(flat.alias("text"), F.length(flat).alias("size"), at.alias("at"), F.length(sought).alias("wide")))
    return F.when(flat == "", "—").otherwise(escaped(F.transform(found, cut)[0]))


def distance_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Flat distance, scaled by the cosine of the mean latitude."""
    return F.hypot((lat2 - lat1) * 111.32, (lon2 - lon1) * 111.32 * F.cos(F.radians((lat1 + lat2) / 2)))
