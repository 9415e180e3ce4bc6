"""A feature dump, one JSON document with an array of elements, read in splits.

The file is cut into byte ranges; a task reads the elements that begin in its
range, the last of them as far as it goes. An element begins with its type and
id, ``{"type": ..., "id": ...``, whatever white space there is. That cannot stand
inside a text, where quotes are escaped, and members of relations have no id, so
a range needs nothing of what lies before it. Splits go through the file systems
that Arrow knows; a task holds a chunk and one element.

Defined cases: no elements give no rows; a document that is cut short, or an
element that is malformed, ends the read; other fields are passed over.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from entrygraph.plans.shipping import ship

ELEMENT = "type string, id bigint, lat double, lon double, center struct<lat: double, lon: double>, tags map<string, string>"
#: Bytes of a split, and of a read.
SPLIT, CHUNK = 32 << 20, 1 << 20
#: How an element begins. What of it a chunk may end in is at most REACH bytes, white space included.
BEGIN = re.compile(rb'\{\s*"type"\s*:\s*"[a-z]+"\s*,\s*"id"\s*:')
REACH = 4096


def opened(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or URI, and the path in it."""
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


class Range(InputPartition):
    def __init__(self, begin: int, end: int, size: int):
        self.begin, self.end, self.size = begin, end, size


def split_elements(file, begin: int, end: int, chunk: int = CHUNK) -> Iterator[bytes]:
    """The bytes of each element that begins in [begin, end) of ``file``, with what follows it up to the next one."""
    file.seek(begin)
    at, held, begun = begin, b"", -1
    # held are the bytes from place ``at`` on; begun is where the element that is open begins in them
    searched = 0
    while True:
        while match := BEGIN.search(held, searched):
            place = at + match.start()
            if begun >= 0:
                yield held[begun : match.start()]
                begun = -1
            if place >= end:
                return
            begun, searched = match.start(), match.end()
        keep = begun if begun >= 0 else max(0, len(held) - REACH)
        searched = max(searched, len(held) - REACH) - keep
        held, at = held[keep:], at + keep
        begun = 0 if begun >= 0 else -1
        searched = max(searched, 1 if begun == 0 else 0)
        if begun < 0 and at + len(held) >= end + REACH:
            return
        more = file.read(chunk)
        if not more:
            if begun >= 0:
                yield held
            return
        held += more


def parsed(data: bytes) -> tuple[tuple, str]:
    """An element's row and what follows it."""
    text = data.decode("utf-8")
    e, end = json.JSONDecoder().raw_decode(text)
    number = lambda x: None if x is None else float(x)
    center = e.get("center")
    place = None if center is None else (number(center.get("lat")), number(center.get("lon")))
    tags = None if e.get("tags") is None else {str(k): str(v) for k, v in e["tags"].items()}
    return (e["type"], int(e["id"]), number(e.get("lat")), number(e.get("lon")), place, tags), text[end:].strip()


class DumpReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.split = options["path"], int(options.get("split", SPLIT))

    def partitions(self) -> list[Range]:
        system, path = opened(self.path)
        size = system.get_file_info(path).size
        if size is None:
            raise FileNotFoundError(f"missing {self.path}: run the download first")
        return [Range(i, min(i + self.split, size), size) for i in range(0, size, self.split)] or [Range(0, 0, 0)]

    def read(self, part: Range) -> Iterator[tuple]:
        system, path = opened(self.path)
        with system.open_input_file(path) as file:
            for data in split_elements(file, part.begin, part.end):
                row, behind = parsed(data)
                if behind[:1] not in (",", "]"):
                    raise ValueError(f"{self.path} is malformed or cut short after {row[0]}/{row[1]}")
                yield row
            if part.end == part.size:
                # the document's end is in the last split
                file.seek(max(0, part.size - REACH))
                if not file.read().rstrip().endswith(b"}"):
                    raise ValueError(f"{self.path} is cut short")


class Dump(DataSource):
    """Reads ``path``; option split: bytes of a split."""

    @classmethod
    def name(cls) -> str:
        return "feature_dump"

    def schema(self) -> str:
        return ELEMENT

    def reader(self, schema) -> DumpReader:
        return DumpReader(self.options)


def elements(spark: SparkSession, path: str, split: int = SPLIT) -> DataFrame:
    """One row an element of a landed dump: type, id, lat, lon, center and tags."""
    ship(spark)
    spark.dataSource.register(Dump)
    return spark.read.format("feature_dump").option("split", str(split)).load(path)
