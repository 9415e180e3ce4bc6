"""Shared helpers of the corpus operators: reading, staging, size-checked joins, Arrow maps."""

from __future__ import annotations

import ctypes
import re
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from entrygraph.plans.staging import written

#: Tables above this many rows are never broadcast; rows here are narrow (under 100 bytes).
BROADCAST_ROWS = 300_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder of spark.checkpoint.dir and read it again, which cuts the lineage."""
    return written(df)


def join_checked(left: DataFrame, right: DataFrame, on: list[str], how: str, rows: int = BROADCAST_ROWS, each: Column | None = None) -> DataFrame:
    """Null-safe equi join; ``right`` (staged already) is broadcast only if its counted rows are at most ``rows``.

    ``each`` says as how many a row counts, where rows are not of one size.
    """
    marked = right.select(*[F.col(c).alias(f"_r_{c}") if c in on else F.col(c) for c in right.columns])
    if (right.agg(F.coalesce(F.sum(F.lit(1) if each is None else each), F.lit(0))).first()[0]) <= rows:
        marked = F.broadcast(marked)
    condition = None
    for c in on:
        one = left[c].eqNullSafe(marked[f"_r_{c}"])
        condition = one if condition is None else condition & one
    out = left.join(marked, condition, how)
    return out.drop(*[f"_r_{c}" for c in on]) if how not in ("left_semi", "left_anti") else out


def carried(docs: DataFrame) -> DataFrame:
    """row (all columns of ``docs``, whatever their names), k (doc_id) and th (the text's hash)."""
    return docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), F.col("doc_id").alias("k"), F.xxhash64("text").alias("th"))


def released(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` out of ``row``."""
    return rows.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


#: Partitions of an exchange by bucket at most; each then takes several buckets.
PARTITIONS = 20_000


def dealt(df: DataFrame, buckets: int) -> DataFrame:
    """Rows by their column bucket, each bucket in a partition of its own, not by hash, which would give some tasks several."""
    parts = min(buckets, PARTITIONS)
    return df.repartitionById(parts, F.pmod("bucket", F.lit(parts)).cast("int"))


#: A key is hot if it has at least a HOT-th of all rows, and at least LEAST_HOT; so at most HOT keys are.
HOT, LEAST_HOT = 100_000, 64


def join_hot(left: DataFrame, right: DataFrame, key: str, times: str) -> DataFrame:
    """Inner join of ``left`` with ``right``, which has one row a key and in ``times`` how many rows of ``left`` have it.

    Hot keys, at most HOT, are sent to all tasks; the others are dealt by key and
    none is large. Without hot keys nothing is sent. Both sides are staged already.
    """
    total, most = right.agg(F.sum(times), F.max(times)).first()
    least = max(LEAST_HOT, (total or 0) // HOT)
    if (most or 0) < least:
        return left.join(right.drop(times), key)
    hot = F.broadcast(right.filter(F.col(times) >= least).drop(times))
    rest = right.filter(F.col(times) < least).drop(times)
    return left.join(hot, key).unionByName(left.join(hot.select(key), key, "left_anti").join(rest, key))


def ascii_lower(text: Column) -> Column:
    """Lower case such that ASCII words come out as if only A-Z were lowered (the Kelvin sign would become k)."""
    return F.lower(F.replace(text, F.lit("K"), F.lit("ĸ")))


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, once a Spark context: they need not have it installed."""
    context = spark.sparkContext
    if getattr(context, "_entrygraph_sent", False):
        return
    root = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="entrygraph-code-")) / "entrygraph.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for source in sorted(root.rglob("*.py")):
            z.write(source, source.relative_to(root.parent).as_posix())
    context.addPyFile(str(archive))
    context._entrygraph_sent = True


#: Rows of an Arrow batch: with texts, Spark's own number of them takes much memory on both sides. Set where it is Spark's.
BATCH_ROWS = 2000
_ROWS_KEY, _SPARKS_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"


def arrow_map(df: DataFrame, run: Callable, schema: str) -> DataFrame:
    """mapInArrow by a function of the package; a task that ends gives its memory back, as Python workers live on."""
    spark = df.sparkSession
    ship(spark)
    if spark.conf.get(_ROWS_KEY, _SPARKS_ROWS) == _SPARKS_ROWS:
        spark.conf.set(_ROWS_KEY, str(BATCH_ROWS))

    def mapped(batches):
        try:
            yield from run(batches)
        finally:
            give_back()

    return df.mapInArrow(mapped, schema)


def give_back() -> None:
    """Unused memory to the system, where the C library can."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass


def map_rows(df: DataFrame, names: list[str], make: Callable[[], Callable[..., tuple]], schema: str, arrow: pa.Schema) -> DataFrame:
    """Apply a Python function to each row in Arrow batches.

    ``make`` is called once a task and gives the function; its arguments are the
    columns ``names`` of ``df``, its result a tuple in the order of ``schema``.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = make()
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
            rows = [one(*r) for r in zip(*columns)]
            if rows:
                yield pa.record_batch([pa.array(list(c), type=f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)

    return arrow_map(df.select(*names), run, schema)


_TYPES = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(), "double": pa.float64(), "binary": pa.binary()}


def arrow_schema(ddl: str) -> pa.Schema:
    """The Arrow schema of a flat DDL string such as ``doc_id long, n int``."""
    fields = []
    for part in re.split(r",\s*(?![^<]*>)", ddl):
        name, kind = part.split(maxsplit=1)
        kind = kind.strip()
        fields.append((name, pa.list_(_TYPES[kind[6:-1]]) if kind.startswith("array<") else _TYPES[kind]))
    return pa.schema(fields)
