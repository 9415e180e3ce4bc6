"""Human decisions that arrive in files, kept by case and applied again at every resolution.

Each micro-batch is merged into a table of the last decision a case: cases are
dealt to BUCKETS, and a batch writes those buckets anew that it touches, as
files of a version of its own (the batch's number). A version counts from when
its number is entered in ``done``, so a batch that failed half way is not seen,
and its repetition replaces what it left. Of a case's decisions the one with the
highest seq counts, whatever batch brought it: batches give what one run over
all of them gives.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: What a case is known by, and what is decided of it; seq orders decisions.
CASE = ("entry_id", "name", "type", "kind")
DECISION = "entry_id string, name string, type string, kind string, decision string, note string, seq bigint"
BUCKETS = 64


def _bucket() -> Column:
    return F.pmod(F.xxhash64(*CASE), F.lit(BUCKETS)).cast("int")


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table that may not have been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _latest(spark: SparkSession, store: str, before: int | None = None) -> DataFrame:
    """The rows of each bucket's last finished version (before one), with bucket."""
    done = _read(spark, f"{store}/done", "version bigint").distinct()
    rows = _read(spark, f"{store}/cases", f"{DECISION}, version bigint, bucket int")
    rows = rows.join(F.broadcast(done), "version", "left_semi")  # a number a batch
    if before is not None:
        rows = rows.filter(F.col("version") < before)
    # a bucket has rows in every version that wrote it, as decisions are replaced but never dropped
    last = rows.groupBy("bucket").agg(F.max("version").alias("version"))
    return rows.join(F.broadcast(last), ["bucket", "version"], "left_semi")  # BUCKETS rows


def current(spark: SparkSession, store: str) -> DataFrame:
    """The last decision of each case: entry_id, name, type, kind, decision, note; no rows before the first batch."""
    return _latest(spark, store).select(*CASE, "decision", "note")


def merge(batch: DataFrame, number: int, store: str) -> None:
    """Merge decisions (DECISION) into the store as version ``number``; repeating it changes nothing."""
    spark = batch.sparkSession
    arrived = batch.select(*[c.split()[0] for c in DECISION.split(", ")]).withColumn("bucket", _bucket())
    touched = arrived.select("bucket").distinct()
    held = _latest(spark, store, number).join(F.broadcast(touched), "bucket", "left_semi").select(*arrived.columns)
    last = arrived.unionByName(held).groupBy("bucket", *CASE).agg(F.max_by(F.struct("decision", "note", "seq"), F.struct("seq", F.coalesce("decision", F.lit("")), F.coalesce("note", F.lit("")))).alias("d"))
    out = last.select(*CASE, "d.decision", "d.note", "d.seq", "bucket")
    out.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{store}/cases/version={number}")
    spark.range(1).select(F.lit(number).cast("bigint").alias("version")).write.mode("append").parquet(f"{store}/done")


def keep(spark: SparkSession, path: str, store: str, checkpoint: str) -> None:
    """Merge all decision files (JSON lines) under ``path`` that no earlier run took, and return when it is done."""
    stream = spark.readStream.schema(DECISION).json(path)
    query = stream.writeStream.foreachBatch(lambda df, n: merge(df, n, store)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def reopened(resolved: DataFrame, seq: int) -> DataFrame:
    """Decisions to merge for cases whose accepted candidate is gone: none any more, with the note that says so."""
    gone = F.col("decision").isNotNull() & (F.col("decision") != "skip") & F.col("note").rlike(r"^accepted candidate .* is gone")
    return resolved.filter(gone).select(*CASE, F.lit(None).cast("string").alias("decision"), "note", F.lit(seq).cast("bigint").alias("seq")).dropDuplicates(list(CASE))
