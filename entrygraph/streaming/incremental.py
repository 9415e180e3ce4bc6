"""Incremental runs: units that arrive as files are worked on once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def run_available(spark: SparkSession, path: str, schema: str, work: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Give all files under ``path`` that no earlier run took to ``work``, and return when it is done.

    The checkpoint remembers files, so a run that is repeated, or begun again
    after a failure, does a unit once; ``work`` gets the batch's number to
    overwrite what a failed attempt may have left.
    """
    stream = spark.readStream.schema(schema).json(path)
    query = stream.writeStream.foreachBatch(work).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
