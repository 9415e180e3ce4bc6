"""Written intermediate tables in the shared folder, which cut the lineage and are read by several results."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; a temporary one is set only in local mode and where none is configured."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        where = "file://" + tempfile.mkdtemp(prefix="entrygraph-checkpoint-")
        spark.conf.set("spark.checkpoint.dir", where)
    return where


def dealt(df: DataFrame, *by: str) -> DataFrame:
    """Rows dealt by these columns to as many tasks as run at once: few bytes would else go to a task or two, however costly a row is."""
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism, *by)


def written(df: DataFrame) -> DataFrame:
    """``df``, written as Parquet and read again."""
    path = f"{shared_dir(df.sparkSession)}/staged-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
