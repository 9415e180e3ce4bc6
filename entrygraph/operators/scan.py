"""Running values over guides of any size: a scan over blocks of rows, then one over their summaries.

A window over a guide is one task. Here the rows are dealt, in order, to blocks
of about ROWS; each block sums up what it carries on (how many rows, the last
known value, the first), the few summaries of a guide are scanned by a window,
and what comes in from the blocks before (or behind) meets the rows of its block.
No task holds more than a block, or a guide's summaries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from entrygraph.plans.staging import written

#: Rows of a block, about.
ROWS = 1_000_000
BLOCK = "_block"


def blocks(df: DataFrame, rows: int = ROWS, guide: str = "guide_id", order: str = "seq") -> DataFrame:
    """``df`` with _block: its rows in order of guide and seq, cut into stretches; written once, as cuts are sampled."""
    parts = max(1, -(-df.count() // rows))
    return written(df.repartitionByRange(parts, guide, order).withColumn(BLOCK, F.spark_partition_id()))


def _summaries(df: DataFrame, value: Column, guide: str) -> DataFrame:
    return df.groupBy(guide, BLOCK).agg(value.alias("_sum"))


def _carried(df: DataFrame, summaries: DataFrame, value: Column, out: str, guide: str) -> DataFrame:
    return df.join(summaries.select(guide, BLOCK, value.alias(out)), [guide, BLOCK])


def positions(df: DataFrame, out: str, guide: str = "guide_id", order: str = "seq") -> DataFrame:
    """The number of each row in its guide, from 1."""
    earlier = Window.partitionBy(guide).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    met = _carried(df, _summaries(df, F.count(F.lit(1)), guide), F.coalesce(F.sum("_sum").over(earlier), F.lit(0)), "_offset", guide)
    here = Window.partitionBy(guide, BLOCK).orderBy(order)
    return met.withColumn(out, (F.col("_offset") + F.row_number().over(here)).cast("int")).drop("_offset")


def last_known(df: DataFrame, value: Column, out: str, here: bool = True, guide: str = "guide_id", order: str = "seq") -> DataFrame:
    """The last value before each row (or of it, if ``here``) in its guide that is not null."""
    earlier = Window.partitionBy(guide).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    last = F.max(F.when(value.isNotNull(), F.struct(F.col(order).alias("o"), value.alias("v"))))
    met = _carried(df, _summaries(df, last, guide), F.last("_sum.v", ignorenulls=True).over(earlier), "_carry", guide)
    near = Window.partitionBy(guide, BLOCK).orderBy(order).rowsBetween(Window.unboundedPreceding, 0 if here else -1)
    return met.withColumn(out, F.coalesce(F.last(value, ignorenulls=True).over(near), "_carry")).drop("_carry")


def next_known(df: DataFrame, value: Column, out: str, guide: str = "guide_id", order: str = "seq") -> DataFrame:
    """The first value from each row on in its guide that is not null."""
    later = Window.partitionBy(guide).orderBy(F.desc(BLOCK)).rowsBetween(Window.unboundedPreceding, -1)
    first = F.min(F.when(value.isNotNull(), F.struct(F.col(order).alias("o"), value.alias("v"))))
    met = _carried(df, _summaries(df, first, guide), F.last("_sum.v", ignorenulls=True).over(later), "_carry", guide)
    near = Window.partitionBy(guide, BLOCK).orderBy(F.desc(order)).rowsBetween(Window.unboundedPreceding, 0)
    return met.withColumn(out, F.coalesce(F.last(value, ignorenulls=True).over(near), "_carry")).drop("_carry")
