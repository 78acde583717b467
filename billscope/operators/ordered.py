"""Totals along a global order, without sending all rows through one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from billscope.work import materialise


def running_total(
    df: DataFrame, order_by: Sequence[Column], weight: Column, name: str, grand_total: str | None = None
) -> DataFrame:
    """Add the running total of ``weight`` in the order ``order_by``, which must tell all rows apart.

    ``grand_total`` names a column for the total over all rows, if that is wanted too.

    Rows are range-partitioned, each range adds up its own rows and starts from the total of the ranges
    before it. The ranges are written down once, so both steps see the same ones. The range totals are one
    row per range, never more than the number of shuffle partitions.
    """
    ranges = df.withColumn("_weight", weight).repartitionByRange(*order_by)
    ranges = materialise(ranges.withColumn("_range", F.spark_partition_id()), "ranges")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    starts = (
        ranges.groupBy("_range")
        .agg(F.sum("_weight").alias("_sum"))
        .select(
            "_range",
            F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"),
            F.sum("_sum").over(everything).alias(grand_total or "_total"),
        )
    )
    within = Window.partitionBy("_range").orderBy(*order_by).rowsBetween(Window.unboundedPreceding, 0)
    return (
        ranges.withColumn(name, F.sum("_weight").over(within))
        .join(F.broadcast(starts), "_range")
        .withColumn(name, F.col(name) + F.col("_start"))
        .drop("_range", "_weight", "_start", "_total")
    )
