"""Running sums within groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from billscope.work import materialise


def running_within(df: DataFrame, group: str, order_by: Sequence[str | Column], weights: dict[str, Column]) -> DataFrame:
    """Add running sums of ``weights`` within each group, in an order that tells its rows apart.

    Rows are dealt out in ranges, so a group may be larger than a task. Each range starts from what its first group
    has in the ranges before, which is known of groups that lie in several ranges only: fewer than twice the ranges.
    """
    kept = df.columns
    ranged = df.withColumns({f"_{name}": weight for name, weight in weights.items()})
    ranged = ranged.repartitionByRange(group, *order_by).withColumn("_range", F.spark_partition_id())
    ranged = materialise(ranged, "ranges")
    own = ranged.groupBy(group, "_range").agg(*[F.sum(f"_{name}").alias(f"_{name}") for name in weights])
    own = materialise(own, "range-sums")
    spread = own.groupBy(group).agg(F.min("_range").alias("a"), F.max("_range").alias("b")).where("a < b").select(group)
    before = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = own.join(spread, group, "left_semi")
    carried = carried.select(group, "_range", *[F.sum(f"_{name}").over(before).alias(f"_before_{name}") for name in weights])
    within = Window.partitionBy(group, "_range").orderBy(*order_by).rowsBetween(Window.unboundedPreceding, 0)
    summed = ranged.withColumns({name: F.sum(f"_{name}").over(within) for name in weights})
    summed = summed.join(F.broadcast(carried), [group, "_range"], "left")
    totals = [(F.col(name) + F.coalesce(f"_before_{name}", F.lit(0))).alias(name) for name in weights]
    return summed.select(*kept, *totals)
