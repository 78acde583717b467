"""Mergeable quantile sketches of amounts: small binaries that are stored and added up instead of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billscope import schema
from billscope.functions import money

#: Size of a sketch; rank errors stay well below one hundredth.
ACCURACY = 1000


def quantile_sketches(rows: DataFrame, column: str, by: Sequence[str] = (), accuracy: int = ACCURACY) -> DataFrame:
    """One row per group with the sketch of a decimal column's cents and the number of amounts in it."""
    known = rows.filter(F.col(column).isNotNull())
    sketch = F.kll_sketch_agg_bigint(money.cents(F.col(column)), accuracy).alias("sketch")
    return known.groupBy(*by).agg(sketch, F.count(F.lit(1)).alias("amounts"))


def merged_edges(
    sketches: DataFrame, probabilities: Sequence[float] = schema.SEGMENT_QUANTILES, accuracy: int = ACCURACY
) -> DataFrame:
    """Quantiles of all amounts behind the sketches as one row with an array ``edges``; NULL without any amount."""
    merged = sketches.agg(F.kll_merge_agg_bigint("sketch", accuracy).alias("sketch"), F.sum("amounts").alias("amounts"))
    cents = F.kll_sketch_get_quantile_bigint("sketch", F.array(*[F.lit(float(p)) for p in probabilities]))
    edges = F.transform(cents, lambda value: money.amount(value))
    return merged.select(F.when(F.col("amounts") > 0, edges).alias("edges"))
