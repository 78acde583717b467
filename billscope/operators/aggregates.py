"""Average bills by day, month and quarter.

Every average keeps the sum of cents and the number of bills it was made from, so it can be rolled up
further without loss. All aggregates combine on the map side, which also levels out keys with very many rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from billscope import schema
from billscope.functions import calendar, money


def partials(bills: DataFrame) -> DataFrame:
    """Bills as sums of one: the input form of the roll-ups below."""
    return bills.withColumn("bill_count", F.col("bill_cents").isNotNull().cast("bigint"))


def roll_up(parts: DataFrame, keys: Sequence[str], average: str) -> DataFrame:
    """Exact average of all bills per group; groups without a readable amount average to NULL."""
    grouped = parts.groupBy(*keys).agg(
        F.sum("bill_cents").alias("bill_cents"), F.sum("bill_count").alias("bill_count")
    )
    return averaged(grouped, average)


def averaged(sums: DataFrame, average: str) -> DataFrame:
    """Sums with their exact average."""
    mean = money.mean_cents(F.col("bill_cents"), F.col("bill_count"))
    return sums.withColumn(average, money.amount(mean))


def daily_average_bill(bills: DataFrame, keys: Sequence[str] = schema.DAILY_KEYS) -> DataFrame:
    """Average bill per condition, hospital, payer, admission type and discharge date."""
    return roll_up(partials(bills), keys, "average_bill_amount")


def monthly_average_bill(parts: DataFrame, keys: Sequence[str] = schema.MONTH_KEYS) -> DataFrame:
    """Average bill per condition, hospital and calendar month, from bills or daily averages."""
    months = with_counts(parts).withColumn("discharge_month", calendar.month_start(F.col("discharge_date")))
    return roll_up(months, keys, "average_bill_amount")


def quarterly_average_bill(
    daily: DataFrame,
    method: str = "mean_of_means",
    with_year: bool = False,
    keys: Sequence[str] = schema.QUARTER_KEYS,
) -> DataFrame:
    """Average bill per condition, hospital, payer and quarter, rounded to cents.

    ``mean_of_means`` averages the daily averages, each with equal weight. ``weighted`` averages the bills
    behind them and also accepts single bills. The same quarter of different years falls together unless
    ``with_year`` adds the year to the key.
    """
    rows = daily
    if "quarter" not in rows.columns:
        rows = rows.withColumn("quarter", calendar.quarter_of(F.col("discharge_date")))
    if with_year:
        rows = rows.withColumn("year", F.year("discharge_date"))
        keys = (*keys, "year")
    if method == "weighted":
        return roll_up(with_counts(rows), keys, "avg_bill_amount")
    if method == "mean_of_means":
        stored = money.cents(F.col("average_bill_amount"))
        means = rows.select(*keys, stored.alias("bill_cents"))
        return roll_up(partials(means), keys, "avg_bill_amount").drop("bill_cents", "bill_count")
    raise ValueError(f"unknown method {method!r}")


def with_counts(rows: DataFrame) -> DataFrame:
    return rows if "bill_count" in rows.columns else partials(rows)


def row_counts(daily: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """Rows before, at and after the daily average in one pass: bills, days, groups by ``keys``."""
    groups = daily.groupBy(*keys).agg(F.sum("bill_count").alias("bills"), F.count(F.lit(1)).alias("days"))
    return groups.agg(
        F.coalesce(F.sum("bills"), F.lit(0)).alias("bills"),
        F.coalesce(F.sum("days"), F.lit(0)).alias("days"),
        F.count(F.lit(1)).alias("groups"),
    )
