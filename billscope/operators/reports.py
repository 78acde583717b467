"""Frames for people: public names, dates as text, amounts as plain numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from billscope import schema
from billscope.functions import calendar


def decimals_to_double(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {f.name: F.col(f.name).cast("double") for f in df.schema.fields if isinstance(f.dataType, T.DecimalType)}
    )


def admissions(table: DataFrame) -> DataFrame:
    kept = table.select(
        "medical_condition",
        "hospital",
        "insurance_provider",
        "quarter",
        calendar.date_text(F.col("discharge_date")).alias("discharge_date"),
        "average_bill_amount",
    )
    return schema.to_public_names(decimals_to_double(kept))


def segments(table: DataFrame) -> DataFrame:
    kept = table.select(*[field.name for field in schema.SEGMENT.fields])
    return schema.to_public_names(decimals_to_double(kept))


def runs(ledger: DataFrame) -> DataFrame:
    texts = {
        "event_time": calendar.timestamp_text(F.col("event_time")),
        "last_loaded": calendar.date_text(F.col("last_loaded")),
    }
    return ledger.drop("version").withColumns(texts)


def preview(df: DataFrame, order_by: Sequence[Column], n: int = 10) -> DataFrame:
    """First ``n`` rows of a total order, kept as a top-n per task."""
    return df.orderBy(*order_by).limit(n)


def top_averages(averages: DataFrame, n: int = 10, keys: Sequence[str] = schema.QUARTER_KEYS) -> DataFrame:
    """Highest average bills."""
    return preview(averages, [F.desc("avg_bill_amount"), *[F.asc(key) for key in keys]], n)
