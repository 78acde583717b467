"""The append-only run ledger."""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from billscope import schema
from billscope.sinks.tables import create_if_missing


def open_ledger(spark: SparkSession, location: str) -> DataFrame:
    return create_if_missing(spark, location, schema.LEDGER)


def append_event(
    spark: SparkSession,
    location: str,
    run_id: str,
    sequence: int,
    stage: str,
    status: str,
    message: str = "",
    last_loaded: date | None = None,
    row_count: int | None = None,
    at: datetime | None = None,
    version: int | None = None,
    event_id: str | None = None,
) -> None:
    """Record one event; write it only after the data it speaks of is committed."""
    at = at or datetime.now(timezone.utc)
    event = {
        "id": event_id or f"{run_id}-{sequence:04d}",
        "stage": stage,
        "status": status,
        "message": message,
        "event_time": at,
        "last_loaded": last_loaded,
        "row_count": row_count,
        "version": version,
    }
    columns = [F.lit(event[field.name]).cast(field.dataType).alias(field.name) for field in schema.LEDGER.fields]
    spark.range(1, numPartitions=1).select(*columns).write.mode("append").parquet(location)
