"""Ingest: bills to daily averages, new days only, checked and stored."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from billscope import schema
from billscope.functions import calendar
from billscope.operators import aggregates, incremental, ledger, quality
from billscope.sinks import append_event, lease, open_ledger, write_load

STAGE = "ingest"


@dataclass(frozen=True)
class Loaded:
    load_from: str
    loaded: int
    rejected: int
    unreadable: int
    last_loaded: date | None
    version: int
    late: int | None = None


def _with_lines(parts: DataFrame) -> DataFrame:
    """Every bill, and each unreadable line once more as a row of its own, counted as one without an amount."""
    text = F.col(schema.RAW_LINE)
    twice = F.when(text.isNull(), F.array(F.lit(False))).otherwise(F.array(F.lit(False), F.lit(True)))
    parts = parts.withColumn("is_line", F.explode(twice))
    line = F.col("is_line")
    return parts.withColumns(
        {
            schema.RAW_LINE: F.when(line, text),
            "bill_cents": F.when(~line, F.col("bill_cents")),
            "bill_count": F.when(line, F.lit(1).cast("bigint")).otherwise(F.col("bill_count")),
        }
    ).drop("is_line")


def _checked(bills: DataFrame, as_of: Column | None = None) -> DataFrame:
    """Daily averages with their reject reason and, in the same pass, the unreadable lines of ``bills``."""
    parts, keys, reason = aggregates.partials(bills), schema.DAILY_KEYS, quality.reject_reason(as_of=as_of)
    if schema.RAW_LINE in bills.columns:
        parts, keys = _with_lines(parts), (*keys, schema.RAW_LINE)
        reason = F.when(F.col(schema.RAW_LINE).isNotNull(), "unreadable").otherwise(reason)
    daily = aggregates.roll_up(parts, keys, "average_bill_amount")
    daily = daily.withColumn("quarter", calendar.quarter_of(F.col("discharge_date")))
    return quality.check_rows(daily, reason)


def admission_rows(bills: DataFrame, last_loaded: date | str | None, boundary: str = "after") -> DataFrame:
    """New daily averages with quarter and reject reason.

    The slice comes first, on the bills: the date is a grouping key, so no average changes, and fewer rows
    are shuffled.
    """
    return _checked(incremental.slice_new(bills, last_loaded, boundary, keep_undated=True))


def ingest(
    spark: SparkSession,
    bills: DataFrame,
    admissions: str,
    ledger_location: str,
    run_id: str,
    default_start: date | None = incremental.DEFAULT_START,
    boundary: str = "after",
    at: datetime | None = None,
    count_late: bool = True,
    as_of: date | None = None,
    lease_hours: float = lease.HOURS,
) -> Loaded:
    """Load what is new and record the run.

    Bills dated before the load's first day are left out; ``count_late`` counts them into the closing event,
    which reads the source's older rows once more. Without a loaded date in the ledger everything is loaded
    afresh, and the table that stands there gives way only to a finished load that isn't empty. The closing event
    follows the data, so a run that broke off is repeated from the same date and replaces what it had written.

    Bills without a date, or dated after ``as_of`` (today), are rejected and never move the loaded date. As
    later loads meet them again, they are kept once, in the load ``open``.

    Bills with a column ``raw_line`` (``read_encounters(keep_corrupt=True)``) bring their unreadable lines into the
    quarantine; the cells of such a line that could be read are loaded all the same.

    One run at a time: a second one is refused while the first holds the lease, for ``lease_hours`` at most.
    """
    open_ledger(spark, ledger_location)
    try:
        with lease.held(spark, ledger_location, STAGE, run_id, lease_hours) as own:
            return _ingest(spark, bills, admissions, ledger_location, run_id, default_start, boundary, at, count_late, as_of, own)
    except lease.LeaseHeld as error:
        append_event(spark, ledger_location, run_id, 1, STAGE, ledger.REFUSED, str(error), at=at)
        raise


def _ingest(
    spark: SparkSession,
    bills: DataFrame,
    admissions: str,
    ledger_location: str,
    run_id: str,
    default_start: date | None,
    boundary: str,
    at: datetime | None,
    count_late: bool,
    as_of: date | None,
    own: lease.Lease,
) -> Loaded:
    record = dict(stage=STAGE, run_id=run_id, at=at)
    past = open_ledger(spark, ledger_location).filter(F.col("stage") == STAGE)
    previous = ledger.last_loaded(past, default=None).first().last_loaded
    start = default_start if previous is None else previous
    today = F.current_date() if as_of is None else F.lit(as_of)
    append_event(spark, ledger_location, sequence=1, status=ledger.STARTED, **record)
    try:
        load_from = "start" if start is None else str(start)
        new = incremental.slice_new(bills, start, boundary, keep_undated=True)
        placed = F.col("discharge_date") <= today
        counts = write_load(_checked(new, today), admissions, load_from, placed, previous is None, own.check)
        late = None
        if count_late:
            late = 0 if start is None else incremental.late_rows(bills, start, boundary).count()
    except Exception as error:
        append_event(
            spark,
            ledger_location,
            sequence=2,
            status=ledger.FAILED,
            message=f"{type(error).__name__}: {error}",
            **record,
        )
        raise
    told = f"{counts['loaded']} loaded, {counts['rejected']} rejected"
    if counts["unreadable"]:
        told += f", {counts['unreadable']} lines unreadable"
    told += f", {spark.conf.get('spark.sql.shuffle.partitions')} shuffle partitions"
    append_event(
        spark,
        ledger_location,
        sequence=2,
        status=ledger.FINISHED,
        message=told if late is None else f"{told}, {late} late",
        last_loaded=counts["last_loaded"],
        row_count=counts["loaded"],
        version=counts["version"],
        **record,
    )
    return Loaded(load_from, **counts, late=late)
