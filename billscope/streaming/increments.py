"""Run-once increments: fold newly arrived files into sums by day, then stop.

Sums are kept as runs by month. A batch writes its own sums and takes in the month's latest runs as long as they are of
its size, by powers of two, so a bill is written again as often as its run doubles: n batches write n log n, however
they are ordered, and a month has few runs. Reading adds the runs up.
"""

from __future__ import annotations

from collections.abc import Callable
import uuid
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from billscope import schema, versions
from billscope.functions import calendar
from billscope.operators import aggregates, ledger, quality
from billscope.sinks import append_event, lease, open_ledger
from billscope.work import delete

STAGE = "stream"
MONTH = "discharge_month"
_KEY_FIELDS = [schema.ADMISSION[key] for key in schema.DAILY_KEYS]
PARTIALS = T.StructType(
    [
        *_KEY_FIELDS,
        T.StructField("bill_cents", T.LongType()),
        T.StructField("bill_count", T.LongType()),
        T.StructField(MONTH, T.DateType()),
    ]
)
DAYS = T.StructType([*schema.ADMISSION.fields, T.StructField(MONTH, T.DateType())])


def fold_batch(bills: DataFrame, batch: int, location: str, as_of: date | None = None) -> date | None:
    """Add one batch of bills to the sums at ``location``; returns the last day of it that is accepted by itself.

    Only the batch is aggregated from bills, and only runs of like size are written again. The pointer of the batch's
    number names the runs, so a repeated batch starts from the pointer before it and replaces itself. A late bill
    reaches its month; one dated after ``as_of`` (today) belongs to none and is rejected.
    """
    spark = bills.sparkSession
    today = F.current_date() if as_of is None else F.lit(as_of)
    month = F.when(F.col("discharge_date") <= today, calendar.month_start(F.col("discharge_date")))
    before, folder = versions.current(spark, location, below=batch), versions.new_folder()
    standing = before.folders if before else []
    rows = dict(before.notes["rows"]) if before else {}

    def stored(paths: list[str]) -> DataFrame:
        return versions.read(spark, location, PARTIALS, pointer=versions.Pointer(batch, paths))

    _write(aggregates.partials(bills).withColumn(MONTH, month), f"{location}/{folder}")
    now = versions.subfolders(spark, location, folder)
    if not now:
        delete(spark, f"{location}/{folder}")
        return None
    # The batch's sums are one row a key already, so they need no further grouping.
    accepted = F.when(F.col("reject_reason").isNull(), F.col("discharge_date"))
    days = _checked_days(aggregates.averaged(stored(now), "average_bill_amount"))
    months = days.groupBy(MONTH).agg(F.count(F.lit(1)).alias("rows"), F.max(accepted).alias("last")).collect()
    rows |= {f"{folder}/{_folder(found[MONTH])}": found["rows"] for found in months}
    taken = [path for found in months for path in _of_like_size(found[MONTH], found["rows"], standing, rows)]
    if taken:
        joined, named = versions.new_folder(), {path.split("/")[1] for path in taken}
        again = [path for path in now if path.split("/")[1] in named]
        _write(stored([*again, *taken]), f"{location}/{joined}")
        for path in again:
            delete(spark, f"{location}/{path}")
        merged = versions.subfolders(spark, location, joined)
        rows |= {f"{joined}/{_folder(found[MONTH])}": found["count"] for found in stored(merged).groupBy(MONTH).count().collect()}
        now = [*[path for path in now if path not in again], *merged]
    folders = [*[path for path in standing if path not in taken], *now]
    versions.commit(spark, location, folders, before, batch, rows={path: rows[path] for path in folders})
    return max((found["last"] for found in months if found["last"]), default=None)


def _of_like_size(month: date | None, size: int, standing: list[str], rows: dict[str, int]) -> list[str]:
    """The month's latest runs that are no larger, by powers of two, than the batch and the runs taken before them."""
    taken = []
    for path in reversed([path for path in standing if path.endswith(f"/{_folder(month)}")]):
        if rows[path].bit_length() > size.bit_length():
            break
        taken.append(path)
        size += rows[path]
    return taken


def _write(parts: DataFrame, location: str) -> None:
    """Write the sums of ``parts`` by month."""
    sums = [F.sum(name).alias(name) for name in ("bill_cents", "bill_count")]
    sums = parts.groupBy(*schema.DAILY_KEYS, MONTH).agg(*sums).select(*PARTIALS.names)
    sums.hint("rebalance", MONTH).write.partitionBy(MONTH).parquet(location)


def _folder(month: date | None) -> str:
    return f"{MONTH}={month or '__HIVE_DEFAULT_PARTITION__'}"


def day_rows(sums: DataFrame) -> DataFrame:
    """Daily averages, checked, from the sums of any number of batches; a date without a month lies in the future."""
    return _checked_days(aggregates.roll_up(sums, (*schema.DAILY_KEYS, MONTH), "average_bill_amount"))


def _checked_days(days: DataFrame) -> DataFrame:
    days = days.withColumn("quarter", calendar.quarter_of(F.col("discharge_date")))
    beyond = F.when(F.col("discharge_date").isNotNull() & F.col(MONTH).isNull(), "date_range")
    days = quality.check_rows(days, F.coalesce(quality.reject_reason(), beyond))
    return days.select(*[field.name for field in DAYS.fields])


def run_available(
    arrivals: DataFrame,
    location: str,
    checkpoint: str,
    to_bills: Callable[[DataFrame], DataFrame] | None = None,
    ledger_location: str | None = None,
    run_id: str | None = None,
    at: datetime | None = None,
    as_of: date | None = None,
    lease_hours: float = lease.HOURS,
) -> None:
    """Fold in what has arrived since the last run, and record the run where there is a ledger.

    ``arrivals`` is a stream of bills, or of rows that ``to_bills`` turns into bills. The checkpoint
    remembers which files are done; it takes the place of the last loaded date, so late bills count. Files
    per batch are bounded by the source's ``maxFilesPerTrigger`` or ``maxBytesPerTrigger``.

    Each batch leaves one event, under its number, before it counts as done: a run that dies keeps what it loaded, and
    the next closing event speaks for the batches that no closing event covers. One run at a time, as with loads.

    A stream's own plan runs without adaptive execution. Joins therefore belong into ``to_bills``, which runs
    per batch with it, so that a hot key is split.
    """
    spark, run_id = arrivals.sparkSession, run_id or uuid.uuid4().hex
    options = dict(checkpoint=checkpoint, to_bills=to_bills, as_of=as_of)
    if not ledger_location:
        _fold_arrivals(arrivals, location, lambda number, last: None, lambda: None, **options)
        return
    open_ledger(spark, ledger_location)
    try:
        with lease.held(spark, ledger_location, STAGE, run_id, lease_hours) as own:
            _recorded(arrivals, location, ledger_location, run_id, at, own, options)
    except lease.LeaseHeld as error:
        append_event(spark, ledger_location, run_id, 1, STAGE, ledger.REFUSED, str(error), at=at)
        raise


def _recorded(
    arrivals: DataFrame, location: str, ledger_location: str, run_id: str, at: datetime | None, own: lease.Lease, options: dict
) -> None:
    spark = arrivals.sparkSession

    def record(sequence: int, status: str, **told) -> None:
        append_event(spark, ledger_location, run_id, sequence, STAGE, status, at=at, **told)

    def batch_done(number: int, last: date | None) -> None:
        name = f"{STAGE}-batch-{number:010d}"
        known = open_ledger(spark, ledger_location)
        if not ledger.event_is(known, name, F.col("status") == ledger.BATCH).first().event_is:
            record(0, ledger.BATCH, message=f"batch {number}", last_loaded=last, version=number, event_id=name)

    record(1, ledger.STARTED)
    try:
        days = _fold_arrivals(arrivals, location, batch_done, own.check, **options)
    except Exception as error:
        record(2, ledger.FAILED, message=f"{type(error).__name__}: {error}")
        raise
    past = open_ledger(spark, ledger_location).filter(F.col("stage") == STAGE)
    left = ledger.uncovered(past).first()
    last = max((day for day in (*days.values(), left.last_loaded) if day), default=None)
    record(2, ledger.FINISHED, message=f"{len(days)} batches", last_loaded=last, version=left.version)


def _fold_arrivals(
    arrivals: DataFrame,
    location: str,
    done: Callable[[int, date | None], None],
    check: Callable[[], None],
    checkpoint: str,
    to_bills: Callable[[DataFrame], DataFrame] | None,
    as_of: date | None,
) -> dict[int, date | None]:
    """Run the stream's batches; returns the last accepted day of each."""
    days: dict[int, date | None] = {}

    def fold(batch: DataFrame, number: int) -> None:
        batch.sparkSession.conf.set("spark.sql.adaptive.enabled", "true")  # the stream's own session
        check()
        days[number] = fold_batch(to_bills(batch) if to_bills else batch, number, location, as_of)
        done(number, days[number])

    query = (
        arrivals.writeStream.foreachBatch(fold)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return days


def read_days(spark: SparkSession, location: str) -> DataFrame:
    """Daily averages with their reject reason: the runs of each month added up."""
    pointer = versions.current(spark, location)
    if pointer is None:
        return spark.createDataFrame([], DAYS)
    return day_rows(versions.read(spark, location, PARTIALS, pointer=pointer))


def read_accepted(spark: SparkSession, location: str) -> DataFrame:
    """Accepted daily averages of a stream, in the columns of the stored admissions."""
    return read_days(spark, location).filter(F.col("reject_reason").isNull()).drop("reject_reason")
