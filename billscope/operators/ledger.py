"""Questions to the run ledger. Each answer is a one-row frame or one row per stage."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from billscope.functions import calendar
from billscope.operators.incremental import DEFAULT_START

STARTED, FINISHED, FAILED, REFUSED, BATCH = "started", "finished", "failed", "refused", "batch"


def _when(test: Column | None = None) -> Column:
    """Moment of an event; equal times are told apart by id."""
    moment = F.struct("event_time", "id")
    return moment if test is None else F.when(test, moment)


def last_loaded(ledger: DataFrame, default: date | str | None = DEFAULT_START) -> DataFrame:
    """Highest date loaded so far, or the default."""
    highest = F.max("last_loaded")
    if default is not None:
        highest = F.coalesce(highest, calendar.as_date(default))
    return ledger.agg(highest.alias("last_loaded"))


def uncovered(ledger: DataFrame) -> DataFrame:
    """Highest date and number among a stream's batches that no closing event covers; the number of all else."""
    closed = ledger.filter(F.col("status") == FINISHED).agg(F.max("version").alias("closed")).scalar()
    left = (F.col("status") == BATCH) & (F.col("version") > F.coalesce(F.col("closed"), F.lit(-1)))
    return ledger.withColumn("closed", closed).agg(
        F.max(F.when(left, F.col("last_loaded"))).alias("last_loaded"), F.max("version").alias("version")
    )


def latest(ledger: DataFrame) -> DataFrame:
    """Latest event of every stage; keeps one row per stage and task while it aggregates."""
    others = [name for name in ledger.columns if name != "stage"]
    row = F.max_by(F.struct(*others), _when()).alias("event")
    return ledger.groupBy("stage").agg(row).select("stage", "event.*")


def latest_event(ledger: DataFrame) -> DataFrame:
    """Latest event of all, kept as a top-1."""
    return ledger.orderBy(F.desc("event_time"), F.desc("id")).limit(1)


def stages(ledger: DataFrame) -> DataFrame:
    """Stages that have recorded anything."""
    return ledger.select("stage").distinct()


def event_is(ledger: DataFrame, event_id: int | str, test: Column) -> DataFrame:
    """Whether the event with this id passes ``test``; no such event means no."""
    found = F.count_if(test) > 0
    return ledger.filter(F.col("id").cast("string") == str(event_id)).agg(found.alias("event_is"))


def upstream_done(ledger: DataFrame, done: Column, begun: Column) -> DataFrame:
    """Whether the latest ``done`` event is later than the latest ``begun`` event; no event means no."""
    last_done, last_begun = F.max(_when(done)), F.max(_when(begun))
    answer = F.coalesce(last_done > last_begun, last_done.isNotNull() & last_begun.isNull())
    return ledger.agg(answer.alias("upstream_done"))


def needs_rebuild(ledger: DataFrame, as_of: date | str | Column) -> DataFrame:
    """Whether ``as_of`` lies in another quarter than the last recorded date, or there is none."""
    now, last = calendar.as_date(as_of), F.max("last_loaded")
    same = (F.year(now) == F.year(last)) & (calendar.quarter_of(now) == calendar.quarter_of(last))
    return ledger.agg((~F.coalesce(same, F.lit(False))).alias("needs_rebuild"))
