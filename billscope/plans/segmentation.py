"""Segmentation: stored daily averages to labelled quarterly averages."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from billscope import schema, versions
from billscope.operators import aggregates, ledger, lloyd, quality, segment
from billscope.plans import quarters
from billscope.sinks import append_event, lease, open_ledger, replace
from billscope.sources import read_admissions
from billscope.work import job_folder, materialise

STAGE = "segment"


def quarter_averages(admissions: DataFrame, method: str = "mean_of_means", with_year: bool = False) -> DataFrame:
    """Complete rows averaged by quarter, as a work table: every later step starts from it."""
    complete = quality.drop_incomplete(admissions)
    return materialise(aggregates.quarterly_average_bill(complete, method, with_year), "quarter-averages")


def feature_rows(averages: DataFrame) -> DataFrame:
    indexes = segment.string_indexes(averages, ["hospital", "insurance_provider"])
    return segment.feature_columns(averages, *indexes.values())


def cluster(
    averages: DataFrame,
    k: int = schema.SEGMENT_COUNT,
    seed: int = schema.SEGMENT_SEED,
    scale: bool = False,
    solver: str = "rounds",
    partitions: int = segment.FIT_PARTITIONS,
) -> DataFrame:
    """Averages, as a work table, with the number of their KMeans segment.

    ``rounds`` fits by aggregates that don't depend on partitions; ``library`` is the library's fit, whose segments
    change with the number of ``partitions``.
    """
    # Fit, segment means and final rows all start from the features; none repeats the index joins.
    rows = materialise(feature_rows(averages), "features")
    keys = [key for key in (*schema.QUARTER_KEYS, "year") if key in averages.columns]
    if solver == "rounds":
        scored = lloyd.score(lloyd.fit(rows, k, seed, scale, keys), rows)
    elif solver == "library":
        vectors = segment.features(rows)
        scored = segment.score(segment.fit(vectors, k, seed, scale, partitions, keys), vectors)
    else:
        raise ValueError(f"unknown solver {solver!r}")
    # Written once: segment means and final rows both need the number, and a test on it would repeat the distances.
    return materialise(scored.select(*averages.columns, "prediction"), "clustered")


def segment_averages(
    averages: DataFrame,
    k: int = schema.SEGMENT_COUNT,
    seed: int = schema.SEGMENT_SEED,
    scale: bool = False,
    exact: bool = False,
    labels: Sequence[str] = schema.SEGMENT_LABELS,
    probabilities: Sequence[float] = schema.SEGMENT_QUANTILES,
    solver: str = "rounds",
    partitions: int = segment.FIT_PARTITIONS,
    edges: DataFrame | None = None,
) -> DataFrame:
    """Labelled quarterly averages; ``edges`` may come from stored sketches."""
    averages = quality.require_rows(averages, "complete admissions")
    clustered = cluster(averages, k, seed, scale, solver, partitions)
    return segment.categorise(
        clustered, segments=k, exact=exact, labels=labels, probabilities=probabilities, edges=edges
    )


def segment_bills(admissions: DataFrame, method: str = "mean_of_means", with_year: bool = False, **options) -> DataFrame:
    """Labelled quarterly averages from admission rows; ``options`` are those of ``segment_averages``."""
    return segment_averages(quarter_averages(admissions, method, with_year), **options)


def segment_stored(
    spark: SparkSession,
    admissions: str,
    stored: str,
    method: str = "mean_of_means",
    with_year: bool = False,
    exact: bool = False,
    **options,
) -> DataFrame:
    """Labelled quarterly averages of the stored admissions, of which only touched quarters are read.

    Edges come from the quarters' sketches unless they are to be exact.
    """
    quarters.refresh(spark, admissions, stored, method, with_year)
    edges = None if exact else quarters.stored_edges(spark, stored, options.get("probabilities", schema.SEGMENT_QUANTILES))
    return segment_averages(quarters.read_quarters(spark, stored), exact=exact, edges=edges, **options)


def rebuild_segments(
    spark: SparkSession,
    admissions: str | DataFrame,
    ledger_location: str,
    segments: str,
    run_id: str,
    as_of: date,
    only_when_due: bool = False,
    at: datetime | None = None,
    upstream: str = "ingest",
    sink: Mapping | None = None,
    lease_hours: float = lease.HOURS,
    stored: str | None = None,
    **options,
) -> int | None:
    """Replace the segment table and record the run; returns the rows written, None if there was nothing to do.

    Runs only once the latest run of ``upstream`` has finished: ``ingest``, or ``stream`` where ``admissions`` are the
    stream's accepted days. With ``only_when_due`` it also waits for a new quarter. ``admissions`` is the stored
    table, or any frame of accepted rows, of a JDBC scan too; ``sink`` has further arguments of ``sinks.replace``.
    One run at a time, as with loads. ``stored`` is a folder in which the quarterly averages of a stored admission
    table are kept up to date, so that only touched quarters are read.
    """
    if stored and not isinstance(admissions, str):
        raise ValueError("quarters are kept of a stored admission table only")
    past = open_ledger(spark, ledger_location)
    loads = F.col("stage") == upstream
    done = ledger.upstream_done(
        past, loads & (F.col("status") == ledger.FINISHED), loads & (F.col("status") == ledger.STARTED)
    )
    if not done.first().upstream_done:
        return None
    built = past.filter((F.col("stage") == STAGE) & (F.col("status") == ledger.FINISHED))
    if only_when_due and not ledger.needs_rebuild(built, as_of).first().needs_rebuild:
        return None
    try:
        with lease.held(spark, ledger_location, STAGE, run_id, lease_hours) as own:
            return _rebuild(spark, admissions, ledger_location, segments, run_id, as_of, at, sink or {}, own, stored, options)
    except lease.LeaseHeld as error:
        append_event(spark, ledger_location, run_id, 1, STAGE, ledger.REFUSED, str(error), at=at)
        raise


def _rebuild(
    spark: SparkSession,
    admissions: str | DataFrame,
    ledger_location: str,
    segments: str,
    run_id: str,
    as_of: date,
    at: datetime | None,
    sink: Mapping,
    own: lease.Lease,
    stored: str | None,
    options: Mapping,
) -> int:
    record, solver = dict(stage=STAGE, run_id=run_id, at=at), options.get("solver", "rounds")
    if solver == "library":
        solver = f"library in {options.get('partitions', segment.FIT_PARTITIONS)} partitions"
    append_event(spark, ledger_location, sequence=1, status=ledger.STARTED, **record)
    try:
        columns = [field.name for field in schema.SEGMENT.fields]
        if options.get("with_year"):
            columns.append("year")
        with job_folder(spark, STAGE):
            if stored:
                labelled = segment_stored(spark, admissions, stored, **options)
            else:
                accepted = read_admissions(spark, admissions) if isinstance(admissions, str) else admissions
                labelled = segment_bills(accepted, **options)
            rows = replace(labelled.select(*columns), segments, guard=own.check, **sink)
        now = versions.current(spark, segments) if sink.get("kind") != "jdbc" else None
    except Exception as error:
        append_event(
            spark, ledger_location, sequence=2, status=ledger.FAILED, message=f"{type(error).__name__}: {error}", **record
        )
        raise
    append_event(
        spark,
        ledger_location,
        sequence=2,
        status=ledger.FINISHED,
        message=f"{rows} rows, {solver}",
        last_loaded=as_of,
        row_count=rows,
        version=now.number if now else None,
        **record,
    )
    return rows
