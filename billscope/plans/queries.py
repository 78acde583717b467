"""Every operator as a query over the order tables.

Amounts leave as doubles and dates as text, so results compare bit by bit with other engines.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from billscope import schema
from billscope.functions import calendar, money
from billscope.operators import aggregates, incremental, ledger, lloyd, quality, reports, segment
from billscope.plans import ingest, quarters, segmentation
from billscope.plans.report import publish_reports
from billscope.sinks import append, create_if_missing, publish, read_published, replace
from billscope.sources import (
    billing_columns,
    ledger_from_events,
    order_encounters,
    read_admissions,
    read_encounters,
    read_quarantine,
    read_table,
)
from billscope.sources.feeds import LINE_COLUMNS, order_bills
from billscope.streaming import increments
from billscope.work import materialise, new_path

LAST_LOADED = date(1996, 5, 8)
EARLIER_CUT = date(1998, 1, 1)
AS_OF = date(2024, 7, 1)
FILES_PER_BATCH = 1_000
#: How large files of lines are written: packed, and of bounded length, as one task reads a packed file.
PACKED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": "1000000"}
THREE_LABELS, THREE_QUANTILES = ("Low", "Medium", "High"), (0.33, 0.66)


def _shown(df: DataFrame) -> DataFrame:
    """Amounts as doubles, dates as text."""
    dates = {f.name: calendar.date_text(F.col(f.name)) for f in df.schema.fields if f.dataType.typeName() == "date"}
    return reports.decimals_to_double(df.withColumns(dates))


def _daily(spark: SparkSession, folder: str) -> DataFrame:
    return aggregates.daily_average_bill(order_bills(spark, folder))


def _mean_of_means(spark: SparkSession, folder: str) -> DataFrame:
    daily = _daily(spark, folder).withColumn("quarter", calendar.quarter_of(F.col("discharge_date")))
    return aggregates.quarterly_average_bill(quality.drop_incomplete(daily))


def _weighted(spark: SparkSession, folder: str, with_year: bool = False) -> DataFrame:
    return aggregates.quarterly_average_bill(order_bills(spark, folder), "weighted", with_year)


def _ten_thousands(averages: DataFrame) -> DataFrame:
    """A segment number that any engine can compute."""
    return averages.withColumn("prediction", F.floor(F.col(segment.AMOUNT) / 10_000).cast("int"))


def _segmented(spark: SparkSession, folder: str) -> DataFrame:
    return _ten_thousands(materialise(_mean_of_means(spark, folder), "mean-of-means"))


def scan_encounters(spark, folder):
    return _shown(order_bills(spark, folder))


def scan_encounters_csv(spark, folder):
    path = new_path(spark, "encounters")
    order_encounters(spark, folder).write.option("header", True).csv(path)
    return _shown(billing_columns(read_encounters(spark, path)))


def quarter_column(spark, folder):
    day = F.col("discharge_date")
    return _shown(order_bills(spark, folder).select("discharge_date", calendar.quarter_of(day).alias("quarter")))


def complete_rows(spark, folder):
    """Bills of which one in eleven has no hospital and one in thirteen no amount, by the amount's cents."""
    cents = F.col("bill_cents")
    bills = order_bills(spark, folder).withColumns(
        {"hospital": F.when(cents % 11 != 0, F.col("hospital")), "bill_cents": F.when(cents % 13 != 0, cents)}
    )
    rows = bills.withColumn("quarter", calendar.quarter_of(F.col("discharge_date")))
    columns = ["medical_condition", "hospital", "bill_cents", "insurance_provider", "quarter"]
    return _shown(quality.drop_incomplete(rows, columns))


def daily_average_bill(spark, folder):
    return _shown(_daily(spark, folder))


def monthly_average_bill(spark, folder):
    return _shown(aggregates.monthly_average_bill(order_bills(spark, folder)))


def quarterly_weighted(spark, folder):
    return _shown(_weighted(spark, folder))


def quarterly_weighted_by_year(spark, folder):
    return _shown(_weighted(spark, folder, with_year=True))


def quarterly_mean_of_means(spark, folder):
    return _shown(_mean_of_means(spark, folder))


def top_averages(spark, folder):
    return _shown(reports.top_averages(_weighted(spark, folder).drop("bill_cents", "bill_count")))


def incremental_slice(spark, folder):
    return _shown(incremental.slice_new(order_bills(spark, folder), LAST_LOADED, "step"))


def incremental_slice_after(spark, folder):
    return _shown(incremental.slice_new(order_bills(spark, folder), LAST_LOADED, "after"))


def incremental_slice_stored(spark, folder):
    """New rows of the stored table; folders of earlier months aren't opened."""
    home = new_path(spark, "slice-stored")
    ingest.ingest(spark, order_bills(spark, folder), f"{home}/admission", f"{home}/status", "load", None)
    stored = read_admissions(spark, f"{home}/admission")
    rows = incremental.slice_new(stored, LAST_LOADED, month_partition="discharge_month")
    return _shown(rows.drop("load_from", "discharge_month"))


def incremental_late(spark, folder):
    return _shown(incremental.late_rows(order_bills(spark, folder), LAST_LOADED, "step"))


def ledger_last_loaded(spark, folder):
    return _shown(ledger.last_loaded(ledger_from_events(spark, folder)))


def ledger_latest(spark, folder):
    return reports.runs(ledger.latest(ledger_from_events(spark, folder)))


def ledger_latest_event(spark, folder):
    return reports.runs(ledger.latest_event(ledger_from_events(spark, folder)))


def ledger_until_now(spark, folder):
    """Events per stage up to now, the times compared as the texts that reports show."""
    events = ledger_from_events(spark, folder)
    past = events.filter(calendar.timestamp_text(F.col("event_time")) <= calendar.now_text())
    return past.groupBy("stage").agg(F.count(F.lit(1)).alias("events"))


def ledger_stages(spark, folder):
    return ledger.stages(ledger_from_events(spark, folder))


def ledger_event_is(spark, folder):
    return ledger.event_is(ledger_from_events(spark, folder), 2, F.col("stage") == "view")


def ledger_upstream_done(spark, folder):
    stage = F.col("stage")
    return ledger.upstream_done(ledger_from_events(spark, folder), stage == "purchase", stage == "signup")


def ledger_needs_rebuild(spark, folder):
    return ledger.needs_rebuild(ledger_from_events(spark, folder), AS_OF)


def load_valid_rows(spark, folder):
    return _shown(quality.split_valid(_daily(spark, folder))[0])


def load_appended(spark, folder):
    """Valid rows after a bulk append, read back from the table."""
    rows, path = quality.split_valid(_daily(spark, folder))[0], new_path(spark, "appended")
    append(rows, path, sort_by="discharge_date")
    return _shown(read_table(spark, path, columns=rows.schema))


def load_quarantine(spark, folder):
    return _shown(quality.split_valid(_daily(spark, folder))[1])


def load_counts(spark, folder):
    return quality.load_counts(quality.check_rows(_daily(spark, folder)))


def stage_row_counts(spark, folder):
    daily = _daily(spark, folder).withColumn("quarter", calendar.quarter_of(F.col("discharge_date")))
    return aggregates.row_counts(daily, schema.QUARTER_KEYS)


def string_index(spark, folder):
    averages = materialise(_mean_of_means(spark, folder), "mean-of-means")
    return segment.string_index(averages, "hospital")


def feature_columns(spark, folder):
    averages = materialise(_mean_of_means(spark, folder), "mean-of-means")
    return _shown(segmentation.feature_rows(averages))


def quantile_edges_exact(spark, folder):
    edges = segment.quantile_edges(_mean_of_means(spark, folder), exact=True)
    probabilities = F.array(*[F.lit(p) for p in schema.SEGMENT_QUANTILES])
    pairs = edges.select(F.explode(F.arrays_zip(probabilities.alias("probability"), F.col("edges").alias("edge"))))
    return _shown(pairs.select("col.probability", "col.edge"))


def quantile_edges_approx(spark, folder):
    edges = segment.quantile_edges(_mean_of_means(spark, folder))
    probabilities = F.array(*[F.lit(p) for p in schema.SEGMENT_QUANTILES])
    pairs = edges.select(F.explode(F.arrays_zip(probabilities.alias("probability"), F.col("edges").alias("edge"))))
    return _shown(pairs.select("col.probability", "col.edge"))


def segment_profile(spark, folder):
    return segment.profile(_ten_thousands(_mean_of_means(spark, folder)))


def segments_labelled(spark, folder):
    return _shown(segment.categorise(_segmented(spark, folder), exact=True))


def segments_replaced(spark, folder):
    """Labelled segments after replacing an earlier table, read back."""
    path, labelled = new_path(spark, "segments"), segment.categorise(_segmented(spark, folder), exact=True)
    create_if_missing(spark, path, schema.SEGMENT)
    replace(labelled.select(*schema.SEGMENT.names), path)
    return _shown(read_table(spark, path, columns=schema.SEGMENT))


def segments_three_labels(spark, folder):
    rows = _segmented(spark, folder)
    return _shown(
        segment.categorise(rows, exact=True, labels=THREE_LABELS, probabilities=THREE_QUANTILES)
    )


def label_counts(spark, folder):
    rows = _segmented(spark, folder)
    edges = segment.quantile_edges(rows, exact=True)
    return segment.label_counts(segment.label_segments(segment.profile(rows), edges))


def segments_kmeans(spark, folder):
    averages = materialise(_mean_of_means(spark, folder), "mean-of-means")
    return _shown(segmentation.cluster(averages))


def kmeans_nearest(spark, folder):
    """Rows scored, and rows whose segment isn't that of their nearest centre."""
    averages = materialise(_mean_of_means(spark, folder), "mean-of-means")
    rows = materialise(segmentation.feature_rows(averages), "features")
    found = lloyd.fit(rows)
    scored = lloyd.score(found, rows)

    def distance(center):
        return sum((F.col(name) - value) * (F.col(name) - value) for name, value in zip(lloyd.FEATURES, center, strict=True))

    distances = F.array(*[distance(center) for center in found.centers()])
    own = F.element_at(distances, F.col("prediction") + 1)
    far = F.count_if(own > F.array_min(distances) * (1 + 1e-9) + 1e-9)
    return scored.agg(F.count("*").alias("rows_scored"), far.alias("rows_not_nearest"))


def kmeans_any_partitions(spark, folder):
    """Rows scored, and rows whose segment is another when the table lies in 3 or in 17 parts."""
    averages = materialise(_mean_of_means(spark, folder), "mean-of-means")
    rows, found = materialise(segmentation.feature_rows(averages), "features"), []
    for parts in (3, 17):
        placed = materialise(rows.repartition(parts), "placed")
        scored = lloyd.score(lloyd.fit(placed), placed)
        found.append(scored.select(*schema.QUARTER_KEYS, F.col("prediction").alias(f"in_{parts}")))
    both = found[0].join(found[1], list(schema.QUARTER_KEYS))
    return both.agg(F.count("*").alias("rows_scored"), F.count_if(F.col("in_3") != F.col("in_17")).alias("rows_differing"))


def quantile_rank_error(spark, folder):
    """Whether each approximate edge lies within one hundredth of its rank."""
    rows = materialise(_mean_of_means(spark, folder), "mean-of-means")
    return _rank_errors(rows, segment.quantile_edges(rows))


def quantile_rank_error_stored(spark, folder):
    """The same of edges that come from the stored quarters' sketches alone."""
    home = _two_loads(spark, folder, "sketches")
    quarters.refresh(spark, f"{home}/admission", f"{home}/quarters")
    return _rank_errors(quarters.read_quarters(spark, f"{home}/quarters"), quarters.stored_edges(spark, f"{home}/quarters"))


def _rank_errors(rows: DataFrame, found: DataFrame) -> DataFrame:
    edges = found.select("edges").scalar()
    amount, columns = F.col(segment.AMOUNT), []
    for number, probability in enumerate(schema.SEGMENT_QUANTILES):
        below, up_to = (F.count_if(test) / F.count(amount) for test in (amount < edges[number], amount <= edges[number]))
        near = (below - 0.01 <= probability) & (up_to + 0.01 >= probability)
        columns.append(F.struct(F.lit(probability).alias("probability"), near.alias("within")))
    return rows.agg(F.array(*columns).alias("pairs")).select(F.explode("pairs").alias("pair")).select("pair.*")


def segments_table(spark, folder):
    """The stored segments' keys and averages, and whether a label stands there."""
    return segments_flow(spark, folder).withColumn("labelled", F.col("bill_cat").isNotNull()).drop("bill_cat")


def ledger_stored(spark, folder):
    """Questions to a stored ledger after one load."""
    home = new_path(spark, "ledger")
    ingest.ingest(spark, order_bills(spark, folder), f"{home}/admission", f"{home}/status", "7", None)
    past = read_table(spark, f"{home}/status", columns=schema.LEDGER)
    answer = ledger.event_is(past, "7-0002", F.col("status") == ledger.FINISHED)
    return _shown(answer.crossJoin(ledger.last_loaded(past)))


def incremental_slice_text(spark, folder):
    return _shown(incremental.slice_new(order_bills(spark, folder), LAST_LOADED.isoformat(), "after"))


def segments_flow(spark, folder):
    """Bills through the stored tables: load, segment, read back."""
    home = new_path(spark, "segments-flow")
    table, runs, segments = (f"{home}/{name}" for name in ("admission", "status", "segments"))
    ingest.ingest(spark, order_bills(spark, folder), table, runs, "load", None)
    segmentation.rebuild_segments(spark, table, runs, segments, "segment", AS_OF)
    return _shown(read_table(spark, segments, columns=schema.SEGMENT))


def report_admissions(spark, folder):
    daily = _daily(spark, folder)
    return reports.admissions(daily.withColumn("quarter", calendar.quarter_of(F.col("discharge_date"))))


def report_published(spark, folder):
    """The admissions report as other tools read it: a headed file."""
    report, path = report_admissions(spark, folder), new_path(spark, "report")
    publish(report, path)
    return read_published(spark, path, report.schema)


def report_segments(spark, folder):
    return reports.segments(segment.categorise(_segmented(spark, folder), exact=True))


def report_runs(spark, folder):
    return reports.runs(ledger_from_events(spark, folder))


def ingest_load(spark, folder):
    """The rows one load accepts."""
    rows = ingest.admission_rows(order_bills(spark, folder), LAST_LOADED, "step")
    return _shown(rows.filter(F.col("reject_reason").isNull()).drop("reject_reason"))


def ingest_table(spark, folder):
    """The stored table after a first load of the earlier bills and a second load of what is new since."""
    home = _two_loads(spark, folder, "ingest")
    return _shown(read_admissions(spark, f"{home}/admission").drop("load_from", "discharge_month"))


def _two_loads(spark: SparkSession, folder: str, name: str, between: Callable[[str], None] = lambda home: None) -> str:
    home = new_path(spark, name)
    table, runs, bills = f"{home}/admission", f"{home}/status", order_bills(spark, folder)
    ingest.ingest(spark, bills.filter(F.col("discharge_date") <= EARLIER_CUT), table, runs, "first", None)
    between(home)
    ingest.ingest(spark, bills, table, runs, "second")
    return home


def quarters_refreshed(spark, folder):
    """Quarterly averages made after a first load and brought up to date after a second."""

    def refresh(home):
        quarters.refresh(spark, f"{home}/admission", f"{home}/quarters")

    home = _two_loads(spark, folder, "quarters", refresh)
    refresh(home)
    return _shown(quarters.read_quarters(spark, f"{home}/quarters"))


def segments_stored(spark, folder):
    """Keys and averages of segments rebuilt from stored quarters and their sketches, and whether a label stands there."""
    home = _two_loads(spark, folder, "segments-stored")
    places = [f"{home}/{name}" for name in ("admission", "status", "segments")]
    segmentation.rebuild_segments(spark, *places, "segment", AS_OF, stored=f"{home}/quarters")
    rows = _shown(read_table(spark, places[2], columns=schema.SEGMENT))
    return rows.withColumn("labelled", F.col("bill_cat").isNotNull()).drop("bill_cat")


def guarded_rows(spark, folder):
    """Daily averages past the guard that stops a step on empty input."""
    return _shown(quality.require_rows(_daily(spark, folder), "daily averages"))


def ingest_rejects(spark, folder):
    """The quarantine after a load in which fixed shares of the bills break each rule, by the amount's cents."""
    cents = F.col("bill_cents")
    hospital = F.when(cents % 101 == 0, None).when(cents % 103 == 0, F.repeat(F.lit("h"), 61))
    day = F.when(cents % 109 == 0, None).when(cents % 113 == 0, F.lit(date(9999, 12, 31)))
    bills = order_bills(spark, folder).withColumns(
        {
            "hospital": hospital.otherwise(F.col("hospital")),
            "discharge_date": day.otherwise(F.col("discharge_date")),
            "bill_cents": F.when(cents % 107 != 0, cents),
        }
    )
    home = new_path(spark, "rejects")
    ingest.ingest(spark, bills, f"{home}/admission", f"{home}/status", "load", None)
    rows = read_quarantine(spark, f"{home}/admission")
    return _shown(rows.drop("load_from", "discharge_month", schema.RAW_LINE))


def ingest_unreadable(spark, folder):
    """Lines in the quarantine after two loads of files whose amounts and dates are unreadable in fixed shares.

    The files of the second load aren't those of the first, so lines without a date must outlast the load.
    """
    home, amount, day = new_path(spark, "unreadable"), F.col("Billing Amount"), F.col("Discharge Date")
    cents, lines = money.cents(amount), order_encounters(spark, folder)
    texts = {
        "Billing Amount": F.when(cents % 101 == 0, "none").otherwise(amount.cast("string")),
        "Discharge Date": F.when(cents % 103 == 0, "2019-13-40").otherwise(day.cast("string")),
    }
    for run, test in (("1", day <= EARLIER_CUT), ("2", day > EARLIER_CUT)):
        lines.filter(test).withColumns(texts).write.options(header=True, **PACKED).csv(f"{home}/{run}")
        bills = billing_columns(read_encounters(spark, f"{home}/{run}", keep_corrupt=True))
        ingest.ingest(spark, bills, f"{home}/admission", f"{home}/status", run, None)
    rows = read_quarantine(spark, f"{home}/admission").filter(F.col("reject_reason") == "unreadable")
    return _shown(rows.select(*schema.DAILY_KEYS, "bill_count", schema.RAW_LINE))


def stream_segments(spark, folder):
    """Keys and averages of segments built from a stream's daily averages, once its ledger event is there."""
    home = new_path(spark, "stream-segments")
    _stream(spark, folder, f"{home}/increments", f"{home}/status")
    days = increments.read_accepted(spark, f"{home}/increments")
    segmentation.rebuild_segments(
        spark, days, f"{home}/status", f"{home}/segments", "segment", AS_OF, upstream=increments.STAGE
    )
    rows = _shown(read_table(spark, f"{home}/segments", columns=schema.SEGMENT))
    return rows.withColumn("labelled", F.col("bill_cat").isNotNull()).drop("bill_cat")


def report_tables(spark, folder):
    """Rows of the published reports, after a load and a segmentation of it."""
    home = new_path(spark, "reports")
    places = [f"{home}/{name}" for name in ("admission", "segments", "status")]
    ingest.ingest(spark, order_bills(spark, folder), places[0], places[2], "load", None)
    segmentation.rebuild_segments(spark, places[0], places[2], places[1], "segment", AS_OF)
    publish_reports(spark, *places, f"{home}/out", "parquet")
    counts = None
    for name in ("segments", "admissions", "runs"):
        rows = read_published(spark, f"{home}/out/{name}", kind="parquet").agg(F.lit(name).alias("report"), F.count("*").alias("rows"))
        counts = rows if counts is None else counts.unionByName(rows)
    return counts


def incremental_stream(spark, folder):
    """Daily averages folded in from a run-once stream of order lines."""
    home = new_path(spark, "increments")
    _stream(spark, folder, home)
    return _shown(increments.read_days(spark, home).drop("discharge_month"))


def _stream(spark: SparkSession, folder: str, home: str, ledger_location: str | None = None) -> None:
    lines = spark.read.parquet(f"{folder}/lineitem.parquet").schema
    # A pattern, since a stream takes no path to a single file; it also matches a folder of files.
    arrived = spark.readStream.schema(lines).option("maxFilesPerTrigger", FILES_PER_BATCH)
    arrived = arrived.parquet(f"{folder}/lineitem.parquet*")
    increments.run_available(
        arrived.select(*LINE_COLUMNS),
        home,
        f"{home}/checkpoint",
        lambda batch: order_bills(batch.sparkSession, folder, batch),
        ledger_location,
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        scan_encounters,
        scan_encounters_csv,
        quarter_column,
        complete_rows,
        daily_average_bill,
        monthly_average_bill,
        quarterly_weighted,
        quarterly_weighted_by_year,
        quarterly_mean_of_means,
        top_averages,
        incremental_slice,
        incremental_slice_after,
        incremental_slice_stored,
        incremental_late,
        ledger_last_loaded,
        ledger_latest,
        ledger_latest_event,
        ledger_stages,
        ledger_until_now,
        ledger_event_is,
        ledger_upstream_done,
        ledger_needs_rebuild,
        load_valid_rows,
        load_appended,
        load_quarantine,
        load_counts,
        stage_row_counts,
        guarded_rows,
        string_index,
        feature_columns,
        quantile_edges_exact,
        quantile_edges_approx,
        segment_profile,
        segments_labelled,
        segments_replaced,
        segments_three_labels,
        label_counts,
        segments_kmeans,
        kmeans_nearest,
        kmeans_any_partitions,
        quantile_rank_error,
        quantile_rank_error_stored,
        segments_flow,
        segments_table,
        ledger_stored,
        incremental_slice_text,
        report_admissions,
        report_published,
        report_segments,
        report_runs,
        ingest_load,
        ingest_table,
        quarters_refreshed,
        segments_stored,
        ingest_rejects,
        ingest_unreadable,
        stream_segments,
        report_tables,
        incremental_stream,
    )
}
