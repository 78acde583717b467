from __future__ import annotations

import math
import random
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from billscope import schema
from billscope.operators import aggregates, incremental, ledger, lookup, quality, reports, segment
from billscope.operators.ordered import running_total
from billscope.work import materialise

BILLS = (
    "medical_condition string, hospital string, insurance_provider string, admission_type string, "
    "discharge_date date, bill_cents bigint"
)


def bills(spark, rows):
    return spark.createDataFrame(rows, BILLS)


def bill(cents, day=date(2020, 1, 2), hospital="North", condition="Flu", payer="Acme", kind="Urgent"):
    return (condition, hospital, payer, kind, day, cents)


# Averages


def test_daily_average_skips_nulls_and_rounds_half_up(spark):
    rows = [bill(1000), bill(1001), bill(None), bill(None, hospital="South"), bill(-1, hospital="West"), bill(0, hospital="West")]
    daily = {r.hospital: r for r in aggregates.daily_average_bill(bills(spark, rows)).collect()}
    assert (daily["North"].average_bill_amount, daily["North"].bill_count) == (Decimal("10.01"), 2)
    assert (daily["South"].average_bill_amount, daily["South"].bill_count) == (None, 0)
    assert daily["West"].average_bill_amount == Decimal("-0.01")


def test_mean_of_means_and_weighted_differ(spark):
    rows = [bill(100)] + [bill(400, day=date(2020, 2, 1))] * 3
    daily = aggregates.daily_average_bill(bills(spark, rows))
    means = aggregates.quarterly_average_bill(daily).first()
    weighted = aggregates.quarterly_average_bill(daily, "weighted").first()
    assert means.avg_bill_amount == Decimal("2.50")
    assert (weighted.avg_bill_amount, weighted.bill_count) == (Decimal("3.25"), 4)
    with pytest.raises(ValueError):
        aggregates.quarterly_average_bill(daily, "median")


def test_same_quarter_of_two_years(spark):
    rows = [bill(100, day=date(2020, 1, 1)), bill(300, day=date(2021, 2, 1))]
    daily = aggregates.daily_average_bill(bills(spark, rows))
    assert aggregates.quarterly_average_bill(daily).first().avg_bill_amount == Decimal("2.00")
    apart = aggregates.quarterly_average_bill(daily, with_year=True).collect()
    assert {(r.year, r.avg_bill_amount) for r in apart} == {(2020, Decimal("1.00")), (2021, Decimal("3.00"))}


def test_monthly_average_is_the_same_from_bills_and_from_days(spark):
    rng = random.Random(1)
    rows = [bill(rng.randrange(10**6), day=date(2020, 1 + rng.randrange(3), 1 + rng.randrange(20))) for _ in range(300)]
    direct = aggregates.monthly_average_bill(bills(spark, rows))
    rolled = aggregates.monthly_average_bill(aggregates.daily_average_bill(bills(spark, rows)))
    assert sorted(direct.collect()) == sorted(rolled.collect())
    assert direct.count() == 3


@settings(max_examples=4, deadline=None)
@given(st.lists(st.tuples(st.integers(-(10**9), 10**9), st.integers(0, 3)), min_size=1, max_size=60))
def test_weighted_average_does_not_depend_on_batches(spark, parts):
    whole = bills(spark, [bill(cents) for cents, _ in parts])
    expected = aggregates.quarterly_average_bill(aggregates.daily_average_bill(whole), "weighted").collect()
    batches = {n: bills(spark, [bill(cents) for cents, batch in parts if batch == n]) for _, n in parts}
    sums = None
    for batch in batches.values():
        daily = aggregates.daily_average_bill(batch)
        sums = daily if sums is None else sums.unionByName(daily)
    assert aggregates.quarterly_average_bill(sums, "weighted").collect() == expected


def test_row_counts(spark):
    rows = [bill(1), bill(2), bill(3, day=date(2020, 1, 3)), bill(4, hospital="South")]
    daily = aggregates.daily_average_bill(bills(spark, rows)).withColumn("quarter", F.quarter("discharge_date"))
    assert tuple(aggregates.row_counts(daily, schema.QUARTER_KEYS).first()) == (4, 3, 2)
    assert tuple(aggregates.row_counts(daily.limit(0), schema.QUARTER_KEYS).first()) == (0, 0, 0)


# Quality


def checked(spark):
    fields = "id int, " + BILLS.replace("bill_cents bigint", "average_bill_amount decimal(12,2)")
    day, long = date(2020, 1, 1), "x" * 61
    rows = [
        (1, "Flu", "O'Neil, a", "Acme", "Urgent", day, Decimal("99999.99")),
        (2, "Flu", None, "Acme", "Urgent", None, None),
        (3, "Flu", long, "Acme", "Urgent", day, None),
        (4, "Flu", "North", "Acme", "Urgent", day, None),
        (5, "Flu", "North", "Acme", "Urgent", None, Decimal("100000.00")),
        (6, "Flu", "North", "Acme", "Urgent", day, Decimal("-100000.00")),
        (7, "Flu", "North", "Acme", "Urgent", None, Decimal("1.00")),
        (8, "Flu", "x" * 60, "Acme", "Urgent", day, Decimal("-99999.99")),
    ]
    return spark.createDataFrame(rows, fields)


def test_reject_reasons_in_order(spark):
    frame = checked(spark)
    valid, rejected = quality.split_valid(frame)
    assert {r.id for r in valid.collect()} == {1, 8}
    assert {r.id: r.reject_reason for r in rejected.collect()} == {
        2: "null_key",
        3: "too_long",
        4: "amount_null",
        5: "amount_range",
        6: "amount_range",
        7: "date_null",
    }
    together = valid.unionByName(rejected.drop("reject_reason"))
    assert together.exceptAll(frame).isEmpty() and frame.exceptAll(together).isEmpty()
    assert tuple(quality.load_counts(quality.check_rows(frame)).first()) == (8, 2, 6)


def test_drop_incomplete(spark):
    frame = checked(spark).withColumn("quarter", F.quarter("discharge_date"))
    assert {r.id for r in quality.drop_incomplete(frame).collect()} == {1, 6, 8}


def test_require_rows(spark):
    frame = checked(spark)
    assert quality.require_rows(frame) is frame
    with pytest.raises(quality.NoRowsError, match="admissions"):
        quality.require_rows(frame.limit(0), "admissions")


def test_observed_counts_equal_counts(spark):
    frame, seen = quality.observe_counts(checked(spark), "checked", undated=F.count_if(F.col("discharge_date").isNull()))
    frame.write.format("noop").mode("overwrite").save()
    assert seen.get == {"rows": 8, "undated": 3}


# Increments


def test_slice_boundaries(spark):
    rows = [bill(1, day=d) for d in (date(2019, 5, 8), date(2019, 5, 9), date(2019, 6, 7), date(2019, 6, 8), None)]
    frame = bills(spark, rows)
    days = lambda df: sorted(str(r.discharge_date) for r in df.collect())
    assert days(incremental.slice_new(frame, "2019-05-08", "step")) == ["2019-06-08"]
    assert days(incremental.slice_new(frame, date(2019, 5, 8))) == ["2019-05-09", "2019-06-07", "2019-06-08"]
    assert len(days(incremental.slice_new(frame, date(2019, 5, 8), keep_undated=True))) == 4
    assert days(incremental.slice_new(frame, date(2020, 1, 31), "step")) == []
    assert len(days(incremental.slice_new(frame, None))) == 4
    with pytest.raises(ValueError):
        incremental.slice_new(frame, "2019-05-08", "before")


@settings(max_examples=4, deadline=None)
@given(st.dates(date(2019, 1, 1), date(2021, 12, 31)), st.sampled_from(["step", "after"]))
def test_slice_and_late_rows_are_the_whole(spark, last, boundary):
    frame = bills(spark, [bill(n, day=date(2019 + n % 3, 1 + n % 12, 1 + n % 28)) for n in range(100)])
    parts = incremental.slice_new(frame, last, boundary).unionByName(incremental.late_rows(frame, last, boundary))
    assert sorted(parts.collect()) == sorted(frame.collect())


def test_slice_prunes_month_partitions(spark, folder):
    frame = bills(spark, [bill(n, day=date(2020, 1 + n % 12, 5)) for n in range(24)])
    table = f"{folder}/bills"
    frame.withColumn("discharge_month", F.trunc("discharge_date", "month")).write.partitionBy("discharge_month").parquet(table)
    new = incremental.slice_new(spark.read.parquet(table), date(2020, 10, 20), month_partition="discharge_month")
    assert {r.discharge_date.month for r in new.collect()} == {11, 12}
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(discharge_month" in plan and "PushedFilters: [IsNotNull(discharge_date)" in plan
    assert len(new.inputFiles()) <= len(spark.read.parquet(table).inputFiles())


# Ledger


def events(spark, rows):
    return spark.createDataFrame(rows, "id string, stage string, status string, event_time timestamp, last_loaded date")


NOON = datetime(2024, 5, 1, 12)


def test_ledger_answers(spark):
    frame = events(
        spark,
        [
            ("a-1", "ingest", "started", NOON, None),
            ("a-2", "ingest", "finished", NOON, date(2024, 3, 1)),
            ("b-1", "segment", "started", NOON.replace(hour=13), None),
        ],
    )
    assert ledger.last_loaded(frame).first().last_loaded == date(2024, 3, 1)
    assert {r.stage: r.id for r in ledger.latest(frame).collect()} == {"ingest": "a-2", "segment": "b-1"}
    assert ledger.latest_event(frame).first().id == "b-1"
    assert {r.stage for r in ledger.stages(frame).collect()} == {"ingest", "segment"}
    is_started = lambda event: ledger.event_is(frame, event, F.col("status") == "started").first()[0]
    assert [is_started(event) for event in ("a-1", "a-2", "z-9")] == [True, False, False]
    finished, started = F.col("status") == "finished", F.col("status") == "started"
    ingest = F.col("stage") == "ingest"
    done = lambda df: ledger.upstream_done(df, ingest & finished, ingest & started).first()[0]
    assert done(frame) is True
    again = frame.unionByName(events(spark, [("c-1", "ingest", "started", NOON.replace(hour=14), None)]))
    assert done(again) is False
    rebuild = lambda day: ledger.needs_rebuild(frame, day).first()[0]
    assert [rebuild(d) for d in ("2024-03-31", "2024-04-01", "2023-03-01")] == [False, True, True]


def test_empty_ledger(spark):
    empty = events(spark, [])
    assert ledger.last_loaded(empty).first().last_loaded == incremental.DEFAULT_START
    assert ledger.last_loaded(empty, default=None).first().last_loaded is None
    assert ledger.upstream_done(empty, F.lit(True), F.lit(True)).first()[0] is False
    assert ledger.needs_rebuild(empty, "2024-01-01").first()[0] is True
    assert ledger.latest(empty).isEmpty()


# Global order


@settings(max_examples=3, deadline=None)
@given(st.dictionaries(st.integers(-1000, 1000), st.integers(0, 50), min_size=1, max_size=300))
def test_running_total(spark, weights):
    frame = spark.createDataFrame(list(weights.items()), "value int, n int")
    rows = running_total(frame, [F.asc("value")], F.col("n"), "total", "all").collect()
    expected, total = {}, 0
    for value in sorted(weights):
        total += weights[value]
        expected[value] = total
    assert {r.value: r.total for r in rows} == expected
    assert {r["all"] for r in rows} == {total}
    assert rows[0].__fields__ == ["value", "n", "total", "all"]


def test_running_total_over_many_ranges(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        frame = spark.range(5000).withColumn("key", F.xxhash64("id"))
        rows = running_total(frame, [F.desc("key")], F.lit(1), "place")
        assert rows.agg(F.countDistinct("place"), F.max("place")).first() == (5000, 5000)
        ordered = [r.key for r in rows.orderBy("place").collect()]
        assert ordered == sorted(ordered, reverse=True)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


# Lookup


@pytest.mark.parametrize("broadcast_rows", [10_000, 0])
def test_attach_keeps_every_row_of_a_hot_key(spark, broadcast_rows):
    keys = ["hot"] * 2000 + [f"k{n}" for n in range(3000)] + ["unknown", None]
    rows = spark.createDataFrame([(key, n) for n, key in enumerate(keys)], "key string, n int")
    counts = Counter(key for key in keys if key not in ("unknown", None))
    table = spark.createDataFrame([(k, c, float(len(k))) for k, c in counts.items()], "key string, frequency bigint, v double")
    frame = lookup.attach(rows, table, "key", "frequency", broadcast_rows)
    assert ("SortMergeJoin" in frame._jdf.queryExecution().executedPlan().toString()) == (broadcast_rows == 0)
    joined = frame.collect()
    expected = {(n, None if key in ("unknown", None) else float(len(key))) for n, key in enumerate(keys)}
    assert {(r.n, r.v) for r in joined} == expected and len(joined) == len(keys)


# Segments


def averages(spark, count=600, seed=3):
    rng = random.Random(seed)
    rows = {}
    while len(rows) < count:
        key = (f"c{rng.randrange(8)}", f"h{rng.randrange(40)}", f"p{rng.randrange(4)}", 1 + rng.randrange(4))
        rows[key] = Decimal(rng.randrange(100, 9_999_999)) / 100
    fields = "medical_condition string, hospital string, insurance_provider string, quarter int, avg_bill_amount decimal(12,2)"
    return spark.createDataFrame([(*k, v) for k, v in rows.items()], fields)


def test_string_index_by_falling_frequency_then_label(spark):
    labels = ["b"] * 3 + ["a"] * 3 + ["d"] * 5 + ["c"] + [None] * 9
    frame = spark.createDataFrame([(label,) for label in labels], "hospital string")
    index = {r.hospital: (r.frequency, r.label_index) for r in segment.string_index(frame, "hospital").collect()}
    assert index == {"d": (5, 0.0), "a": (3, 1.0), "b": (3, 2.0), "c": (1, 3.0)}


def test_string_index_equals_the_library_one(spark):
    from pyspark.ml.feature import StringIndexer

    frame = averages(spark)
    model = StringIndexer(inputCol="hospital", outputCol="i").fit(frame)
    ours = segment.string_index(frame, "hospital").orderBy("label_index").collect()
    assert [r.hospital for r in ours] == list(model.labels)


@pytest.mark.parametrize("probabilities", [(0.2, 0.4, 0.6, 0.8), (0.0, 0.5, 1.0), (0.33, 0.66)])
def test_exact_quantiles(spark, probabilities):
    frame = averages(spark, 501)
    values = sorted(r.avg_bill_amount for r in frame.collect())
    edges = segment.quantile_edges(frame, probabilities, exact=True).first().edges
    assert edges == [values[max(0, math.ceil(round(p * 501, 9)) - 1)] for p in probabilities]


def test_exact_quantiles_of_one_hot_value(spark):
    values = [(Decimal("5.00"),)] * 90 + [(Decimal(n),) for n in range(10, 20)]
    frame = spark.createDataFrame(values, "avg_bill_amount decimal(12,2)")
    assert segment.quantile_edges(frame, exact=True).first().edges == [Decimal("5.00")] * 4


def test_approximate_quantiles_stay_within_rank_error(spark):
    frame = averages(spark, 1000)
    values = sorted(r.avg_bill_amount for r in frame.collect())
    for p, edge in zip(schema.SEGMENT_QUANTILES, segment.quantile_edges(frame).first().edges):
        assert abs(values.index(edge) + 1 - p * 1000) <= 0.01 * 1000 + 1


def test_labels_are_half_open_and_null_has_none(spark):
    values = [(0.5,), (1.0,), (1.5,), (2.0,), (None,)]
    edges = F.array(F.lit(1.0), F.lit(2.0))
    label = segment.label_by_edges(F.col("v"), edges, ("Low", "Medium", "High"))
    rows = spark.createDataFrame(values, "v double").select(label.alias("l")).collect()
    assert [r.l for r in rows] == ["Low", "Medium", "Medium", "High", None]


def test_categorise_equals_brute_force(spark):
    frame = averages(spark).withColumn("prediction", F.col("quarter"))
    rows = materialise(frame, "rows").collect()
    values = sorted(r.avg_bill_amount for r in rows)
    edges = [values[math.ceil(round(p * len(values), 9)) - 1] for p in schema.SEGMENT_QUANTILES]
    means = {
        q: sum(r.avg_bill_amount for r in rows if r.quarter == q) / sum(r.quarter == q for r in rows) for q in range(1, 5)
    }
    label = {q: schema.SEGMENT_LABELS[sum(mean >= edge for edge in edges)] for q, mean in means.items()}
    for bounded in (None, 4):
        got = segment.categorise(frame, segments=bounded, exact=True).collect()
        assert len(got) == len(rows) and all(r.bill_cat == label[r.quarter] for r in got)
        assert "prediction" not in got[0].__fields__
    with pytest.raises(ValueError):
        segment.categorise(frame, labels=("a", "b"))


def test_segment_without_amounts_has_no_label(spark):
    frame = spark.createDataFrame(
        [(1, Decimal("1.00")), (1, Decimal("3.00")), (2, None)], "prediction int, avg_bill_amount decimal(12,2)"
    )
    profiles = segment.profile(frame)
    assert {tuple(r) for r in profiles.collect()} == {(1, 2.0, 2), (2, None, 1)}
    labelled = segment.label_segments(profiles, segment.quantile_edges(frame, exact=True))
    assert {r.prediction: r.bill_cat for r in labelled.collect()}[2] is None
    # Edges of 1.00 and 3.00 are 1, 1, 3 and 3, so a mean of 2 is Moderate.
    assert {tuple(r) for r in segment.label_counts(labelled).collect()} == {("Moderate", 1), (None, 1)}


# Reports


def test_decimals_to_double_and_preview(spark):
    frame = averages(spark, 50)
    shown = reports.decimals_to_double(frame)
    assert shown.schema["avg_bill_amount"].dataType.typeName() == "double"
    top = reports.top_averages(frame, 5).collect()
    expected = sorted((r.avg_bill_amount for r in frame.collect()), reverse=True)[:5]
    assert [r.avg_bill_amount for r in top] == expected
