from __future__ import annotations

from datetime import date
from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from billscope import schema
from billscope.functions import calendar, money


def one(spark, **columns):
    return spark.range(1).select(*[column.alias(name) for name, column in columns.items()]).first()


def test_quarter_of_every_month_and_null(spark):
    days = [(date(2021, month, 15),) for month in range(1, 13)] + [(None,)]
    frame = spark.createDataFrame(days, "day date").select(calendar.quarter_of(F.col("day")).alias("q"))
    assert [row.q for row in frame.collect()] == [1, 1, 1, 2, 2, 2, 3, 3, 3, 4, 4, 4, None]


def test_one_month_after_holds_month_end(spark):
    days = {"a": date(2020, 1, 31), "b": date(2019, 5, 8), "c": date(2019, 12, 31)}
    row = one(spark, **{name: calendar.one_month_after(F.lit(day)) for name, day in days.items()})
    assert tuple(row) == (date(2020, 2, 29), date(2019, 6, 8), date(2020, 1, 31))


def test_as_date_reads_text_or_fails(spark):
    assert tuple(one(spark, good=calendar.as_date("2019-05-08"))) == (date(2019, 5, 8),)
    with pytest.raises(ValueError):
        calendar.as_date("2019-13-40")


def test_texts(spark):
    moment = F.lit("2024-01-02 03:04:05.678").cast("timestamp")
    row = one(spark, t=calendar.timestamp_text(moment), d=calendar.date_text(F.lit(date(2024, 1, 2))))
    assert tuple(row) == ("2024-01-02 03:04:05.678", "2024-01-02")
    assert len(one(spark, now=calendar.now_text()).now) >= 19


def test_cents_round_trip(spark):
    amounts = [Decimal("0.00"), Decimal("10.01"), Decimal("-108.52"), Decimal("9999999999.99"), None]
    frame = spark.createDataFrame([(a,) for a in amounts], "a decimal(12,2)")
    back = frame.select(money.amount(money.cents(F.col("a"))).alias("a"))
    assert [row.a for row in back.collect()] == amounts
    assert back.schema["a"].dataType == schema.AMOUNT


def test_cents_of_doubles(spark):
    values = [0.0, 0.29, 104997.88, -1.01, -108.515, 901.82, float("nan"), float("inf"), -1e300, None]
    frame = spark.createDataFrame([(v,) for v in values], "v double")
    got = [row[0] for row in frame.select(money.cents_of_double(F.col("v"))).collect()]
    assert got == [0, 29, 10499788, -101, -10852, 90182, None, None, None, None]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(-(10**15), 10**15), st.integers(1, 10**6)), min_size=1, max_size=200))
def test_mean_cents_is_exact_half_up(spark, pairs):
    frame = spark.createDataFrame(pairs, "total bigint, n bigint")
    means = frame.select("total", "n", money.mean_cents(F.col("total"), F.col("n")).alias("mean")).collect()
    for row in means:
        exact = (Decimal(row.total) / Decimal(row.n)).quantize(Decimal(1), ROUND_HALF_UP)
        assert row.mean == int(exact)


def test_mean_cents_of_nothing_is_null(spark):
    frame = spark.createDataFrame([(None, 0), (5, 2), (-5, 2)], "total bigint, n bigint")
    assert [r[0] for r in frame.select(money.mean_cents(F.col("total"), F.col("n"))).collect()] == [None, 3, -3]


def test_public_names_round_trip(spark):
    frame = spark.createDataFrame([], schema.ENCOUNTER_FILE)
    names = {"Blood Type": "blood_type", "Medical Condition": "medical_condition"}
    internal = schema.to_internal_names(frame)
    assert set(names.values()) <= set(internal.columns)
    assert schema.to_public_names(internal.select(*names.values())).columns == list(names)


def test_text_column_types(spark):
    frame = schema.to_public_names(spark.createDataFrame([], schema.SEGMENT))
    assert schema.text_column_types(frame) == (
        "`Medical Condition` VARCHAR(60), `Hospital` VARCHAR(60), `Insurance Provider` VARCHAR(60), "
        "`Bill Cat` VARCHAR(20)"
    )
