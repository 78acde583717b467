"""Plans hold when one key has a third of all rows."""

from __future__ import annotations

import os
import subprocess
import sys
from contextlib import contextmanager
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from billscope.operators import aggregates, segment
from billscope.plans import ingest
from billscope.session import shuffle_partitions
from billscope.sinks import write_load
from billscope.sources import read_admissions
from billscope.sources.feeds import bill_rows
from billscope.work import job_folder, materialise, work_dir


@contextmanager
def settings(spark, **values):
    names = {name.replace("__", "."): value for name, value in values.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value) if value is not None else spark.conf.unset(name)


def final_plan(frame):
    frame.write.format("noop").mode("overwrite").save()
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def star(spark):
    """Order tables in which one order, customer and supplier each have a third of the rows."""
    third = lambda key, n: F.when(F.col("id") % 3 == 0, 0).otherwise(F.pmod(F.xxhash64("id", F.lit(key)), F.lit(n)))
    lines = spark.range(240_000).select(
        third("o", 40_000).alias("l_orderkey"),
        third("s", 5_000).alias("l_suppkey"),
        F.lit("A").alias("l_returnflag"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 300).cast("int")).alias("l_shipdate"),
        (F.col("id") % 1000 + 1).cast("double").alias("l_extendedprice"),
    )
    orders = spark.range(40_000).select(
        F.col("id").alias("o_orderkey"), third("c", 9_000).alias("o_custkey"), F.lit("HIGH").alias("o_orderpriority")
    )
    customers = spark.range(9_000).select(
        F.col("id").alias("c_custkey"), F.concat(F.lit("m"), F.col("id") % 5).alias("c_mktsegment")
    )
    suppliers = spark.range(5_000).select(
        F.col("id").alias("s_suppkey"), F.concat(F.lit("s"), F.col("id")).alias("s_name")
    )
    return lines, orders, customers, suppliers


def test_hot_keys_of_a_join_are_split(spark, star):
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="50KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.5",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="50KB",
    ):
        bills = bill_rows(*star)
        daily = aggregates.daily_average_bill(bills)
        plan = final_plan(daily)
        assert plan.count("skew=true") >= 2
        assert daily.agg(F.sum("bill_count")).first()[0] == 240_000
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_orders_are_never_broadcast(star):
    plan = bill_rows(*star)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [l_orderkey" in plan


def test_hot_group_is_combined_before_the_shuffle(spark, star):
    frame = aggregates.monthly_average_bill(bill_rows(*star))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum(bill_cents" in plan and "Sort Aggregate" not in plan and "SortAggregate" not in plan


def test_hot_month_is_written_by_several_tasks(spark, star, folder):
    rows = ingest.admission_rows(bill_rows(*star), None).withColumn("discharge_date", F.lit("2020-05-05").cast("date"))
    with settings(spark, spark__sql__adaptive__advisoryPartitionSizeInBytes="100KB"):
        counts = write_load(rows, f"{folder}/t", "start")
    table = read_admissions(spark, f"{folder}/t")
    assert counts["loaded"] == table.count() and len(table.inputFiles()) > 1


def test_labels_enter_without_a_cross_join(spark):
    rows = spark.range(1000).select(
        (F.col("id") % 7).cast("int").alias("prediction"), F.col("id").cast("decimal(12,2)").alias("avg_bill_amount")
    )
    for exact in (True, False):
        plan = segment.categorise(rows, segments=7, exact=exact)._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan and "Subquery" in plan


def test_shuffle_partitions_follow_the_input():
    tera = 1024**4
    assert [shuffle_partitions(size, 200) for size in (0, tera, 10 * tera, 100 * tera)] == [200, 2048, 20480, 100_000]


def test_work_tables_of_a_job_are_deleted(spark):
    with job_folder(spark, "job"):
        inside = materialise(spark.range(5), "five")
        path = inside.inputFiles()[0]
        assert inside.count() == 5 and "/job-" in path and Path(path.removeprefix("file:")).exists()
    assert not Path(path.removeprefix("file:")).exists()
    outside = materialise(spark.range(5), "five")
    assert "/job-" not in outside.inputFiles()[0]


def test_local_session_without_a_work_folder(folder):
    """A session of its own, as the setting cannot be taken back."""
    script = (
        "from billscope.session import build_session; from billscope.work import checkpoint, materialise, work_dir\n"
        "spark = build_session(master='local[2]')\n"
        "assert not spark.conf.get('spark.checkpoint.dir', None)\n"
        "assert checkpoint(spark.range(3)).count() == materialise(spark.range(3), 'three').count() == 3\n"
        "print('work in', work_dir(spark))"
    )
    environment = {**os.environ, "SPARK_CONF_DIR": folder, "PYTHONPATH": str(Path(__file__).resolve().parents[1])}
    done = subprocess.run([sys.executable, "-c", script], env=environment, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr[-2000:]
    assert not Path(done.stdout.split("work in ")[1].strip()).exists()


def test_work_folder_is_the_one_the_session_names(spark):
    assert work_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
