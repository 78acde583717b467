"""Run by test_retries: jobs whose tasks fail once each, against the same jobs undisturbed."""

from __future__ import annotations

import json
import sys
from datetime import date

from pyspark import TaskContext
from pyspark.sql import functions as F

from billscope.plans.ingest import ingest
from billscope.plans.segmentation import rebuild_segments
from billscope.session import build_session
from billscope.sources import read_admissions, read_table
from billscope.streaming.increments import fold_batch, read_days


def fails_at_first(value):
    if TaskContext.get().attemptNumber() == 0:
        raise RuntimeError("task lost")
    return value


def bills(spark, disturbed):
    number = F.udf(fails_at_first, "bigint")("id") if disturbed else F.col("id")
    return spark.range(0, 3000, numPartitions=4).select(
        F.concat(F.lit("c"), number % 4).alias("medical_condition"),
        F.concat(F.lit("h"), F.col("id") % 17).alias("hospital"),
        F.concat(F.lit("p"), F.col("id") % 3).alias("insurance_provider"),
        F.lit("Urgent").alias("admission_type"),
        F.date_add(F.lit("2021-01-01").cast("date"), (F.col("id") % 360).cast("int")).alias("discharge_date"),
        (F.col("id") * 37 % 90_000 + 100).alias("bill_cents"),
    )


def run(spark, home, disturbed):
    rows = bills(spark, disturbed)
    loaded = ingest(spark, rows, f"{home}/admission", f"{home}/status", "r1", None)
    segments = rebuild_segments(
        spark, f"{home}/admission", f"{home}/status", f"{home}/segments", "s1", date(2022, 1, 1), k=4
    )
    fold_batch(rows, 0, f"{home}/increments")
    total = lambda df: df.agg(F.sum(F.xxhash64(*sorted(df.columns)).cast("decimal(38,0)"))).first()[0]
    return [
        loaded.loaded,
        loaded.rejected,
        read_admissions(spark, f"{home}/admission").count(),
        segments,
        str(total(read_admissions(spark, f"{home}/admission"))),
        str(total(read_table(spark, f"{home}/segments"))),
        str(total(read_days(spark, f"{home}/increments"))),
    ]


if __name__ == "__main__":
    session = build_session(master="local[4,3]", spark__sql__shuffle__partitions="4")
    session.sparkContext.setLogLevel("OFF")
    print(json.dumps([run(session, f"{sys.argv[1]}/{name}", name == "disturbed") for name in ("calm", "disturbed")]))
