"""Run one job: ``python -m billscope ingest|stream|segment|report --home FOLDER``.

``home`` holds the stored tables: ``admission``, ``status``, ``quarters``, ``segments``, ``reports`` and, for streams,
``increments``. Every job runs once and ends; a scheduler may repeat it as it likes.
"""

from __future__ import annotations

import argparse
import json
import uuid
from collections.abc import Sequence
from dataclasses import asdict
from datetime import date

from pyspark.sql import SparkSession

from billscope import schema
from billscope.operators.incremental import DEFAULT_START
from billscope.operators.segment import FIT_PARTITIONS
from billscope.plans.ingest import ingest
from billscope.plans.report import publish_reports
from billscope.plans.segmentation import rebuild_segments
from billscope.session import build_session, shuffle_partitions
from billscope.sinks.lease import HOURS
from billscope.sources import billing_columns, read_encounters, stream_encounters
from billscope.streaming.increments import read_accepted, run_available
from billscope.work import file_system


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="billscope")
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name)
        sub.add_argument("--home", required=True, help="folder of the stored tables")
        return sub

    for name in ("ingest", "stream"):
        sub = job(name)
        sub.add_argument("--encounters", required=True, help="encounter files")
        sub.add_argument("--run-id", default=uuid.uuid4().hex)
        if name == "ingest":
            sub.add_argument("--start", type=date.fromisoformat, default=DEFAULT_START, help="first load: days after")
            sub.add_argument("--boundary", choices=("after", "step"), default="after")
            sub.add_argument("--drop-unreadable", action="store_true", help="don't keep lines with unreadable cells")
            sub.add_argument("--no-late-count", action="store_true", help="don't count bills that came too late")
        sub.add_argument("--cores", type=int, default=200, help="cores of the cluster")
        sub.add_argument("--lease-hours", type=float, default=HOURS, help="for which a run that died blocks others")
    sub = job("segment")
    sub.add_argument("--lease-hours", type=float, default=HOURS, help="for which a run that died blocks others")
    sub.add_argument("--run-id", default=uuid.uuid4().hex)
    sub.add_argument("--as-of", type=date.fromisoformat, default=date.today())
    sub.add_argument("--only-when-due", action="store_true", help="do nothing within the same quarter")
    sub.add_argument("--method", choices=("mean_of_means", "weighted"), default="mean_of_means")
    sub.add_argument("--k", type=int, default=schema.SEGMENT_COUNT, help="number of segments")
    sub.add_argument("--seed", type=int, default=schema.SEGMENT_SEED)
    sub.add_argument("--solver", choices=("rounds", "library"), default="rounds", help="of the fit")
    sub.add_argument("--partitions", type=int, default=FIT_PARTITIONS, help="of the library's fit; others give other segments")
    sub.add_argument("--scale", action="store_true", help="scale the features")
    sub.add_argument("--exact", action="store_true", help="exact quantiles")
    sub.add_argument("--with-year", action="store_true", help="quarters of each year apart")
    texts = lambda value: tuple(value.split(","))
    sub.add_argument("--labels", type=texts, default=schema.SEGMENT_LABELS, help="rising, with commas between")
    numbers = lambda value: tuple(map(float, value.split(",")))
    sub.add_argument("--probabilities", type=numbers, default=schema.SEGMENT_QUANTILES, help="one less than labels")
    sub.add_argument("--cores", type=int, default=200, help="cores of the cluster")
    report = job("report")
    report.add_argument("--kind", choices=("csv", "json", "parquet"), default="csv")
    for own in (sub, report):
        own.add_argument("--source", choices=("ingest", "stream"), default="ingest", help="whose daily averages")
    return parser


def size_shuffles(spark: SparkSession, location: str, cores: int) -> int:
    """Set the shuffle partitions by the bytes of the files a job reads; returns their number."""
    files, path = file_system(spark, location)
    found = files.globStatus(path) or []
    size = sum(files.getContentSummary(file.getPath()).getLength() for file in found)
    number = shuffle_partitions(size, cores)
    spark.conf.set("spark.sql.shuffle.partitions", str(number))
    return number


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> dict:
    args = arguments().parse_args(argv)
    spark = spark or build_session(f"billscope-{args.job}")
    home = args.home.rstrip("/")
    admissions, ledger, segments = f"{home}/admission", f"{home}/status", f"{home}/segments"
    increments = f"{home}/increments"
    if args.job in ("ingest", "stream"):
        size_shuffles(spark, args.encounters, args.cores)
    elif args.job == "segment":
        size_shuffles(spark, admissions if args.source == "ingest" else increments, args.cores)
    if args.job in ("segment", "report") and args.source == "stream":
        admissions = read_accepted(spark, increments)
    if args.job == "ingest":
        bills = billing_columns(read_encounters(spark, args.encounters, keep_corrupt=not args.drop_unreadable))
        late = not args.no_late_count
        told = dict(count_late=late, lease_hours=args.lease_hours)
        loaded = ingest(spark, bills, admissions, ledger, args.run_id, args.start, args.boundary, **told)
        result = asdict(loaded)
    elif args.job == "stream":
        bills = billing_columns(stream_encounters(spark, args.encounters))
        told = dict(ledger_location=ledger, run_id=args.run_id, lease_hours=args.lease_hours)
        run_available(bills, increments, f"{increments}/checkpoint", **told)
        result = {}
    elif args.job == "segment":
        names = ("method", "k", "seed", "solver", "partitions", "scale", "exact", "with_year", "labels", "probabilities")
        options = {name: getattr(args, name) for name in names}
        rows = rebuild_segments(
            spark,
            admissions,
            ledger,
            segments,
            args.run_id,
            args.as_of,
            args.only_when_due,
            upstream=args.source,
            lease_hours=args.lease_hours,
            stored=f"{home}/quarters" if args.source == "ingest" else None,
            **options,
        )
        result = {"rows": rows}
    else:
        result = publish_reports(spark, admissions, segments, ledger, f"{home}/reports", args.kind)
    print(json.dumps({"job": args.job, **result}, default=str))
    return result


if __name__ == "__main__":
    main()
