"""Reports: the three stored tables in the form people read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from billscope import schema
from billscope.operators import quality, reports
from billscope.sinks import open_ledger, publish
from billscope.sources import read_admissions, read_table


def publish_reports(
    spark: SparkSession,
    admissions: str | DataFrame,
    segments: str | DataFrame,
    ledger_location: str,
    out: str,
    kind: str = "csv",
) -> dict[str, int | str]:
    """Publish every report; one that fails leaves its reason in the result and the next goes on.

    Admissions and segments are stored tables or frames, such as a stream's days or a JDBC scan.
    """

    def segment_rows() -> DataFrame:
        return read_table(spark, segments, columns=schema.SEGMENT) if isinstance(segments, str) else segments

    def admission_rows() -> DataFrame:
        return read_admissions(spark, admissions) if isinstance(admissions, str) else admissions

    frames = {
        "segments": lambda: reports.segments(segment_rows()),
        "admissions": lambda: reports.admissions(admission_rows()),
        "runs": lambda: reports.runs(open_ledger(spark, ledger_location)),
    }
    results: dict[str, int | str] = {}
    for name, frame in frames.items():
        try:
            results[name] = publish(quality.require_rows(frame(), name), f"{out}/{name}", kind)
        except Exception as error:  # noqa: BLE001
            results[name] = f"{type(error).__name__}: {error}"
    return results
