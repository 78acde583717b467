"""Quarterly averages kept up to date: only quarters that a load has touched are averaged again.

The table has a folder per quarter (and year, where they are kept apart), named by its pointer, which also notes the
loads it was made from and their months. A refresh compares these with the loads that the admission table names now;
months of loads that came or went make their quarters due. Files of other months aren't opened, other quarters'
folders are kept. Beside each folder lies the quantile sketch of its averages, so quantiles of all need no rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from billscope import schema, versions
from billscope.functions import calendar
from billscope.operators import aggregates, quality, sketches
from billscope.operators.segment import AMOUNT
from billscope.sources import read_admissions

SKETCHES = "_sketches"
MONTH = "discharge_month"
QUARTERS = T.StructType([field for field in schema.SEGMENT.fields if field.name != "bill_cat"])
SKETCH_ROWS = T.StructType([T.StructField("sketch", T.BinaryType()), T.StructField("amounts", T.LongType())])


def _months(spark: SparkSession, location: str, load: str) -> list[str]:
    """Months of the rows that a load accepted, by the names of its folders."""
    found = versions.subfolders(spark, location, f"{load}/outcome=loaded")
    return [path.rsplit("=", 1)[1] for path in found]


def _quarter(month: str, with_year: bool) -> tuple[int, ...]:
    day = date.fromisoformat(month)
    quarter = (day.month + 2) // 3
    return (quarter, day.year) if with_year else (quarter,)


def _folders(with_year: bool) -> list[str]:
    return ["quarter", "year"] if with_year else ["quarter"]


def touched_quarters(spark: SparkSession, admissions: str, before: versions.Pointer | None, with_year: bool) -> tuple[set, dict]:
    """Quarters whose loads came or went since ``before``, and the months of each load now."""
    noted = before.notes["loads"] if before else {}
    table = versions.current(spark, admissions)
    loads = {load: noted.get(load) or _months(spark, admissions, load) for load in (table.folders if table else [])}
    changed = [months for load, months in loads.items() if load not in noted]
    changed += [months for load, months in noted.items() if load not in loads]
    return {_quarter(month, with_year) for months in changed for month in months}, loads


def refresh(
    spark: SparkSession, admissions: str, quarters: str, method: str = "mean_of_means", with_year: bool = False
) -> set[tuple[int, ...]]:
    """Bring the quarterly averages up to date with the stored admissions; returns the quarters averaged again.

    A table made with another method or key is made anew.
    """
    before = versions.current(spark, quarters)
    how = {"method": method, "with_year": with_year}
    if before and before.notes["how"] != how:
        standing, touched_since = [], None
    else:
        standing, touched_since = (before.folders if before else []), before
    touched, loads = touched_quarters(spark, admissions, touched_since, with_year)
    if not touched and before and before.notes["how"] == how:
        return touched
    names, folder = _folders(with_year), versions.new_folder()
    if touched:
        own = _rows_of(read_admissions(spark, admissions), touched, with_year)
        averages = aggregates.quarterly_average_bill(quality.drop_incomplete(own), method, with_year)
        columns = [*[name for name in QUARTERS.names if name not in names], *names]
        averages.select(*columns).hint("rebalance", *names).write.partitionBy(*names).parquet(f"{quarters}/{folder}")
        made = _read(spark, quarters, _leaves(spark, quarters, folder, names), with_year)
        drawn = sketches.quantile_sketches(made, AMOUNT, names)
        drawn.write.partitionBy(*names).parquet(f"{quarters}/{folder}/{SKETCHES}")
    due = {"/".join(f"{name}={value}" for name, value in zip(names, own, strict=True)) for own in touched}
    kept = [path for path in standing if path.split("/", 1)[1] not in due]
    versions.commit(spark, quarters, [*kept, *_leaves(spark, quarters, folder, names)], before, loads=loads, how=how)
    return touched


def _rows_of(rows: DataFrame, touched: set[tuple[int, ...]], with_year: bool) -> DataFrame:
    """Admissions of some quarters; the test is on the month partition, so other months' files stay closed."""
    month = F.col(MONTH)
    own = [calendar.quarter_of(month), F.year(month)] if with_year else [calendar.quarter_of(month)]
    key = F.concat_ws("-", *own)
    return rows.filter(key.isin(["-".join(map(str, values)) for values in sorted(touched)]))


def _leaves(spark: SparkSession, location: str, folder: str, names: Sequence[str]) -> list[str]:
    found = [folder]
    for name in names:
        found = [path for own in found for path in versions.subfolders(spark, location, own) if f"/{name}=" in path]
    return found


def _read(spark: SparkSession, location: str, folders: list[str], with_year: bool) -> DataFrame:
    columns = T.StructType([*QUARTERS.fields, T.StructField("year", T.IntegerType())]) if with_year else QUARTERS
    rows = versions.read(spark, location, columns, pointer=versions.Pointer(0, folders))
    return rows.select(*columns.names)


def read_quarters(spark: SparkSession, location: str) -> DataFrame:
    """The stored quarterly averages."""
    pointer = versions.current(spark, location)
    if pointer is None:
        return spark.createDataFrame([], QUARTERS)
    return _read(spark, location, pointer.folders, pointer.notes["how"]["with_year"])


def read_sketches(spark: SparkSession, location: str) -> DataFrame:
    """The quantile sketches of the stored quarters: one small row for each."""
    pointer = versions.current(spark, location)
    paths = []
    for path in pointer.folders if pointer else []:
        folder, quarter = path.split("/", 1)
        paths.append(f"{location}/{folder}/{SKETCHES}/{quarter}")
    if not paths:
        return spark.createDataFrame([], SKETCH_ROWS)
    return spark.read.schema(SKETCH_ROWS).parquet(*paths)


def stored_edges(
    spark: SparkSession, location: str, probabilities: Sequence[float] = schema.SEGMENT_QUANTILES
) -> DataFrame:
    """Quantiles of all stored averages, from their sketches alone."""
    return sketches.merged_edges(read_sketches(spark, location), probabilities)
