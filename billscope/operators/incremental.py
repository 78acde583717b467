"""Which rows are new since the last load."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from billscope.functions import calendar

# Fixed value: the date taken as loaded before the first run.
DEFAULT_START = date(2019, 5, 8)


def is_new(day: Column, last_loaded: date | str | Column, boundary: str = "after") -> Column:
    """Test for dates beyond the last loaded one.

    ``after`` takes every later day. ``step`` starts one month after the last loaded date and so leaves
    out the days between.
    """
    last = calendar.as_date(last_loaded)
    if boundary == "after":
        return day > last
    if boundary == "step":
        return day >= calendar.one_month_after(last)
    raise ValueError(f"unknown boundary {boundary!r}")


def slice_new(
    rows: DataFrame,
    last_loaded: date | str | Column | None,
    boundary: str = "after",
    day: str = "discharge_date",
    month_partition: str | None = None,
    keep_undated: bool = False,
) -> DataFrame:
    """New rows only; rows without a date are left out unless ``keep_undated`` asks for them.

    The bound is a constant date, so it reaches the file scan. For a table partitioned by month name the
    partition column and older months are not read at all.
    """
    if last_loaded is None:
        return rows if keep_undated else rows.filter(F.col(day).isNotNull())
    new = is_new(F.col(day), last_loaded, boundary)
    if month_partition:
        last = calendar.as_date(last_loaded)
        new &= F.col(month_partition) >= calendar.month_start(last)
    return rows.filter(new | F.col(day).isNull() if keep_undated else new)


def late_rows(
    rows: DataFrame, last_loaded: date | str | Column, boundary: str = "after", day: str = "discharge_date"
) -> DataFrame:
    """Dated rows the slice leaves out."""
    return rows.filter(~is_new(F.col(day), last_loaded, boundary))
