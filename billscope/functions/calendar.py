"""Date columns."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def quarter_of(day: Column) -> Column:
    """Calendar quarter 1 to 4; NULL stays NULL."""
    return F.quarter(day).cast("int")


def month_start(day: Column) -> Column:
    return F.trunc(day, "month")


def one_month_after(day: Column) -> Column:
    """Same day next month, held at the month's last day."""
    return F.add_months(day, 1)


def as_date(value: date | str | Column) -> Column:
    """A date column from a date, text or column; text that is no date is an error."""
    if isinstance(value, Column):
        return value
    if isinstance(value, str):
        return F.lit(date.fromisoformat(value))
    return F.lit(value).cast("date")


def date_text(day: Column) -> Column:
    """``2024-05-01``; a plain cast, which no session time zone can shift."""
    return day.cast("string")


def timestamp_text(moment: Column) -> Column:
    """``2024-05-01 12:00:00``, with the fraction of a second where there is one."""
    return moment.cast("string")


def now_text() -> Column:
    return timestamp_text(F.current_timestamp())
