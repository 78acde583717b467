"""Row rules: completeness, reject reasons, guards and counts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from billscope import schema

COMPLETE_COLUMNS = ("medical_condition", "hospital", "average_bill_amount", "insurance_provider", "quarter")


class NoRowsError(ValueError):
    """Raised where a step must not run on empty input."""


def drop_incomplete(df: DataFrame, columns: Sequence[str] = COMPLETE_COLUMNS) -> DataFrame:
    """Keep rows with a value in every one of ``columns``; the tests are pushed into the scan."""
    return df.dropna(subset=list(columns))


def reject_reason(
    keys: Sequence[str] = schema.BILL_KEYS,
    amount: str = "average_bill_amount",
    day: str = "discharge_date",
    length: int = schema.NAME_LENGTH,
    digits: int = schema.STORED_AMOUNT_DIGITS,
    as_of: Column | None = None,
) -> Column:
    """First rule of the stored table a row breaks, NULL for a valid row.

    Amounts are compared as they are stored, rounded to cents. With ``as_of`` a later date breaks a rule too.
    """
    beyond = F.lit(False) if as_of is None else F.col(day) > as_of
    names = [F.col(key) for key in keys]
    limit = 10 ** (digits - 2)
    return (
        F.when(reduce(or_, [name.isNull() for name in names]), "null_key")
        .when(reduce(or_, [F.char_length(name) > length for name in names]), "too_long")
        .when(F.col(amount).isNull(), "amount_null")
        .when(F.abs(F.col(amount)) >= limit, "amount_range")
        .when(F.col(day).isNull(), "date_null")
        .when(beyond, "date_range")
    )


def check_rows(df: DataFrame, reason: Column | None = None) -> DataFrame:
    return df.withColumn("reject_reason", reject_reason() if reason is None else reason)


def split_valid(df: DataFrame, reason: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """Valid rows and rejected rows; together they are the input, no row is in both."""
    checked = check_rows(df, reason)
    valid = checked.filter(F.col("reject_reason").isNull()).drop("reject_reason")
    return valid, checked.filter(F.col("reject_reason").isNotNull())


def load_counts(checked: DataFrame) -> DataFrame:
    """Rows loaded and rejected, and all of them."""
    return checked.agg(
        F.count(F.lit(1)).alias("rows_seen"),
        F.count_if(F.col("reject_reason").isNull()).alias("rows_loaded"),
        F.count("reject_reason").alias("rows_rejected"),
    )


def require_rows(df: DataFrame, what: str = "input") -> DataFrame:
    """Fail on empty input; reads one row, not the whole input."""
    if df.isEmpty():
        raise NoRowsError(f"no rows in {what}")
    return df


def observe_counts(df: DataFrame, name: str, **measures: Column) -> tuple[DataFrame, Observation]:
    """Count rows, and take further measures, while another action runs over them.

    Place it after the last shuffle of that action: tasks that are run again after an executor is lost
    then do not count twice.
    """
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), *[m.alias(n) for n, m in measures.items()]), seen
