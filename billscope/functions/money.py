"""Money as whole cents.

Sums of bigint cents are exact, do not depend on the order of rows and stay in primitive longs inside
generated code. Averages are rounded half up (away from zero) to a cent with integer arithmetic.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from billscope.schema import AMOUNT


def cents(amount: Column) -> Column:
    """Cents of a decimal with two places."""
    return (amount * 100).cast("bigint")


def cents_of_double(amount: Column) -> Column:
    """Cents of a double, halves away from zero; NaN and what no bigint holds become NULL."""
    size = F.floor(F.abs(amount) * 100 + F.lit(0.5))
    return F.when(F.abs(amount) < 9e16, F.when(amount < 0, -size).otherwise(size))


def amount(cents_: Column) -> Column:
    """Decimal amount with two places; NULL beyond what it holds."""
    return (cents_.try_cast("decimal(18,0)") * F.lit(Decimal("0.01"))).cast(AMOUNT)


def mean_cents(total: Column, count: Column) -> Column:
    """``total / count`` rounded half up to a whole cent; NULL when there is nothing to average."""
    rounded = F.abs(total) + F.call_function("div", count, F.lit(2))
    mean = F.call_function("div", rounded, F.nullif(count, F.lit(0)))
    return F.when(total < 0, -mean).otherwise(mean)
