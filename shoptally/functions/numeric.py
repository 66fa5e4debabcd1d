"""Rounding and ratio expressions.

Published figures round half away from zero, once: a double becomes the shortest decimal that
stands for it (1.005 for what is stored as 1.00499999999999989), and that is rounded.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType


def half_up(value: Column, digits: int) -> Column:
    """Rounded; a double that has no decimal of 20 digits before the point has no digits after it and stays as it is."""
    double = value.cast("double")
    return F.coalesce(F.round(double.try_cast(DecimalType(38, 18)), digits).cast("double"), double)


def money(total: Column) -> Column:
    """A sum of money (kept as DECIMAL until here) as a double with two digits."""
    return F.round(total, 2).cast("double")


def money_or_zero(total: Column) -> Column:
    return F.coalesce(money(total), F.lit(0.0))


def ratio(part: Column, whole: Column) -> Column:
    """part / whole, null where the denominator is zero or either side is null."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def ratio_or_zero(part: Column, whole: Column, digits: int) -> Column:
    return F.coalesce(half_up(ratio(part, whole), digits), F.lit(0.0))


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    return half_up(ratio(F.lit(100.0) * part, whole), digits)


def count_or_zero(name: str) -> Column:
    """Zero-fill for an additive count that an outer join left null."""
    return F.coalesce(F.col(name), F.lit(0).cast("bigint")).alias(name)


def sum_or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))
