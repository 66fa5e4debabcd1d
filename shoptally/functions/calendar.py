"""Months, calendars and reference dates.

Range bounds are scalar subqueries: nothing is collected to the driver, and a calendar is
exploded next to each entity row, so a scaffold needs no cross join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def month_of(date: Column | str) -> Column:
    """First day of the month, as DATE."""
    return F.trunc(F.col(date) if isinstance(date, str) else date, "month")


def month_label(month: Column | str) -> Column:
    return F.date_format(month, "yyyy-MM")


def parse_month(label: Column | str) -> Column:
    return F.to_date(label, "yyyy-MM")


def months_apart(earlier: Column, later: Column) -> Column:
    """Whole calendar months between two dates, ignoring the day of month."""
    return (
        (F.year(later) - F.year(earlier)) * 12 + F.month(later) - F.month(earlier)
    ).cast("int")


def latest_date(df: DataFrame, column: str) -> Column:
    """Scalar subquery with the largest date of a column."""
    return df.agg(F.max(column)).scalar()


def date_bounds(df: DataFrame, column: str) -> Column:
    """Scalar subquery with struct(lo, hi) of a date column."""
    return df.agg(F.struct(F.min(column).alias("lo"), F.max(column).alias("hi")).alias("b")).scalar()


def days(lo: Column, hi: Column) -> Column:
    return F.sequence(lo, hi, F.expr("interval 1 day"))


def months(lo: Column, hi: Column) -> Column:
    """Array of month starts from lo to hi, empty if the range is."""
    first, last = month_of(lo), month_of(hi)
    return F.when(first <= last, F.sequence(first, last, F.expr("interval 1 month"))).otherwise(
        F.array().cast("array<date>")
    )


def previous_month(date: Column) -> Column:
    return F.add_months(month_of(date), -1)
