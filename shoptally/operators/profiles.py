"""Descriptive statistics: counts, shares, pivots, histograms, exact quantiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shoptally.functions.calendar import date_bounds, month_label, month_of, months
from shoptally.functions.frames import series
from shoptally.functions.numeric import half_up, money, ratio
from shoptally.operators.facts import city_of, completed, order_totals
from shoptally.operators.ordering import sorted_in_ranges



def table_counts(tables: Mapping[str, DataFrame], counted: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Rows and columns of each table; ``counted`` names tables with as many rows that cost less to count."""
    counted = counted or {}
    counts = [
        counted.get(name, df)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(name).alias("table_name"), "row_count", F.lit(len(df.columns)).alias("column_count"))
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def value_shares(df: DataFrame, column: str) -> DataFrame:
    """Distinct values with their count and share of all rows."""
    counts = df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    everything = counts.agg(F.sum("n")).scalar()
    return counts.select(
        F.lit(column).alias("attribute"), "value", "n", half_up(ratio(F.col("n"), everything), 4).alias("share")
    )


def count_by(df: DataFrame, column: str, name: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias(name))


def stores_per_city(stores: DataFrame) -> DataFrame:
    """Stores of a city as a sorted list; the store dimension is small by nature."""
    return stores.groupBy("city").agg(
        F.count(F.lit(1)).alias("store_count"),
        F.array_join(F.sort_array(F.collect_list("store_id")).cast("array<string>"), ",").alias("store_ids"),
    )


def campaign_spend_by_city(campaigns: DataFrame) -> DataFrame:
    return campaigns.groupBy(F.col("city_target").alias("city")).agg(
        F.count(F.lit(1)).alias("campaigns"), money(F.sum("spend")).alias("total_spend")
    )


# --- month x city tables ------------------------------------------------------------------


def _newest(per_city_month: DataFrame, months: int | None) -> DataFrame:
    """The rows of the newest months: calendar months, so few whatever the size of the facts."""
    if months is None:
        return per_city_month
    newest = per_city_month.select("month").distinct().orderBy(F.col("month").desc()).limit(months)
    return per_city_month.join(newest, "month", "left_semi")


def across(per_city_month: DataFrame, value: str, cities: Sequence[str]) -> DataFrame:
    """Wide form: months down, the cities of the caller's list across, 0 where a city has nothing."""
    return per_city_month.groupBy("month").pivot("city", list(cities)).agg(F.sum(value)).na.fill(0)


def monthly_signups(customers: DataFrame, newest: int | None = None) -> DataFrame:
    """(month, city, signups)"""
    per_city = customers.groupBy(month_of("signup_date").alias("month"), "city").agg(F.count(F.lit(1)).alias("signups"))
    return _newest(per_city, newest)


def monthly_orders(orders: DataFrame, stores: DataFrame, newest: int | None = None) -> DataFrame:
    """(month, city, orders) of any status."""
    per_store = orders.groupBy("store_id", month_of("order_date").alias("month")).agg(F.count(F.lit(1)).alias("n"))
    per_city = per_store.join(city_of(stores), "store_id").groupBy("month", "city").agg(F.sum("n").alias("orders"))
    return _newest(per_city, newest)


def monthly_gross_revenue(
    orders: DataFrame, order_items: DataFrame, stores: DataFrame, newest: int | None = None
) -> DataFrame:
    """(month, city, revenue): line totals of orders of any status, of the newest months with lines."""
    per_store = (
        orders.join(order_totals(order_items), "order_id")
        .groupBy("store_id", month_of("order_date").alias("month"))
        .agg(F.sum("revenue").alias("revenue"))
    )
    per_city = per_store.join(city_of(stores), "store_id").groupBy("month", "city").agg(
        money(F.sum("revenue")).alias("revenue")
    )
    return _newest(per_city, newest)


def returned_share_by_city(
    orders: DataFrame, returns: DataFrame, stores: DataFrame, as_of: Column, within_months: int
) -> DataFrame:
    """Share of recent completed orders that have a return."""
    flagged = returns.select("order_id").distinct().withColumn("returned", F.lit(True))
    per_store = (
        completed(orders)
        .where(F.col("order_date") >= F.add_months(as_of, -within_months))
        .join(flagged, "order_id", "left")
        .groupBy("store_id")
        .agg(F.count(F.lit(1)).alias("orders"), F.count("returned").alias("returned"))
    )
    return (
        per_store.join(city_of(stores), "store_id")
        .groupBy("city")
        .agg(F.sum("orders").alias("orders"), F.sum("returned").alias("returned"))
        .select("city", "orders", half_up(ratio(F.col("returned"), F.col("orders")), 4).alias("returned_share"))
    )


def eligible_customers(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Customers signed up by the end of each month of the order calendar.

    A running sum of signups per month; customers and months are never paired.
    """
    span = date_bounds(orders, "order_date")
    calendar = customers.sparkSession.range(1).select(
        F.explode(months(span["lo"], span["hi"])).alias("month"), F.lit(0).cast("bigint").alias("n")
    )
    signups = customers.groupBy(month_of("signup_date").alias("month")).agg(F.count(F.lit(1)).alias("n"))
    so_far = series([], "month").rowsBetween(W.unboundedPreceding, W.currentRow)
    return (
        signups.unionByName(calendar)
        .groupBy("month")
        .agg(F.sum("n").alias("n"))
        .select("month", F.sum("n").over(so_far).alias("eligible_customers"))
        .where(F.col("month").between(month_of(span["lo"]), month_of(span["hi"])))
    )


# --- parts of dates and strings ------------------------------------------------------------


def month_parts(orders: DataFrame) -> DataFrame:
    """Label, year, quarter and month number of each order month, from its yyyy-MM label."""
    month = F.to_date("label", "yyyy-MM")
    return (
        orders.select(month_label("order_date").alias("label"))
        .distinct()
        .select(
            F.col("label").alias("month_label"),
            month.alias("month"),
            F.year(month).alias("year"),
            F.quarter(month).alias("quarter"),
            F.month(month).alias("month_number"),
        )
    )


def customer_email(first: Column, last: Column, customer_id: Column) -> Column:
    return F.concat(F.lower(first), F.lit("."), F.lower(last), customer_id.cast("string"), F.lit("@example.com"))


# --- distributions -------------------------------------------------------------------------


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """Equal-width bins over the value range, the last one closed; empty bins are kept.

    If all values are equal the range is widened by a half on both sides.
    """
    values = df.select(F.col(column).cast("double").alias("x")).where(F.col("x").isNotNull())
    range_of = values.agg(F.min("x").alias("lo"), F.max("x").alias("hi")).selectExpr(
        f"if(lo = hi, struct(lo - 0.5D AS lo, 1D / {bins} AS width), struct(lo, (hi - lo) / {bins} AS width))"
    )
    bounds = range_of.scalar()
    position = F.floor((F.col("x") - F.col("b.lo")) / F.col("b.width"))
    filled = (
        values.withColumn("b", bounds)
        .groupBy(F.least(position, F.lit(bins - 1)).cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    frame = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin")).withColumn("b", bounds)
    return frame.join(filled, "bin", "left").select(
        "bin",
        half_up(F.col("b.lo") + F.col("bin") * F.col("b.width"), 4).alias("bin_start"),
        half_up(F.col("b.lo") + (F.col("bin") + 1) * F.col("b.width"), 4).alias("bin_end"),
        F.coalesce("n", F.lit(0).cast("bigint")).alias("n"),
    )


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles and maximum per column."""
    names = [F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x")) for c in columns]
    values = df.select(F.inline(F.array(*names))).where(F.col("x").isNotNull())
    basics = values.groupBy("column").agg(
        F.count("x").alias("count"),
        F.avg("x").alias("mean"),
        F.stddev_samp("x").alias("std"),
        F.min("x").alias("min"),
        F.max("x").alias("max"),
    )
    quartiles = (
        exact_quantiles(values, basics, (0.25, 0.5, 0.75))
        .groupBy("column")
        .pivot("p", ["0.25", "0.5", "0.75"])
        .agg(F.max("q"))
    )
    return basics.join(quartiles, "column").select(
        F.col("column").alias("column_name"),
        "count",
        half_up(F.col("mean"), 4).alias("mean"),
        half_up(F.col("std"), 4).alias("std"),
        "min",
        half_up(F.col("`0.25`"), 4).alias("p25"),
        half_up(F.col("`0.5`"), 4).alias("p50"),
        half_up(F.col("`0.75`"), 4).alias("p75"),
        "max",
    )


def exact_quantiles(values: DataFrame, basics: DataFrame, probabilities: Sequence[float]) -> DataFrame:
    """Linearly interpolated quantiles of `x` per `column`, without sorting all values in a task.

    Equal values are combined first.  The distinct ones are sorted in ranges whose bounds Spark takes from the values
    themselves, so an outlier or a narrow cluster of doubles does not put most of them in one range.  The
    values of a range, summed up, show which ranges hold a wanted rank, and only these are added up
    value by value.  `basics` has min, max and count per column.  The distinct values are kept as a table.
    """
    distinct = values.groupBy("column", "x").agg(F.count(F.lit(1)).alias("n"))
    placed = sorted_in_ranges(distinct, ["column", "x"])
    so_far = W.partitionBy("column").orderBy("_o_range").rowsBetween(W.unboundedPreceding, W.currentRow)
    # One row per column and range.
    ranges = (
        placed.groupBy("column", "_o_range")
        .agg(F.sum("n").alias("in_range"))
        .withColumn("before", F.sum("in_range").over(so_far) - F.col("in_range"))
        .join(basics.select("column", F.col("count").alias("rows")), "column")
    )
    ranks = F.array(
        *[
            F.struct(F.lit(str(p)).alias("p"), ((F.col("rows") - 1) * F.lit(p)).alias("position"))
            for p in probabilities
        ]
    )
    wanted = (
        ranges.select("column", "_o_range", "before", "in_range", F.inline(ranks))
        .select("*", F.explode(F.array_distinct(F.array(F.floor("position"), F.ceil("position")))).alias("rank"))
        .where((F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("before") + F.col("in_range")))
    )
    within = W.partitionBy("column", "_o_range").orderBy("x").rowsBetween(W.unboundedPreceding, W.currentRow)
    hit = wanted.select("column", "_o_range").distinct()
    ordered = placed.join(hit, ["column", "_o_range"], "left_semi").select(
        "column", "_o_range", "x", "n", F.sum("n").over(within).alias("through")
    )
    found = ordered.join(wanted, ["column", "_o_range"]).where(
        (F.col("rank") < F.col("before") + F.col("through"))
        & (F.col("rank") >= F.col("before") + F.col("through") - F.col("n"))
    )
    lower = F.min("x")
    upper = F.max("x")
    return found.groupBy("column", "p", "position").agg(
        (lower + (upper - lower) * (F.col("position") - F.floor("position"))).alias("q")
    )
