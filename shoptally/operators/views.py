"""City-level views: revenue, returns, category mix, stock-outs, customers, cohorts.

Revenue always means the line totals of completed orders.  Facts are reduced to store grain
before the store dimension is joined, so that join is small on both sides.  Sums that span a
view of a view stay where they are defined: a share uses unrounded sums, an average order
value the rounded revenue.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shoptally.functions.calendar import month_of, months_apart
from shoptally.functions.frames import series, trailing
from shoptally.functions.numeric import half_up, money, percent, ratio
from shoptally.operators.facts import (
    city_of,
    completed,
    sold_lines,
    store_month_revenue,
)

COHORT_MONTHS = 6


def monthly_revenue_by_city(orders: DataFrame, order_items: DataFrame, stores: DataFrame) -> DataFrame:
    return (
        store_month_revenue(orders, order_items)
        .join(city_of(stores), "store_id")
        .groupBy("city", "month")
        .agg(F.sum("order_count").alias("order_count"), money(F.sum("revenue")).alias("revenue"))
    )


def revenue_trend(revenue_by_city: DataFrame) -> DataFrame:
    """Month-over-month change per city; the previous row counts, not the previous month."""
    previous = F.lag("revenue").over(series(["city"], "month"))
    return revenue_by_city.withColumn("prev_month_revenue", previous).withColumn(
        "mom_pct_change",
        percent(F.col("revenue") - F.col("prev_month_revenue"), F.col("prev_month_revenue")),
    )


def focus_revenue_trend(revenue_by_city: DataFrame, city: str) -> DataFrame:
    return revenue_trend(of_city(revenue_by_city, city)).drop("city")


def of_city(view: DataFrame, city: str) -> DataFrame:
    return view.where(F.col("city") == city)


def before_month_of(view: DataFrame, as_of: Column) -> DataFrame:
    """Complete months only: those before the month of the reference date."""
    return view.where(F.col("month") < month_of(as_of))


def expected_vs_actual(revenue_by_city: DataFrame, city: str, as_of: Column) -> DataFrame:
    """Revenue against the mean of up to three preceding months (partial frames count)."""
    expected = trailing(F.avg, F.col("revenue"), series(["city"], "month"), 3)
    gap = F.col("revenue") - F.col("expected")
    return (
        before_month_of(of_city(revenue_by_city, city), as_of)
        .withColumn("expected", expected)
        .select(
            "month",
            F.col("revenue").alias("actual_revenue"),
            half_up(F.col("expected"), 2).alias("expected_revenue_trailing_3mo"),
            half_up(gap, 2).alias("anomaly_amount"),
            percent(gap, F.col("expected")).alias("anomaly_pct"),
        )
    )


def marketing_spend_by_city_month(campaigns: DataFrame) -> DataFrame:
    """A campaign is booked whole to the month it starts in."""
    return campaigns.groupBy(
        F.col("city_target").alias("city"), month_of("start_date").alias("month")
    ).agg(
        F.count(F.lit(1)).alias("campaign_count"),
        money(F.sum("budget")).alias("total_budget"),
        money(F.sum("spend")).alias("total_spend"),
    )


def stockout_indicators(inventory: DataFrame, stores: DataFrame, city: str) -> DataFrame:
    per_store = inventory.groupBy("store_id", month_of("snapshot_date").alias("month")).agg(
        F.count_if(F.col("stock_level") == 0).alias("zero"),
        F.count_if(F.col("stock_level") <= F.col("reorder_level")).alias("low"),
        F.count(F.lit(1)).alias("total"),
    )
    names = of_city(stores, city).select("store_id", "store_name")
    return (
        per_store.join(names, "store_id")
        .groupBy("month", "store_name")
        .agg(
            F.sum("zero").alias("zero_stock_snapshots"),
            F.sum("low").alias("at_or_below_reorder_snapshots"),
            F.sum("total").alias("total_snapshots"),
        )
        .withColumn(
            "pct_snapshots_constrained",
            percent(F.col("at_or_below_reorder_snapshots"), F.col("total_snapshots")),
        )
    )


def return_rate_by_city_month(orders: DataFrame, returns: DataFrame, stores: DataFrame) -> DataFrame:
    """Returns of completed orders, by the month of the order.

    Returns are counted per order first: the join does not fan out and neither side needs a
    distinct count afterwards.
    """
    per_order = (
        returns.select("order_id", "return_id").distinct().groupBy("order_id").agg(F.count("return_id").alias("n"))
    )
    per_store = (
        completed(orders)
        .join(per_order, "order_id", "left")
        .groupBy("store_id", month_of("order_date").alias("month"))
        .agg(F.count(F.lit(1)).alias("orders"), F.coalesce(F.sum("n"), F.lit(0)).alias("returns"))
    )
    return (
        per_store.join(city_of(stores), "store_id")
        .groupBy("city", "month")
        .agg(F.sum("orders").alias("order_count"), F.sum("returns").alias("return_count"))
        .withColumn("return_rate_pct", percent(F.col("return_count"), F.col("order_count")))
    )


def category_revenue_by_city_month(
    orders: DataFrame, order_items: DataFrame, products: DataFrame, stores: DataFrame
) -> DataFrame:
    """Category revenue with its share of the city's month, from unrounded sums.

    Lines meet their product unaggregated: a small product table is broadcast once its size is
    known, a large one is shuffled with them, and AQE splits the partition of a hot product.
    """
    per_category = (
        sold_lines(orders, order_items)
        .select("product_id", "store_id", month_of("order_date").alias("month"), "line_total")
        .join(products.select("product_id", "category"), "product_id")
        .groupBy("store_id", "month", "category")
        .agg(F.sum("line_total").alias("revenue"))
        .join(city_of(stores), "store_id")
        .groupBy("city", "month", "category")
        .agg(F.sum("revenue").alias("total"))
    )
    city_month = F.sum("total").over(W.partitionBy("city", "month"))
    return per_category.select(
        "city",
        "month",
        "category",
        money(F.col("total")).alias("revenue"),
        percent(F.col("total"), city_month).alias("pct_of_city_month_revenue"),
    )


def customer_city_months(orders: DataFrame, stores: DataFrame) -> DataFrame:
    """Distinct (customer_id, city, month) of completed orders."""
    return (
        completed(orders)
        .join(city_of(stores), "store_id")
        .select("customer_id", "city", month_of("order_date").alias("month"))
        .distinct()
    )


def monthly_active_customers_by_city(orders: DataFrame, stores: DataFrame) -> DataFrame:
    return customer_city_months(orders, stores).groupBy("city", "month").agg(
        F.count("customer_id").alias("active_customers")
    )


def new_vs_returning_customers(orders: DataFrame, stores: DataFrame) -> DataFrame:
    """A customer is new in the month of the first completed order anywhere, in a known store or not.

    The minimum joins the store months of the same orders by customer, of which it has one row.
    """
    first_order = completed(orders).groupBy("customer_id").agg(
        month_of(F.min("order_date")).alias("first_month")
    )
    return (
        customer_city_months(orders, stores)
        .join(first_order, "customer_id")
        .groupBy("city", "month")
        .agg(
            F.count_if(F.col("first_month") == F.col("month")).alias("new_customers"),
            F.count_if(F.col("first_month") < F.col("month")).alias("returning_customers"),
            F.count(F.lit(1)).alias("total_active_customers"),
        )
    )


def repeat_purchase_rate(orders: DataFrame, stores: DataFrame) -> DataFrame:
    per_customer = (
        completed(orders)
        .join(city_of(stores), "store_id")
        .groupBy("city", month_of("order_date").alias("month"), "customer_id")
        .agg(F.count(F.lit(1)).alias("orders"))
    )
    return (
        per_customer.groupBy("city", "month")
        .agg(
            F.count(F.lit(1)).alias("active_customers"),
            F.count_if(F.col("orders") > 1).alias("repeat_customers"),
        )
        .withColumn("repeat_purchase_rate_pct", percent(F.col("repeat_customers"), F.col("active_customers")))
    )


def average_order_value(revenue_by_city: DataFrame) -> DataFrame:
    return revenue_by_city.withColumn(
        "avg_order_value", half_up(ratio(F.col("revenue"), F.col("order_count")), 2)
    )


def customer_retention(orders: DataFrame, stores: DataFrame, city: str) -> DataFrame:
    """Who bought in the city last calendar month and did so again this month.

    A lag over each customer's months replaces the self join: a customer is retained if the
    row before is the month before.  Months without buyers have no row, and the month after
    such a gap has no prior customers.
    """
    active = (
        completed(orders)
        .join(of_city(stores, city).select("store_id"), "store_id")
        .select("customer_id", month_of("order_date").alias("month"))
        .distinct()
    )
    month_before = F.add_months(F.col("month"), -1)
    per_month = (
        active.withColumn("previous", F.lag("month").over(series(["customer_id"], "month")))
        .groupBy("month")
        .agg(
            F.count(F.lit(1)).alias("active_customers"),
            F.count_if(F.col("previous") == month_before).alias("retained_from_prior_month"),
        )
    )
    calendar = series([], "month")
    prior = F.when(
        F.lag("month").over(calendar) == month_before, F.lag("active_customers").over(calendar)
    ).otherwise(F.lit(0).cast("bigint"))
    lost = F.col("active_prior_month") - F.col("retained_from_prior_month")
    return per_month.withColumn("active_prior_month", prior).select(
        "month",
        "active_customers",
        "active_prior_month",
        "retained_from_prior_month",
        lost.alias("churned_from_prior_month"),
        percent(F.col("retained_from_prior_month"), F.col("active_prior_month")).alias("retention_rate_pct"),
        percent(lost, F.col("active_prior_month")).alias("churn_rate_pct"),
    )


def customer_cohorts(customers: DataFrame, orders: DataFrame, months: int = COHORT_MONTHS) -> DataFrame:
    """Share of each signup cohort (home city and signup month) that buys N months later."""
    cohort = customers.select("customer_id", "city", month_of("signup_date").alias("cohort_month"))
    sizes = cohort.groupBy("city", "cohort_month").agg(F.count(F.lit(1)).alias("cohort_size"))
    bought = (
        completed(orders).select("customer_id", month_of("order_date").alias("order_month")).distinct()
    )
    in_range = F.col("order_month").between(F.col("cohort_month"), F.add_months("cohort_month", months))
    active = (
        cohort.join(bought, "customer_id")
        .where(in_range)
        .groupBy("city", "cohort_month", months_apart(F.col("cohort_month"), F.col("order_month")).alias("month_offset"))
        .agg(F.count(F.lit(1)).alias("active_customers"))
    )
    return active.join(sizes, ["city", "cohort_month"]).select(
        "city",
        "cohort_month",
        "cohort_size",
        "month_offset",
        "active_customers",
        percent(F.col("active_customers"), F.col("cohort_size")).alias("pct_of_cohort_active"),
    )
