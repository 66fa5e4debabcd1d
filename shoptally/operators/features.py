"""Feature tables, built from analytics tables only.

No feature of a period uses that period's own outcome, except the seasonal index, which by
definition compares a month with the full-sample mean of its calendar month.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shoptally.functions.calendar import month_label, month_of, parse_month, previous_month
from shoptally.functions.frames import series, trailing_full
from shoptally.functions.numeric import half_up, ratio


def sales_forecasting_features(monthly: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Lags, rolling statistics and calendar position of a monthly series (one per key).

    Expects complete months, labelled yyyy-MM.  Warm-up rows stay, with nulls.
    """
    order = series(keys, "month")
    revenue = F.col("revenue")
    month = parse_month("month")
    same_calendar_month = W.partitionBy(*keys, "month_number")
    return (
        monthly.select(
            *keys,
            "month",
            "revenue",
            "orders",
            "customers",
            "units_sold",
            *[F.lag(revenue, n).over(order).alias(f"lag_{n}_revenue") for n in (1, 2, 3)],
            trailing_full(F.avg, revenue, order, 3).alias("rolling_mean_3"),
            trailing_full(F.avg, revenue, order, 6).alias("rolling_mean_6"),
            trailing_full(F.stddev_samp, revenue, order, 3).alias("rolling_std_3"),
        )
        .withColumns(
            {
                "revenue_growth_rate": ratio(
                    F.col("lag_1_revenue") - F.col("lag_2_revenue"), F.col("lag_2_revenue")
                ),
                "month_number": F.month(month),
                "quarter": F.quarter(month),
                "year": F.year(month),
                "moving_average_difference": F.col("rolling_mean_3") - F.col("rolling_mean_6"),
            }
        )
        .withColumn(
            "seasonal_index", half_up(ratio(revenue, F.avg("revenue").over(same_calendar_month)), 4)
        )
    )


def customer_features(summary: DataFrame) -> DataFrame:
    """Purchase rhythm and recency, frequency, monetary aliases.

    The gap between orders needs two orders; recency stays null for those who never bought.
    """
    per_30_days = F.col("lifetime_days") / 30.0
    span = F.datediff("last_order_date", "first_order_date")
    return summary.select(
        "customer_id",
        "total_orders",
        "total_spent",
        "average_order_value",
        "total_items",
        "first_order_date",
        "last_order_date",
        F.col("lifetime_days").alias("customer_lifetime_days"),
        "days_since_last_purchase",
        half_up(ratio(F.col("total_orders"), per_30_days), 4).alias("purchase_frequency"),
        half_up(ratio(span, F.col("total_orders") - 1), 2).alias("average_days_between_orders"),
        F.col("days_since_last_purchase").alias("recency"),
        F.col("total_orders").alias("frequency"),
        F.col("total_spent").alias("monetary"),
        "is_active",
    )


def product_features(
    performance: DataFrame, inventory_health: DataFrame, monthly: DataFrame, as_of: Column
) -> DataFrame:
    """All-time figures plus the trailing three complete months and the latest month's growth.

    `monthly` needs only the last three complete months of the product-month table.
    """
    last = previous_month(as_of)

    def units_in(*months_back: int) -> Column:
        wanted = [month_label(F.add_months(last, -n)) for n in months_back]
        return F.sum(F.when(F.col("month").isin(*wanted), F.col("units_sold")))

    recent = monthly.groupBy("product_id").agg(
        units_in(0, 1, 2).alias("sales_last_90_days"),
        units_in(0).alias("last_units"),
        units_in(1).alias("previous_units"),
    )
    growth = ratio(F.col("last_units") - F.col("previous_units"), F.col("previous_units"))
    stock = inventory_health.select("product_id", F.col("units_sold_last_30_days").alias("sales_last_30_days"))
    return (
        performance.join(stock, "product_id", "left")
        .join(recent, "product_id", "left")
        .select(
            "product_id",
            "category",
            "units_sold",
            "revenue",
            "average_discount",
            "average_price",
            "return_rate",
            "sales_last_30_days",
            "sales_last_90_days",
            half_up(growth, 4).alias("rolling_sales_growth"),
            F.lit(None).cast("string").alias("product_features_gap"),
        )
    )


def change_between(value: Column, period: Column, before: Column, after: Column) -> Column:
    """Relative change of a group's total from one period to another, four digits.

    An aggregate: both periods are summed in the same pass, so no self join is needed.
    """
    first = F.sum(F.when(period == before, value))
    second = F.sum(F.when(period == after, value))
    return half_up(ratio(second - first, first), 4)


def store_features(performance: DataFrame, daily: DataFrame, as_of: Column) -> DataFrame:
    """Daily average over all days, and growth between the last two complete months.

    Customer growth compares sums of daily distinct customers, as the daily table has them.
    """
    last = previous_month(as_of)
    month = month_of("date")
    exact = F.col("revenue").cast("decimal(18,2)")
    trends = daily.groupBy("store_id").agg(
        half_up(ratio(F.sum(exact), F.count("revenue")), 2).alias("average_daily_sales"),
        change_between(exact, month, F.add_months(last, -1), last).alias("sales_growth"),
        change_between(F.col("customers"), month, F.add_months(last, -1), last).alias("customer_growth"),
    )
    return performance.join(trends, "store_id", "left").select(
        "store_id",
        "city",
        "orders",
        "customers",
        "revenue",
        "average_order_value",
        "return_rate",
        "average_daily_sales",
        "sales_growth",
        "customer_growth",
    )
