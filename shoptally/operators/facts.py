"""Order-grain facts that most operators start from.

Lines are summed per order before they meet the orders (map-side combined, so an order with
very many lines is no hot spot) and both sides of the join then hold one row per order_id.
`order_id`, `customer_id`, `product_id` and `store_id` are the declared primary keys; the
quality checks report where data break them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoptally.functions.calendar import month_of
from shoptally.sources.schemas import COMPLETED


def completed(orders: DataFrame) -> DataFrame:
    return orders.where(F.col("order_status") == COMPLETED)


def order_totals(order_items: DataFrame) -> DataFrame:
    """order_id, units, revenue (DECIMAL) of every order that has lines.

    Totals that were built before (and perhaps written) pass through, so wherever an operator
    takes order items it takes their totals as well.
    """
    if set(order_items.columns) == {"order_id", "units", "revenue"}:
        return order_items
    return order_items.groupBy("order_id").agg(
        F.sum("quantity").alias("units"), F.sum("line_total").alias("revenue")
    )


def sold_orders(orders: DataFrame, order_items: DataFrame) -> DataFrame:
    """Completed orders with at least one line."""
    return completed(orders).join(order_totals(order_items), "order_id")


def order_facts(orders: DataFrame, order_items: DataFrame) -> DataFrame:
    """Every order, with the totals of the completed ones; null totals elsewhere."""
    totals = order_totals(order_items).withColumnRenamed("order_id", "line_order_id")
    matched = (F.col("order_id") == F.col("line_order_id")) & (F.col("order_status") == COMPLETED)
    return orders.join(totals, matched, "left").drop("line_order_id")


def sold_lines(orders: DataFrame, order_items: DataFrame) -> DataFrame:
    """Lines of completed orders with the order's date (and store, if the orders carry it)."""
    header = completed(orders).select(
        "order_id", "order_date", *[c for c in ("store_id",) if c in orders.columns]
    )
    return order_items.join(header, "order_id")


def store_month_revenue(orders: DataFrame, order_items: DataFrame) -> DataFrame:
    """store_id, month, order_count, revenue (DECIMAL) of completed orders with lines."""
    return (
        sold_orders(orders, order_items)
        .groupBy("store_id", month_of("order_date").alias("month"))
        .agg(F.count(F.lit(1)).alias("order_count"), F.sum("revenue").alias("revenue"))
    )


def city_of(stores: DataFrame) -> DataFrame:
    return stores.select("store_id", "city")
