"""What the dashboard pages and their API payloads show, computed from the built tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoptally.functions.calendar import month_label, month_of
from shoptally.functions.frames import series
from shoptally.functions.numeric import half_up, money, ratio

RISK_ORDER = ("Critical", "High", "Medium", "Low")
KPIS = ("revenue", "orders", "customers", "average_order_value")
ALERTS = {"revenue": "Revenue", "orders": "Orders", "average_order_value": "AOV"}


def _exact(column: str) -> Column:
    """Published money back as DECIMAL, so that sums do not depend on their order."""
    return F.col(column).cast("decimal(20,2)")


def overview(monthly: DataFrame, customers: DataFrame) -> DataFrame:
    """Totals over complete months; customers include those who never bought."""
    headcount = customers.agg(F.count(F.lit(1))).scalar()
    return monthly.agg(
        money(F.sum(_exact("revenue"))).alias("total_revenue"), F.sum("orders").alias("total_orders")
    ).select(
        "total_revenue",
        "total_orders",
        headcount.alias("total_customers"),
        half_up(ratio(F.col("total_revenue"), F.col("total_orders")), 4).alias("average_order_value"),
    )


def customers_sample(
    summary: DataFrame, features: DataFrame, sample_size: int = 20, total: Column | None = None
) -> DataFrame:
    """Total customer count next to the first customers of both tables, by customer_id.

    Where the tables hold no more than these customers, ``total`` says how many there are.
    """
    total = summary.agg(F.count(F.lit(1))).scalar() if total is None else total
    first = summary.orderBy("customer_id").limit(sample_size)
    extra = [c for c in features.columns if c not in summary.columns]
    return first.join(features.select("customer_id", *extra), "customer_id", "left").withColumn(
        "total_customers", total
    )


def first_customers(
    customers: DataFrame, orders: DataFrame, order_items: DataFrame, sample_size: int = 20
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The first customers by id, with their orders and lines alone."""
    first = customers.orderBy("customer_id").limit(sample_size)
    theirs = orders.join(first.select("customer_id"), "customer_id", "left_semi")
    return first, theirs, order_items.join(theirs.select("order_id"), "order_id", "left_semi")


def month_over_month(monthly: DataFrame) -> DataFrame:
    """Latest month against the row before it, one row per KPI; null without a usable prior."""
    order = series([], "month")
    cells = [
        F.struct(
            F.lit(kpi).alias("kpi"),
            F.col(kpi).cast("double").alias("current"),
            F.lag(F.col(kpi).cast("double")).over(order).alias("previous"),
        )
        for kpi in KPIS
    ]
    latest = monthly.select(F.array(*cells).alias("cells"), F.lead("month").over(order).alias("next")).where(
        F.col("next").isNull()
    )
    return latest.select(F.inline("cells")).withColumn(
        "change_pct", half_up(ratio(F.lit(100.0) * (F.col("current") - F.col("previous")), F.col("previous")), 4)
    )


def alerts(changes: DataFrame) -> DataFrame:
    """One sentence per alert card.  The inventory sentence is constant."""
    change, label = F.col("change_pct"), F.col("alert")
    still = F.concat(label, F.when(label == "Orders", " are").otherwise(" is"), F.lit(" stable."))
    direction = F.when(change >= 0, "increased").otherwise("decreased")
    moved = F.format_string("%s %s %.1f%% vs previous month.", label, direction, half_up(F.abs(change), 1))
    names = F.create_map(*[F.lit(x) for kpi, name in ALERTS.items() for x in (kpi, name)])
    cards = (
        changes.where(F.col("kpi").isin(*ALERTS))
        .withColumn("alert", names[F.col("kpi")])
        .select("alert", F.when(change.isNull(), still).otherwise(moved).alias("message"))
    )
    stock = changes.sparkSession.range(1).select(
        F.lit("Inventory").alias("alert"), F.lit("Inventory health is stable across products.").alias("message")
    )
    return cards.unionByName(stock)


def revenue_by_city(performance: DataFrame) -> DataFrame:
    return (
        performance.groupBy("city")
        .agg(money(F.sum(_exact("revenue"))).alias("revenue"))
        .orderBy(F.col("revenue").desc(), "city")
    )


def store_ranking(performance: DataFrame) -> DataFrame:
    return performance.orderBy(F.col("revenue").desc(), "store_id")


def monthly_revenue_by_city(daily: DataFrame, as_of: Column) -> DataFrame:
    """From the daily table, complete months only."""
    return (
        daily.groupBy(month_of("date").alias("m"), "city")
        .agg(money(F.sum(_exact("revenue"))).alias("revenue"))
        .where(F.col("m") != month_of(as_of))
        .select(month_label("m").alias("month"), "city", "revenue")
    )


def daily_revenue(daily: DataFrame) -> DataFrame:
    return daily.groupBy("date").agg(money(F.sum(_exact("revenue"))).alias("revenue"))


def focus_vs_others(revenue_by_city: DataFrame, city: str) -> DataFrame:
    """Monthly revenue of one city against the mean of the others."""
    focus = F.col("city") == city
    return revenue_by_city.groupBy("month").agg(
        F.sum(F.when(focus, F.col("revenue"))).alias("focus_revenue"),
        half_up(
            ratio(F.sum(F.when(~focus, _exact("revenue"))), F.count(F.when(~focus, F.col("revenue")))), 2
        ).alias("others_mean_revenue"),
    )


def top_products(performance: DataFrame, by: str, k: int = 10) -> DataFrame:
    return performance.orderBy(F.col(by).desc_nulls_last(), "product_id").limit(k)


def revenue_by_category(performance: DataFrame) -> DataFrame:
    totals = performance.groupBy("category").agg(F.sum(_exact("revenue")).alias("total"))
    everything = totals.agg(F.sum("total")).scalar()
    return totals.select(
        "category",
        money(F.col("total")).alias("revenue"),
        half_up(ratio(F.col("total"), everything), 4).alias("share"),
    ).orderBy(F.col("revenue").desc(), "category")


def risk_distribution(health: DataFrame) -> DataFrame:
    """Products per risk band, in fixed order, bands without products included."""
    counts = health.agg(*[F.count_if(F.col("risk_level") == band).alias(band) for band in RISK_ORDER])
    rows = [
        F.struct(F.lit(i).alias("position"), F.lit(band).alias("risk_level"), F.col(band).alias("products"))
        for i, band in enumerate(RISK_ORDER, start=1)
    ]
    return counts.select(F.inline(F.array(*rows)))


def closest_to_stockout(health: DataFrame, k: int = 10) -> DataFrame:
    return health.orderBy(F.col("estimated_days_to_stockout").asc_nulls_last(), "product_id").limit(k)
