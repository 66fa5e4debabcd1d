"""The analytics layer: one gap-free or entity-complete table per business question.

The reference date (`as_of`) is a parameter, usually `max(order_date)` over all orders; its
month is incomplete and left out of monthly tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shoptally.functions.calendar import (
    date_bounds,
    days,
    latest_date,
    month_label,
    month_of,
    months,
)
from shoptally.functions.frames import dealt, series
from shoptally.functions.numeric import (
    count_or_zero,
    half_up,
    money,
    money_or_zero,
    ratio,
    ratio_or_zero,
    sum_or_zero,
)
from shoptally.operators.facts import (
    city_of,
    completed,
    order_facts,
    order_totals,
    sold_lines,
)
from shoptally.sources.schemas import CANCELLED, COMPLETED

ACTIVE_DAYS = 90
RECENT_DAYS = 30
DISCOUNT_EPSILON = 1e-6
# Upper bounds, in days of cover, of the risk bands (fixed values).
RISK_BANDS = ((7, "Critical"), (14, "High"), (30, "Medium"))


def customer_summary(customers: DataFrame, orders: DataFrame, order_items: DataFrame, as_of: Column) -> DataFrame:
    """One row per customer, buyers or not; completed orders only."""
    bought = (
        completed(orders)
        .join(order_totals(order_items), "order_id", "left")
        .groupBy("customer_id")
        .agg(
            F.min("order_date").alias("first_order_date"),
            F.max("order_date").alias("last_order_date"),
            F.count(F.lit(1)).alias("total_orders"),
            F.sum("units").alias("total_items"),
            F.sum("revenue").alias("spent"),
        )
    )
    spent = F.col("spent")
    since = F.datediff(as_of, F.col("last_order_date"))
    return (
        customers.select("customer_id", "signup_date")
        .join(bought, "customer_id", "left")
        .select(
            "customer_id",
            "signup_date",
            "first_order_date",
            "last_order_date",
            count_or_zero("total_orders"),
            count_or_zero("total_items"),
            money_or_zero(spent).alias("total_spent"),
            ratio_or_zero(spent, F.col("total_orders"), 2).alias("average_order_value"),
            since.alias("days_since_last_purchase"),
            F.datediff(as_of, F.col("signup_date")).alias("lifetime_days"),
            F.coalesce(since <= ACTIVE_DAYS, F.lit(False)).alias("is_active"),
        )
    )


def daily_sales(orders: DataFrame, order_items: DataFrame, stores: DataFrame) -> DataFrame:
    """One row per store and day from the first to the last order of any status.

    Orders are reduced to (store, day, customer) first: customers per day is then a plain
    count, and a store or customer with most of the orders is combined before it is shuffled.
    """
    done = F.col("order_status") == COMPLETED
    per_customer = (
        order_facts(orders, order_items)
        .groupBy("store_id", "order_date", "customer_id")
        .agg(
            F.count_if(done).alias("orders"),
            F.count_if(F.col("order_status") == CANCELLED).alias("cancelled"),
            F.sum("units").alias("units"),
            F.sum("revenue").alias("revenue"),
        )
    )
    per_day = per_customer.groupBy("store_id", F.col("order_date").alias("date")).agg(
        F.sum("orders").alias("orders"),
        F.count_if(F.col("orders") > 0).alias("customers"),
        F.sum("units").alias("units_sold"),
        F.sum("revenue").alias("total"),
        F.sum("cancelled").alias("cancelled_orders"),
    )
    span = date_bounds(orders, "order_date")
    scaffold = city_of(stores).withColumn("date", F.explode(days(span["lo"], span["hi"])))
    total = F.col("total")
    return scaffold.join(per_day, ["store_id", "date"], "left").select(
        "date",
        "store_id",
        "city",
        count_or_zero("orders"),
        count_or_zero("customers"),
        count_or_zero("units_sold"),
        money_or_zero(total).alias("revenue"),
        ratio_or_zero(total, F.col("orders"), 2).alias("average_order_value"),
        count_or_zero("cancelled_orders"),
    )


def monthly_sales(daily: DataFrame, orders: DataFrame, as_of: Column) -> DataFrame:
    """Company totals per complete month.

    Additive measures come from the daily table; distinct customers do not add up and are
    counted again from the orders.
    """
    complete = F.col("month") != month_of(as_of)
    totals = daily.groupBy(month_of("date").alias("month")).agg(
        F.sum("orders").alias("orders"),
        F.sum("units_sold").alias("units_sold"),
        F.sum(F.col("revenue").cast("decimal(18,2)")).alias("total"),
    )
    buyers = (
        completed(orders)
        .groupBy(month_of("order_date").alias("month"))
        .agg(F.count_distinct("customer_id").alias("customers"))
    )
    return (
        totals.where(complete)
        .join(buyers.where(complete), "month", "left")
        .select(
            month_label("month").alias("month"),
            "orders",
            count_or_zero("customers"),
            "units_sold",
            money(F.col("total")).alias("revenue"),
            ratio_or_zero(F.col("total"), F.col("orders"), 2).alias("average_order_value"),
        )
    )


_MEASURES = ("units_sold", "total", "lines", "price_sum", "discounted", "discount_sum")


def product_sales(
    orders: DataFrame, order_items: DataFrame, products: DataFrame, by_month: bool = False
) -> DataFrame:
    """Additive sales measures of completed orders per product, or per product and month.

    units_sold, total, and what the line means need: lines with the sum of charged prices,
    discounted lines with the sum of their discounts.  If the lines carry no discount, it is
    measured against the list price; lines are then first combined per charged price, so the
    list price is joined to price points, not to lines.
    """
    lines = sold_lines(orders, order_items)
    keys = ["product_id"]
    if by_month:
        lines = lines.withColumn("month", month_of("order_date"))
        keys.append("month")
    price = F.col("unit_price")
    if "discount_pct" in order_items.columns:
        cut = F.when(F.col("discount_pct") > DISCOUNT_EPSILON, F.col("discount_pct"))
        return lines.groupBy(*keys).agg(
            F.sum("quantity").alias("units_sold"),
            F.sum("line_total").alias("total"),
            F.count(price).alias("lines"),
            F.sum(price).alias("price_sum"),
            F.count(cut).alias("discounted"),
            F.sum(cut).alias("discount_sum"),
        )
    points = lines.groupBy(*keys, "unit_price").agg(
        F.sum("quantity").alias("units_sold"), F.sum("line_total").alias("total"), F.count(price).alias("n")
    )
    lists = products.select("product_id", price.alias("list_price"))
    cut = 1 - ratio(price, F.col("list_price"))
    is_cut = cut > DISCOUNT_EPSILON
    return (
        points.join(lists, "product_id", "left")
        .groupBy(*keys)
        .agg(
            F.sum("units_sold").alias("units_sold"),
            F.sum("total").alias("total"),
            F.sum("n").alias("lines"),
            F.sum(price * F.col("n")).alias("price_sum"),
            F.sum(F.when(is_cut, F.col("n")).otherwise(0)).alias("discounted"),
            F.sum(F.when(is_cut, cut * F.col("n"))).alias("discount_sum"),
        )
    )


def product_performance(products: DataFrame, sales: DataFrame, returns: DataFrame) -> DataFrame:
    """One row per product, sold or not; every return counts as one unit, whatever the order's status.

    `sales` are the measures of `product_sales`, by product or finer.
    """
    per_product = sales.groupBy("product_id").agg(*[F.sum(m).alias(m) for m in _MEASURES])
    returned = returns.groupBy("product_id").agg(F.count(F.lit(1)).alias("returns"))
    return (
        products.select("product_id", "product_name", "category")
        .join(per_product, "product_id", "left")
        .join(returned, "product_id", "left")
        .select(
            "product_id",
            "product_name",
            "category",
            count_or_zero("units_sold"),
            money_or_zero(F.col("total")).alias("revenue"),
            ratio_or_zero(F.col("discount_sum"), F.col("discounted"), 4).alias("average_discount"),
            half_up(ratio(F.col("price_sum"), F.col("lines")), 2).alias("average_price"),
            ratio_or_zero(F.col("returns"), F.col("units_sold"), 4).alias("return_rate"),
        )
    )


def product_monthly_sales(
    products: DataFrame, sales: DataFrame, returns: DataFrame, first: Column, last: Column
) -> DataFrame:
    """One row per product and month from `first` to `last`; returns count in the month they come back.

    Sales (by product and month) and returns of a product become one short map from month to
    measures, at most one entry per calendar month, and the calendar is laid over it after the
    join.  So only product-grain rows are shuffled, not the product x month scaffold.
    """
    back = returns.groupBy("product_id", month_of("return_date").alias("month")).agg(
        F.count(F.lit(1)).alias("returns")
    )
    filled = (
        dealt(products.select("product_id", "product_name", "category"), "product_id")
        .join(_by_month(sales, "sales", *_MEASURES), "product_id", "left")
        .join(_by_month(back, "back", "returns"), "product_id", "left")
    )
    row = filled.withColumn("month", F.explode(months(first, last))).select(
        month_label("month").alias("month"),
        "product_id",
        "product_name",
        "category",
        F.try_element_at("sales", F.col("month")).alias("s"),
        sum_or_zero(F.try_element_at("back", F.col("month"))["returns"]).alias("returns"),
    )
    units = sum_or_zero(F.col("s.units_sold"))
    return row.select(
        "month",
        "product_id",
        "product_name",
        "category",
        units.alias("units_sold"),
        money_or_zero(F.col("s.total")).alias("revenue"),
        half_up(ratio(F.col("s.price_sum"), F.col("s.lines")), 2).alias("average_price"),
        half_up(ratio(F.col("s.discount_sum"), F.col("s.discounted")), 4).alias("average_discount"),
        "returns",
        ratio_or_zero(F.col("returns"), units, 4).alias("return_rate"),
    )


def _by_month(measures: DataFrame, name: str, *columns: str) -> DataFrame:
    entry = F.struct(F.col("month"), F.struct(*columns))
    return measures.groupBy("product_id").agg(F.map_from_entries(F.collect_list(entry)).alias(name))


def store_performance(
    stores: DataFrame, orders: DataFrame, order_items: DataFrame, returns: DataFrame
) -> DataFrame:
    """One row per store; return_rate is orders with a return (any status) per completed order."""
    done = F.col("order_status") == COMPLETED
    flagged = returns.select("order_id").distinct().withColumn("returned", F.lit(True))
    per_customer = (
        order_facts(orders, order_items)
        .join(flagged, "order_id", "left")
        .groupBy("store_id", "customer_id")
        .agg(
            F.count_if(done).alias("orders"),
            F.sum("revenue").alias("revenue"),
            F.count("returned").alias("returned"),
        )
    )
    per_store = per_customer.groupBy("store_id").agg(
        F.sum("orders").alias("orders"),
        F.count_if(F.col("orders") > 0).alias("customers"),
        F.sum("revenue").alias("total"),
        F.sum("returned").alias("returned"),
    )
    total = F.col("total")
    return (
        city_of(stores)
        .join(per_store, "store_id", "left")
        .select(
            "store_id",
            "city",
            count_or_zero("orders"),
            count_or_zero("customers"),
            money_or_zero(total).alias("revenue"),
            ratio_or_zero(total, F.col("orders"), 2).alias("average_order_value"),
            ratio_or_zero(F.col("returned"), F.col("orders"), 4).alias("return_rate"),
        )
    )


def risk_level(stock: Column, days_left: Column) -> Column:
    """Empty shelves are critical; stock that does not sell is no stock-out risk."""
    band = F.when(stock == 0, "Critical").when(days_left.isNull(), "Low")
    for limit, name in RISK_BANDS:
        band = band.when(days_left <= limit, name)
    return band.otherwise("Low")


def inventory_health(
    products: DataFrame,
    inventory: DataFrame,
    orders: DataFrame,
    order_items: DataFrame,
    as_of: Column,
    snapshot: Column,
) -> DataFrame:
    """Stock at the latest snapshot against the units sold in the 30 days up to `as_of`."""
    stock = (
        inventory.where(F.col("snapshot_date") == snapshot)
        .groupBy("product_id")
        .agg(F.sum("stock_level").alias("current_stock"))
    )
    recent_orders = orders.where(F.col("order_date") > F.date_sub(as_of, RECENT_DAYS))
    recent = (
        sold_lines(recent_orders, order_items)
        .groupBy("product_id")
        .agg(F.sum("quantity").alias("units_sold_last_30_days"))
    )
    per_day = F.col("units_sold_last_30_days") / RECENT_DAYS
    return (
        products.select("product_id", "product_name")
        .join(stock, "product_id", "left")
        .join(recent, "product_id", "left")
        .select(
            "product_id", "product_name", count_or_zero("current_stock"), count_or_zero("units_sold_last_30_days")
        )
        .withColumn("estimated_days_to_stockout", half_up(ratio(F.col("current_stock"), per_day), 1))
        .withColumn("risk_level", risk_level(F.col("current_stock"), F.col("estimated_days_to_stockout")))
    )


def marketing_performance(
    campaigns: DataFrame, orders: DataFrame, order_items: DataFrame, stores: DataFrame
) -> DataFrame:
    """Completed orders of a campaign's city from its start to its end day, both included.

    Overlapping campaigns each get the order.  Instead of matching orders to campaigns, orders
    become running totals per city and day; a campaign is then the difference of two of them,
    found by equality on (city, day).  No pair of order and campaign is ever formed.
    """
    per_store_day = (
        completed(orders)
        .join(order_totals(order_items), "order_id", "left")
        .groupBy("store_id", F.col("order_date").alias("day"))
        .agg(F.count(F.lit(1)).alias("orders"), F.sum("revenue").alias("revenue"))
    )
    per_city_day = (
        per_store_day.join(city_of(stores), "store_id")
        .groupBy("city", "day")
        .agg(F.sum("orders").alias("orders"), F.sum("revenue").alias("revenue"))
    )
    so_far = W.partitionBy("city").orderBy("day").rowsBetween(W.unboundedPreceding, W.currentRow)
    next_day = F.lead("day").over(series(["city"], "day"))
    running = per_city_day.select(
        "city",
        "day",
        next_day.alias("next_day"),
        F.sum("orders").over(so_far).alias("orders"),
        F.sum(sum_or_zero(F.col("revenue"))).over(so_far).alias("revenue"),
    )
    # A running total holds from its day to the day before the next one, the latest to the
    # end of the order calendar.  Laid out per day, every campaign date inside it has a row.
    last_day = latest_date(orders, "order_date")
    until = F.coalesce(F.date_sub("next_day", 1), last_day)
    held = running.withColumn("day", F.explode(days(F.col("day"), until))).drop("next_day")

    def at(date: Column, prefix: str) -> tuple[DataFrame, list[Column]]:
        totals = held.select(
            F.col("city").alias(f"{prefix}_city"),
            F.col("day").alias(f"{prefix}_day"),
            F.col("orders").alias(f"{prefix}_orders"),
            F.col("revenue").alias(f"{prefix}_revenue"),
        )
        return totals, [F.col("city_target") == F.col(f"{prefix}_city"), F.least(date, last_day) == F.col(f"{prefix}_day")]

    upto_end, on_end = at(F.col("end_date"), "end")
    upto_start, on_start = at(F.date_sub("start_date", 1), "start")
    runs = F.col("end_date") >= F.col("start_date")

    def gained(measure: str) -> Column:
        gain = sum_or_zero(F.col(f"end_{measure}")) - sum_or_zero(F.col(f"start_{measure}"))
        return F.when(runs, gain).otherwise(F.lit(0))

    spend = F.col("spend")
    return (
        campaigns.join(upto_end, on_end, "left")
        .join(upto_start, on_start, "left")
        .select(
            "campaign_id",
            "campaign_name",
            F.col("city_target").alias("city"),
            "start_date",
            "end_date",
            spend.cast("double").alias("marketing_spend"),
            gained("orders").cast("bigint").alias("orders_generated"),
            money(gained("revenue")).alias("revenue_generated"),
        )
        .withColumn(
            "roi",
            ratio_or_zero(
                F.col("revenue_generated") - F.col("marketing_spend"), F.col("marketing_spend"), 3
            ),
        )
    )



def returns_summary(products: DataFrame, returns: DataFrame, sales: DataFrame) -> DataFrame:
    """Returns against units sold per product; `sales` as for `product_performance`."""
    returned = returns.groupBy("product_id").agg(F.count(F.lit(1)).alias("returns"))
    sold = sales.groupBy("product_id").agg(F.sum("units_sold").alias("units_sold"))
    return (
        products.select("product_id", "category")
        .join(returned, "product_id", "left")
        .join(sold, "product_id", "left")
        .select(
            "product_id",
            "category",
            count_or_zero("returns"),
            count_or_zero("units_sold"),
            ratio_or_zero(F.col("returns"), F.col("units_sold"), 4).alias("return_rate"),
        )
    )
