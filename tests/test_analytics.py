from datetime import timedelta
from decimal import Decimal as D

import pytest
from frames import BASE, by, d, small_retail, with_row
from pyspark.sql import functions as F

from shoptally.functions.calendar import previous_month
from shoptally.operators import analytics, facts


def daily(r):
    return analytics.daily_sales(r.orders, r.order_items, r.stores)


def sales(r, by_month=False):
    return analytics.product_sales(r.orders, r.order_items, r.products, by_month)


def monthly_products(r):
    first = r.orders.agg(F.min("order_date")).scalar()
    return analytics.product_monthly_sales(r.products, sales(r, True), r.returns, first, previous_month(r.as_of))


def test_customer_summary(retail):
    rows = by(analytics.customer_summary(retail.customers, retail.orders, retail.order_items, retail.as_of), "customer_id")
    ann, di, ed = rows[1], rows[4], rows[5]
    assert (ann["total_orders"], ann["total_items"], ann["total_spent"]) == (4, 20, 166.0)
    assert ann["average_order_value"] == 41.5
    assert (ann["first_order_date"], ann["last_order_date"]) == (d("2024-01-05"), d("2024-04-10"))
    assert (ann["days_since_last_purchase"], ann["lifetime_days"], ann["is_active"]) == (22, 122, True)
    for nobody in (di, ed):
        assert (nobody["total_orders"], nobody["total_items"], nobody["total_spent"]) == (0, 0, 0.0)
        assert nobody["first_order_date"] is None and nobody["days_since_last_purchase"] is None
        assert nobody["average_order_value"] == 0.0 and nobody["is_active"] is False
    assert rows[2]["total_orders"] == 3  # an order without lines is an order


def test_activity_ends_after_ninety_days(spark):
    orders = [(1, 1, 10, d("2024-01-05"), "online", "completed"), (2, 2, 10, d("2024-01-06"), "online", "completed")]
    r = small_retail(spark, orders=orders)
    as_of = F.lit(d("2024-01-05") + timedelta(days=91))
    rows = by(analytics.customer_summary(r.customers, r.orders, r.order_items, as_of), "customer_id")
    assert rows[1]["is_active"] is False
    assert rows[2]["is_active"] is True


def test_daily_sales_has_every_store_and_day(retail):
    rows = by(daily(retail), "store_id", "date")
    assert len(rows) == 4 * ((d("2024-05-02") - d("2024-01-05")).days + 1)
    busy = rows[11, d("2024-02-03")]
    assert (busy["orders"], busy["customers"], busy["units_sold"], busy["revenue"]) == (2, 2, 11, 29.0)
    assert busy["average_order_value"] == 14.5
    cancelled = rows[20, d("2024-04-11")]
    assert (cancelled["orders"], cancelled["customers"], cancelled["revenue"], cancelled["cancelled_orders"]) == (0, 0, 0.0, 1)
    empty = rows[30, d("2024-03-03")]
    assert (empty["orders"], empty["units_sold"], empty["average_order_value"]) == (0, 0, 0.0)


def test_monthly_sales_leaves_out_the_partial_month(retail):
    rows = by(analytics.monthly_sales(daily(retail), retail.orders, retail.as_of), "month")
    assert list(sorted(rows)) == ["2024-01", "2024-02", "2024-03", "2024-04"]
    assert rows["2024-01"]["customers"] == 1  # two orders on different days, one customer
    assert (rows["2024-03"]["orders"], rows["2024-03"]["revenue"]) == (1, 0.0)
    assert rows["2024-04"]["average_order_value"] == 44.0


def test_product_performance(retail):
    rows = by(analytics.product_performance(retail.products, sales(retail), retail.returns), "product_id")
    lamp, pen, safe = rows[100], rows[102], rows[103]
    assert (lamp["units_sold"], lamp["revenue"]) == (7, 63.0)
    assert lamp["average_price"] == 9.25  # mean of lines, not weighted by quantity
    assert lamp["average_discount"] == 0.15  # of the two discounted lines
    assert lamp["return_rate"] == round(1 / 7, 4)
    assert pen["average_discount"] == 0.0
    assert (safe["units_sold"], safe["average_price"], safe["return_rate"]) == (0, None, 0.0)
    assert rows[101]["return_rate"] == round(1 / 3, 4)  # returns of cancelled orders count


def test_a_carried_discount_replaces_the_list_price(retail):
    items = retail.order_items.withColumn("discount_pct", F.lit(D("0.05")).cast("decimal(4,2)"))
    measures = analytics.product_sales(retail.orders, items, retail.products)
    rows = by(analytics.product_performance(retail.products, measures, retail.returns), "product_id")
    assert rows[100]["average_discount"] == 0.05
    assert rows[100]["average_price"] == 9.25


def test_finer_sales_give_the_same_performance(retail):
    coarse = analytics.product_performance(retail.products, sales(retail), retail.returns)
    fine = analytics.product_performance(retail.products, sales(retail, True), retail.returns)
    assert by(coarse, "product_id") == by(fine, "product_id")


def test_product_months_are_complete(retail):
    rows = by(monthly_products(retail), "product_id", "month")
    assert len(rows) == 4 * 4
    assert rows[100, "2024-01"]["returns"] == 1 and rows[102, "2024-01"]["returns"] == 0
    assert rows[102, "2024-02"]["returns"] == 1  # counted in the month it came back
    quiet = rows[103, "2024-02"]
    assert (quiet["units_sold"], quiet["revenue"], quiet["average_price"], quiet["average_discount"]) == (0, 0.0, None, None)
    assert quiet["return_rate"] == 0.0
    assert rows[100, "2024-02"]["average_discount"] == 0.15


def test_store_performance(retail):
    rows = by(
        analytics.store_performance(retail.stores, retail.orders, retail.order_items, retail.returns), "store_id"
    )
    assert (rows[10]["orders"], rows[10]["customers"], rows[10]["revenue"]) == (3, 2, 74.0)
    assert rows[10]["return_rate"] == round(1 / 3, 4)  # two returns of one order
    assert rows[20]["return_rate"] == round(1 / 3, 4)  # the cancelled order was returned
    assert (rows[30]["orders"], rows[30]["average_order_value"], rows[30]["return_rate"]) == (0, 0.0, 0.0)


@pytest.mark.parametrize(
    ("stock", "days_left", "band"),
    [(0, None, "Critical"), (0, 50.0, "Critical"), (5, None, "Low"), (5, 7.0, "Critical"), (5, 7.1, "High"),
     (5, 14.0, "High"), (5, 14.1, "Medium"), (5, 30.0, "Medium"), (5, 30.1, "Low")],
)
def test_risk_bands(spark, stock, days_left, band):
    row = spark.createDataFrame([(stock, days_left)], "stock bigint, days double")
    assert row.select(analytics.risk_level(F.col("stock"), F.col("days"))).first()[0] == band


def health(r):
    return by(
        analytics.inventory_health(r.products, r.inventory, r.orders, r.order_items, r.as_of, r.latest_snapshot),
        "product_id",
    )


def test_inventory_health(retail):
    rows = health(retail)
    assert (rows[100]["current_stock"], rows[100]["units_sold_last_30_days"]) == (3, 1)
    assert rows[100]["estimated_days_to_stockout"] == 90.0
    assert rows[101]["risk_level"] == "Critical"  # stocked at zero
    assert rows[103]["risk_level"] == "Critical"  # never stocked
    assert rows[102]["estimated_days_to_stockout"] == 375.0


def test_thirty_days_are_strict(spark):
    r = small_retail(spark, orders=with_row("orders", 5, order_date=d("2024-04-02")))  # exactly 30 days before
    assert health(r)[101]["units_sold_last_30_days"] == 0


def campaigns(r):
    return by(analytics.marketing_performance(r.marketing_campaigns, r.orders, r.order_items, r.stores), "campaign_id")


def test_campaign_window_includes_both_ends_and_overlaps_count_twice(retail):
    rows = campaigns(retail)
    assert (rows[1]["orders_generated"], rows[1]["revenue_generated"]) == (4, 37.0)
    assert rows[1]["roi"] == 2.7
    assert (rows[2]["orders_generated"], rows[2]["revenue_generated"]) == (3, 65.0)
    assert rows[3]["orders_generated"] == 3 and rows[3]["roi"] == 0.0  # free campaign
    for nothing in (4, 5, 6):
        assert (rows[nothing]["orders_generated"], rows[nothing]["revenue_generated"]) == (0, 0.0)
        assert rows[nothing]["roi"] == -1.0


def test_campaigns_match_a_brute_force_count(spark):
    spans = [(i, d("2024-01-01") + timedelta(days=i), d("2024-01-01") + timedelta(days=i + length))
             for length in (0, 1, 30, 200) for i in range(0, 130, 7)]
    rows = [(n, "c", "North", "tv", lo, hi, D("1.00"), D("1.00")) for n, (_, lo, hi) in enumerate(spans)]
    found = campaigns(small_retail(spark, marketing_campaigns=rows))
    done = [o for o in BASE["orders"] if o[5] == "completed" and o[2] in (10, 11)]
    for n, (_, lo, hi) in enumerate(spans):
        assert found[n]["orders_generated"] == sum(lo <= o[3] <= hi for o in done), (lo, hi)


def test_a_reversed_campaign_window_is_empty(spark):
    rows = [(1, "c", "North", "tv", d("2024-04-28"), d("2024-01-01"), D("1.00"), D("1.00"))]
    assert campaigns(small_retail(spark, marketing_campaigns=rows))[1]["orders_generated"] == 0


def test_returns_summary(retail):
    rows = by(analytics.returns_summary(retail.products, retail.returns, sales(retail)), "product_id")
    assert (rows[100]["returns"], rows[100]["units_sold"], rows[100]["return_rate"]) == (1, 7, round(1 / 7, 4))
    assert rows[103]["return_rate"] == 0.0


def test_revenue_agrees_across_tables(retail):
    stores = analytics.store_performance(retail.stores, retail.orders, retail.order_items, retail.returns)
    products = analytics.product_performance(retail.products, sales(retail), retail.returns)
    total = stores.agg(F.sum("revenue")).first()[0]
    assert total == products.agg(F.sum("revenue")).first()[0] == daily(retail).agg(F.sum("revenue")).first()[0]
    monthly = analytics.monthly_sales(daily(retail), retail.orders, retail.as_of)
    assert total - monthly.agg(F.sum("revenue")).first()[0] == 10.0  # the partial month


def test_totals_can_stand_in_for_lines(retail):
    totals = facts.order_totals(retail.order_items)
    from_lines = by(daily(retail), "store_id", "date")
    assert by(analytics.daily_sales(retail.orders, totals, retail.stores), "store_id", "date") == from_lines


def test_empty_tables(spark):
    r = small_retail(spark, orders=[], order_items=[], returns=[], inventory=[])
    assert daily(r).count() == 0
    assert analytics.monthly_sales(daily(r), r.orders, r.as_of).count() == 0
    assert by(analytics.store_performance(r.stores, r.orders, r.order_items, r.returns), "store_id")[10]["orders"] == 0
    assert by(analytics.product_performance(r.products, sales(r), r.returns), "product_id")[100]["units_sold"] == 0
    assert monthly_products(r).count() == 0
    assert health(r)[100]["risk_level"] == "Critical"
    assert campaigns(r)[1]["orders_generated"] == 0
    summary = by(analytics.customer_summary(r.customers, r.orders, r.order_items, r.as_of), "customer_id")
    assert summary[1]["lifetime_days"] is None and summary[1]["is_active"] is False
