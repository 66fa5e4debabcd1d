import pytest
from frames import by, d
from published import FEATURES, MONTHLY_SALES
from pyspark.sql import functions as F

from shoptally.functions.calendar import previous_month
from shoptally.operators import analytics, features

MONTHLY = "month string, orders bigint, customers bigint, units_sold bigint, revenue double, average_order_value double"


def test_forecasting_features_reproduce_published_values(spark):
    rows = by(features.sales_forecasting_features(spark.createDataFrame(MONTHLY_SALES, MONTHLY)), "month")
    assert len(rows) == 18
    names = (
        "rolling_mean_3", "rolling_mean_6", "rolling_std_3", "revenue_growth_rate", "moving_average_difference",
        "seasonal_index",
    )
    for month, values in FEATURES.items():
        for name, value in zip(names, values):
            assert rows[month][name] == (value if value is None else pytest.approx(value, rel=1e-9)), (month, name)
    june = rows["2026-06"]
    assert (june["lag_1_revenue"], june["lag_2_revenue"], june["lag_3_revenue"]) == (1149116.8, 1237153.01, 1200439.21)
    assert (june["month_number"], june["quarter"], june["year"]) == (6, 2, 2026)


def test_series_do_not_mix(spark):
    one = spark.createDataFrame(MONTHLY_SALES, MONTHLY)
    both = one.withColumn("city", F.lit("a")).unionByName(one.withColumn("city", F.lit("b")).withColumn("revenue", F.lit(1.0)))
    rows = by(features.sales_forecasting_features(both, ["city"]), "city", "month")
    assert rows["a", "2025-07"]["rolling_mean_6"] == pytest.approx(FEATURES["2025-07"][1])
    assert rows["b", "2025-01"]["lag_1_revenue"] is None and rows["b", "2025-01"]["seasonal_index"] == 1.0


def test_customer_features(retail):
    summary = analytics.customer_summary(retail.customers, retail.orders, retail.order_items, retail.as_of)
    rows = by(features.customer_features(summary), "customer_id")
    ann, cy, di = rows[1], rows[3], rows[4]
    assert ann["purchase_frequency"] == round(4 / (122 / 30), 4)
    assert ann["average_days_between_orders"] == 32.0
    assert (ann["recency"], ann["frequency"], ann["monetary"]) == (22, 4, 166.0)
    assert cy["average_days_between_orders"] == 77.0
    assert di["purchase_frequency"] == 0.0
    assert di["average_days_between_orders"] is None and di["recency"] is None


def test_one_order_has_no_gap_and_no_lifetime_no_frequency(spark):
    day = d("2024-01-05")
    columns = (
        "customer_id bigint, signup_date date, first_order_date date, last_order_date date, total_orders bigint, "
        "total_items bigint, total_spent double, average_order_value double, days_since_last_purchase int, "
        "lifetime_days int, is_active boolean"
    )
    summary = spark.createDataFrame([(1, day, day, day, 1, 1, 5.0, 5.0, 0, 0, True)], columns)
    row = features.customer_features(summary).first()
    assert row.average_days_between_orders is None
    assert row.purchase_frequency is None


def test_product_features(retail):
    sales = analytics.product_sales(retail.orders, retail.order_items, retail.products)
    by_month = analytics.product_sales(retail.orders, retail.order_items, retail.products, by_month=True)
    performance = analytics.product_performance(retail.products, sales, retail.returns)
    stock = analytics.inventory_health(
        retail.products, retail.inventory, retail.orders, retail.order_items, retail.as_of, retail.latest_snapshot
    )
    last = previous_month(retail.as_of)
    monthly = analytics.product_monthly_sales(
        retail.products, by_month, retail.returns, F.add_months(last, -2), last
    )
    rows = by(features.product_features(performance, stock, monthly, retail.as_of), "product_id")
    assert rows[100]["sales_last_90_days"] == 4  # February to April
    assert rows[102]["sales_last_90_days"] == 14
    assert rows[100]["sales_last_30_days"] == 1  # counts the partial month's order
    assert rows[101]["rolling_sales_growth"] is None  # nothing sold in March
    assert rows[100]["product_features_gap"] is None


def test_growth_is_month_over_month(spark):
    change = features.change_between(F.col("v"), F.col("m"), F.lit("a"), F.lit("b"))
    rows = spark.createDataFrame([("a", 8.0), ("b", 5.0), ("b", 5.0), ("c", 99.0)], "m string, v double")
    assert rows.agg(change).first()[0] == 0.25


def test_store_features(retail):
    daily = analytics.daily_sales(retail.orders, retail.order_items, retail.stores)
    performance = analytics.store_performance(retail.stores, retail.orders, retail.order_items, retail.returns)
    rows = by(features.store_features(performance, daily, retail.as_of), "store_id")
    assert rows[10]["average_daily_sales"] == round(74 / 119, 2)  # every day counts, sold or not
    assert rows[10]["sales_growth"] is None  # nothing in March
    assert rows[11]["customer_growth"] == -1.0
    assert rows[30]["sales_growth"] is None
