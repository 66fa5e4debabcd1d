from frames import by, d

from shoptally.operators import analytics, features, serving, views

MONTHLY = "month string, orders bigint, customers bigint, units_sold bigint, revenue double, average_order_value double"
HEALTH = "product_id bigint, estimated_days_to_stockout double, risk_level string"


def monthly(spark, *rows):
    return spark.createDataFrame(list(rows), MONTHLY)


def test_overview(spark, retail):
    rows = monthly(spark, ("2024-01", 2, 1, 5, 10.1, 5.05), ("2024-02", 1, 1, 5, 20.2, 20.2))
    row = serving.overview(rows, retail.customers).first()
    assert (row.total_revenue, row.total_orders, row.total_customers) == (30.3, 3, 5)
    assert row.average_order_value == 10.1
    empty = serving.overview(monthly(spark), retail.customers).first()
    assert (empty.average_order_value, empty.total_customers) == (None, 5)


def test_customers_sample(retail):
    summary = analytics.customer_summary(retail.customers, retail.orders, retail.order_items, retail.as_of)
    rows = serving.customers_sample(summary, features.customer_features(summary), 2)
    assert sorted(r.customer_id for r in rows.collect()) == [1, 2]
    assert {r.total_customers for r in rows.collect()} == {5}


def test_month_over_month_and_alerts(spark):
    rows = monthly(
        spark, ("2024-01", 9, 9, 9, 9.0, 1.0), ("2024-02", 0, 4, 5, 100.0, 50.0), ("2024-03", 2, 3, 5, 125.0, 25.0)
    )
    changes = serving.month_over_month(rows)
    found = by(changes, "kpi")
    assert found["revenue"]["change_pct"] == 25.0
    assert found["orders"]["change_pct"] is None  # from zero
    assert found["customers"]["change_pct"] == -25.0
    messages = {r.alert: r.message for r in serving.alerts(changes).collect()}
    assert messages == {
        "Revenue": "Revenue increased 25.0% vs previous month.",
        "Orders": "Orders are stable.",
        "AOV": "AOV decreased 50.0% vs previous month.",
        "Inventory": "Inventory health is stable across products.",
    }


def test_one_month_has_no_change(spark):
    changes = serving.month_over_month(monthly(spark, ("2024-01", 9, 9, 9, 9.0, 1.0)))
    assert {r.change_pct for r in changes.collect()} == {None}


def test_rollups(retail):
    stores = analytics.store_performance(retail.stores, retail.orders, retail.order_items, retail.returns)
    cities = [r.city for r in serving.revenue_by_city(stores).collect()]
    assert cities == ["South", "North", "East"]
    ranked = [r.revenue for r in serving.store_ranking(stores).collect()]
    assert ranked == sorted(ranked, reverse=True)
    daily = analytics.daily_sales(retail.orders, retail.order_items, retail.stores)
    months = by(serving.monthly_revenue_by_city(daily, retail.as_of), "month", "city")
    assert months["2024-04", "South"]["revenue"] == 80.0
    assert months["2024-03", "East"]["revenue"] == 0.0
    assert not any(month == "2024-05" for month, _ in months)
    assert by(serving.daily_revenue(daily), "date")[d("2024-02-03")]["revenue"] == 29.0


def test_focus_against_others(retail):
    monthly_revenue = views.monthly_revenue_by_city(retail.orders, retail.order_items, retail.stores)
    rows = by(serving.focus_vs_others(monthly_revenue, "North"), "month")
    assert (rows[d("2024-02-01")]["focus_revenue"], rows[d("2024-02-01")]["others_mean_revenue"]) == (29.0, 24.0)
    assert rows[d("2024-05-01")]["focus_revenue"] is None


def test_top_products_break_ties_by_key(spark):
    df = spark.createDataFrame([(i, "c", float(i // 2)) for i in range(30)], "product_id bigint, category string, revenue double")
    assert [r.product_id for r in serving.top_products(df, "revenue", 3).collect()] == [28, 29, 26]
    assert serving.top_products(df, "revenue").count() == 10
    shares = serving.revenue_by_category(df).first()
    assert (shares.revenue, shares.share) == (210.0, 1.0)


def test_risk_bands_are_all_listed_in_order(spark):
    health = spark.createDataFrame([(1, 3.0, "Critical"), (2, None, "Low"), (3, None, "Low")], HEALTH)
    rows = [(r.position, r.risk_level, r.products) for r in serving.risk_distribution(health).orderBy("position").collect()]
    assert rows == [(1, "Critical", 1), (2, "High", 0), (3, "Medium", 0), (4, "Low", 2)]


def test_closest_to_stockout_puts_unknown_last(spark):
    health = spark.createDataFrame([(1, None, "Low"), (2, 9.0, "High"), (3, 2.0, "Critical"), (4, 9.0, "High")], HEALTH)
    assert [r.product_id for r in serving.closest_to_stockout(health, 4).collect()] == [3, 2, 4, 1]
