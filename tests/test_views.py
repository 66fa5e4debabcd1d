from datetime import date

from frames import by, d, small_retail
from pyspark.sql import functions as F

from shoptally.functions.calendar import month_of
from shoptally.operators import views


def revenue(r):
    return views.monthly_revenue_by_city(r.orders, r.order_items, r.stores)


def test_revenue_counts_completed_orders_with_lines(retail):
    rows = by(revenue(retail), "city", "month")
    assert rows["North", d("2024-01-01")]["revenue"] == 66.0
    assert rows["North", d("2024-01-01")]["order_count"] == 2
    assert ("North", d("2024-03-01")) not in rows  # its only order has no lines
    assert rows["South", d("2024-04-01")] == {
        "city": "South", "month": d("2024-04-01"), "order_count": 1, "revenue": 80.0,
    }


def test_trend_takes_the_previous_row_not_the_previous_month(retail):
    rows = by(views.focus_revenue_trend(revenue(retail), "North"), "month")
    assert rows[d("2024-01-01")]["prev_month_revenue"] is None
    assert rows[d("2024-01-01")]["mom_pct_change"] is None
    assert rows[d("2024-04-01")]["prev_month_revenue"] == 29.0  # February
    assert rows[d("2024-04-01")]["mom_pct_change"] == -72.4


def test_change_from_zero_revenue_is_null(spark):
    monthly = spark.createDataFrame([("A", d("2024-01-01"), 0.0), ("A", d("2024-02-01"), 5.0)], "city string, month date, revenue double")
    rows = by(views.revenue_trend(monthly), "month")
    assert rows[d("2024-02-01")]["mom_pct_change"] is None


def test_expected_uses_up_to_three_earlier_months(spark):
    months = [date(2024, m, 1) for m in range(1, 7)]
    monthly = spark.createDataFrame(
        [("A", m, float(v)) for m, v in zip(months, (10, 20, 60, 90, 30, 1))], "city string, month date, revenue double"
    )
    rows = by(views.expected_vs_actual(monthly, "A", F.lit(d("2024-06-15"))), "month")
    assert d("2024-06-01") not in rows
    assert [rows[m]["expected_revenue_trailing_3mo"] for m in months[:5]] == [None, 10.0, 15.0, 30.0, 56.67]
    assert rows[d("2024-05-01")]["anomaly_amount"] == -26.67
    assert rows[d("2024-05-01")]["anomaly_pct"] == -47.1


def test_spend_is_booked_to_the_start_month(retail):
    rows = by(views.marketing_spend_by_city_month(retail.marketing_campaigns), "city", "month")
    assert rows["North", d("2024-02-01")]["total_spend"] == 10.0
    assert rows["South", d("2024-01-01")]["campaign_count"] == 1


def test_stockouts(retail):
    (row,) = views.stockout_indicators(retail.inventory, retail.stores, "North").collect()
    assert (row.zero_stock_snapshots, row.at_or_below_reorder_snapshots, row.total_snapshots) == (2, 2, 4)
    assert row.pct_snapshots_constrained == 50.0


def test_return_rate_by_order_month_without_fan_out(retail):
    rows = by(views.return_rate_by_city_month(retail.orders, retail.returns, retail.stores), "city", "month")
    assert rows["North", d("2024-01-01")]["return_count"] == 2
    assert rows["North", d("2024-01-01")]["return_rate_pct"] == 100.0
    assert rows["South", d("2024-04-01")]["return_count"] == 0  # the return was of a cancelled order
    assert rows["North", d("2024-03-01")]["order_count"] == 1  # orders without lines count here


def test_category_shares_add_up(retail):
    rows = views.category_revenue_by_city_month(retail.orders, retail.order_items, retail.products, retail.stores)
    january = {r.category: r for r in rows.collect() if (r.city, r.month) == ("North", d("2024-01-01"))}
    assert january["Home"].revenue == 56.0
    assert january["Home"].pct_of_city_month_revenue == 84.8
    assert january["Office"].pct_of_city_month_revenue == 15.2


def test_new_customers_are_new_everywhere_only_once(retail):
    rows = by(views.new_vs_returning_customers(retail.orders, retail.stores), "city", "month")
    assert rows["South", d("2024-04-01")]["new_customers"] == 0  # customer 1 started in the other city
    assert rows["South", d("2024-02-01")]["new_customers"] == 1
    for row in rows.values():
        assert row["new_customers"] + row["returning_customers"] == row["total_active_customers"]


def test_repeat_purchases(retail):
    rows = by(views.repeat_purchase_rate(retail.orders, retail.stores), "city", "month")
    assert rows["North", d("2024-01-01")]["repeat_purchase_rate_pct"] == 100.0
    assert rows["North", d("2024-02-01")]["repeat_customers"] == 0


def test_active_customers(retail):
    rows = by(views.monthly_active_customers_by_city(retail.orders, retail.stores), "city", "month")
    assert rows["North", d("2024-01-01")]["active_customers"] == 1
    assert rows["North", d("2024-02-01")]["active_customers"] == 2


def test_average_order_value(retail):
    rows = by(views.average_order_value(revenue(retail)), "city", "month")
    assert rows["North", d("2024-02-01")]["avg_order_value"] == 14.5


def test_retention_uses_the_calendar(spark):
    orders = [
        (1, 1, 10, d("2024-01-05"), "online", "completed"),
        (2, 2, 10, d("2024-01-06"), "online", "completed"),
        (3, 1, 10, d("2024-02-05"), "online", "completed"),
        (4, 1, 11, d("2024-02-06"), "online", "completed"),
        (5, 1, 10, d("2024-04-06"), "online", "completed"),  # March is missing
    ]
    r = small_retail(spark, orders=orders)
    rows = by(views.customer_retention(r.orders, r.stores, "North"), "month")
    assert set(rows) == {d("2024-01-01"), d("2024-02-01"), d("2024-04-01")}
    february, april = rows[d("2024-02-01")], rows[d("2024-04-01")]
    assert (february["active_prior_month"], february["retained_from_prior_month"]) == (2, 1)
    assert february["retention_rate_pct"] + february["churn_rate_pct"] == 100.0
    assert (april["active_prior_month"], april["retained_from_prior_month"]) == (0, 0)
    assert april["retention_rate_pct"] is None
    assert rows[d("2024-01-01")]["active_prior_month"] == 0


def test_cohorts(retail):
    rows = by(views.customer_cohorts(retail.customers, retail.orders), "city", "cohort_month", "month_offset")
    assert rows["North", d("2024-01-01"), 0]["cohort_size"] == 2
    assert rows["North", d("2024-01-01"), 0]["active_customers"] == 1
    assert rows["North", d("2024-01-01"), 3]["active_customers"] == 2
    assert rows["South", d("2024-02-01"), 0]["pct_of_cohort_active"] == 50.0  # one of two never bought
    assert not any(key[:2] == ("South", d("2024-03-01")) for key in rows)  # cancelled only


def test_cohort_offsets_stop_at_six(spark):
    orders = [(i, 1, 10, date(2024, i, 20), "online", "completed") for i in range(1, 10)]
    r = small_retail(spark, orders=orders)
    offsets = {row.month_offset for row in views.customer_cohorts(r.customers, r.orders).collect()}
    assert offsets == set(range(7))


def test_orders_before_signup_are_outside_the_cohort(spark):
    r = small_retail(spark, orders=[(1, 3, 20, d("2024-01-15"), "online", "completed")])
    assert views.customer_cohorts(r.customers, r.orders).count() == 0


def test_before_month_of(retail):
    complete = views.before_month_of(revenue(retail), retail.as_of)
    assert complete.agg(F.max("month")).first()[0] == d("2024-04-01")


def test_month_of_accepts_columns(spark):
    assert spark.range(1).select(month_of(F.lit(d("2024-02-29")))).first()[0] == d("2024-02-01")
