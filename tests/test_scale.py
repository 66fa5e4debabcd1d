"""Properties that matter when the tables are large: plan shapes and hot keys."""

import re
from datetime import timedelta
from decimal import Decimal as D

import pytest
from frames import by, d, small_retail
from pyspark.sql import functions as F

from shoptally.operators import analytics, facts, profiles, views
from shoptally.plans.catalog import QUERIES
from shoptally.sources.star_schema import StarSchemaRetail

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    """Plans as for tables too large to broadcast."""
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for key in keys:
        spark.conf.set(key, "-1")
    yield
    for key in keys:
        spark.conf.unset(key)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_query_pairs_all_rows_or_leaves_the_jvm(spark, no_broadcast, name):
    plan = plan_of(QUERIES[name](StarSchemaRetail(spark, SF_DIR)))
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    if name not in ("forecast_linreg", "forecast_predictions", "forecast_model_specs"):
        assert "InPandas" not in plan


def test_filters_and_columns_reach_the_scan(spark):
    retail = StarSchemaRetail(spark, SF_DIR)
    plan = plan_of(QUERIES["v_monthly_revenue_by_city"](retail))
    lineitem = re.search(r"FileScan parquet \[l_orderkey[^\n]*", plan).group()
    assert "ReadSchema: struct<l_orderkey:bigint,l_extendedprice:double,l_discount:double>" in lineitem
    orders = re.search(r"FileScan parquet \[o_orderkey[^\n]*", plan).group()
    assert "o_orderstatus" in orders.split("DataFilters")[1] and "o_totalprice" not in orders
    stock = plan_of(QUERIES["v_focus_stockout_indicators"](retail))
    # Every line is read, and of each only what the stock is derived from.
    lines = re.search(r"FileScan parquet \[l_partkey[^\n]*", stock).group()
    assert "ReadSchema: struct<l_partkey:bigint,l_suppkey:bigint,l_quantity:double,l_shipdate:timestamp_ntz>" in lines
    assert "(l_shipdate" not in lines.split("PushedFilters")[1]


def test_product_calendar_is_laid_out_after_the_last_shuffle(spark, no_broadcast):
    plan = plan_of(QUERIES["product_monthly_sales"](StarSchemaRetail(spark, SF_DIR)))
    generate = plan.index("Generate explode")
    assert "Exchange" not in plan[:generate]
    assert "Exchange" in plan[generate:]


def hot_retail(spark, lines=3000):
    """One order, product, store and customer hold most of the rows."""
    day = d("2024-01-05")
    orders = [(1, 1, 10, day, "online", "completed")]
    orders += [(i, 1 if i % 2 else 2, 10, day + timedelta(days=i % 90), "online", "completed") for i in range(2, 400)]
    items = [(i, 1 if i % 3 == 0 else 2 + i % 398, 100 if i % 2 else 102, 1, D("2.00"), D("2.00")) for i in range(lines)]
    returns = [(i, 1, 100, day, "x") for i in range(300)]
    return small_retail(spark, orders=orders, order_items=items, returns=returns)


@pytest.fixture
def tiny_skew_limits(spark, no_broadcast):
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key in settings:
        spark.conf.unset(key)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_a_hot_order_is_one_row_before_its_join(spark):
    r = hot_retail(spark)
    totals = by(facts.order_totals(r.order_items), "order_id")
    assert totals[1]["units"] == 1000
    revenue = views.monthly_revenue_by_city(r.orders, r.order_items, r.stores)
    assert revenue.agg(F.sum("revenue")).first()[0] == 6000.0


def test_a_hot_order_is_split_when_its_lines_are_joined(spark, tiny_skew_limits):
    r = hot_retail(spark, lines=30000)
    items = r.order_items.repartition(8, "order_item_id")  # many map outputs to split by
    sales = analytics.product_sales(r.orders, items, r.products)
    rows = by(sales, "product_id")
    assert rows[100]["units_sold"] + rows[102]["units_sold"] == 30000
    assert "skew=true" in executed(sales)


def executed(df):
    frame = df.select("*")
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString()


def test_hot_keys_leave_results_whole(spark, tiny_skew_limits):
    r = hot_retail(spark)
    daily = analytics.daily_sales(r.orders, r.order_items, r.stores)
    assert daily.agg(F.sum("orders"), F.sum("units_sold")).first()[:] == (399, 3000)
    store = by(analytics.store_performance(r.stores, r.orders, r.order_items, r.returns), "store_id")[10]
    assert (store["orders"], store["customers"], store["revenue"]) == (399, 2, 6000.0)
    rates = views.return_rate_by_city_month(r.orders, r.returns, r.stores)
    assert rates.agg(F.sum("return_count")).first()[0] == 300
    mix = views.category_revenue_by_city_month(r.orders, r.order_items, r.products, r.stores)
    assert mix.agg(F.sum("revenue")).first()[0] == 6000.0
    retained = views.customer_retention(r.orders, r.stores, "North")
    assert by(retained, "month")[d("2024-02-01")]["retained_from_prior_month"] == 2


def test_a_hot_value_is_one_row_for_the_quantiles(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 5.0).otherwise(F.col("id") / 10).alias("x"))
    expected = df.select(F.percentile("x", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))).first()[0]
    row = profiles.describe(df, ["x"]).first()
    assert [row.p25, row.p50, row.p75] == pytest.approx(expected, abs=1e-4)


