import pytest
from frames import by, small_retail
from published import METRICS, MONTHLY_SALES
from pyspark.sql import functions as F

from shoptally.operators import quality
from shoptally.plans import catalog, pipeline


@pytest.fixture(scope="module")
def store(spark, retail, tmp_path_factory):
    out = pipeline.Store(spark, str(tmp_path_factory.mktemp("out")))
    pipeline.run(retail, out, "North")
    return out


def test_written_tables_equal_the_queries(store, retail):
    keys = {
        "customer_summary": ["customer_id"],
        "daily_sales": ["store_id", "date"],
        "monthly_sales": ["month"],
        "product_performance": ["product_id"],
        "product_monthly_sales": ["product_id", "month"],
        "store_performance": ["store_id"],
        "inventory_health": ["product_id"],
        "marketing_performance": ["campaign_id"],
        "returns_summary": ["product_id"],
    }
    for name, key in keys.items():
        written = store.get("analytics", name)
        if name == "product_monthly_sales":  # its months are directories, typed by the reader
            written = written.withColumn("month", F.date_format("month", "yyyy-MM"))
        assert by(written, *key) == by(catalog.QUERIES[name](retail), *key), name
    for name, key in (("customer_features", "customer_id"), ("product_features", "product_id"), ("store_features", "store_id")):
        assert by(store.get("features", name), key) == by(catalog.QUERIES[name](retail), key), name


def test_product_months_are_partitions(spark, store):
    by_month = spark.read.schema("product_id bigint, units_sold bigint, month string").parquet(
        f"{store.base}/analytics/product_monthly_sales"
    )
    plan = by_month.where("month >= '2024-03'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan
    assert sorted(r.month for r in by_month.select("month").distinct().collect()) == [
        "2024-01", "2024-02", "2024-03", "2024-04",
    ]


def test_quality_is_recorded(store):
    assert store.get("quality", "raw_checks").count() == 62
    profiles = store.get("quality", "analytics_profiles")
    assert quality.table_checks(profiles).count() == 50
    assert quality.table_checks(store.get("quality", "feature_profiles")).count() == 33
    assert {r.status for r in quality.table_summary(profiles).collect()} == {"PASS"}


def test_a_failed_gate_can_stop_the_run(spark, tmp_path):
    out = pipeline.Store(spark, str(tmp_path))
    broken = small_retail(spark, stores=[], customers=[])
    assert pipeline.run(broken, out, "North", stop_on_fail=True) is False
    assert not (tmp_path / "analytics").exists()


def test_forecasts_of_the_company_total(spark, tmp_path):
    out = pipeline.Store(spark, str(tmp_path))
    columns = "month string, orders bigint, customers bigint, units_sold bigint, revenue double, average_order_value double"
    pipeline.build_forecasts(spark.createDataFrame(MONTHLY_SALES, columns), out)
    metrics = by(out.get("predictions", "metrics"), "model")
    assert {m: (v["mae"], v["rmse"], v["mape_pct"]) for m, v in metrics.items()} == METRICS
    assert out.get("predictions", "model_spec").first().best_model == "naive"
