"""The batch run: raw tables -> quality checks -> analytics -> features -> forecasts.

Each layer is written before the next one reads it, so a lost executor costs at most the
table in work.  The two joins every table would repeat, lines to orders and lines to products,
run once: their totals are the `facts` layer.

    spark-submit --py-files shoptally.zip -m shoptally.plans.pipeline RAW_DIR OUT_DIR FOCUS_CITY
"""

from __future__ import annotations

import logging
import sys
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoptally.functions.calendar import month_label, parse_month, previous_month
from shoptally.operators import analytics, features, forecast, quality
from shoptally.operators.facts import order_totals
from shoptally.sources.files import read_table, save_table
from shoptally.sources.retail import Retail, RetailDirectory

log = logging.getLogger(__name__)


@dataclass
class Store:
    """Where tables go: one directory per layer and table."""

    spark: SparkSession
    base: str

    def put(self, layer: str, name: str, df: DataFrame, partition_by: str | None = None) -> DataFrame:
        """Write a table and return it as read back, with the same columns and types."""
        path = f"{self.base}/{layer}/{name}"
        save_table(df, path, partition_by=partition_by)
        log.info("wrote %s/%s (%d columns)", layer, name, len(df.columns))
        return read_table(self.spark, path, df.schema).select(df.columns)

    def get(self, layer: str, name: str) -> DataFrame:
        return read_table(self.spark, f"{self.base}/{layer}/{name}")


def check_raw(retail: Retail, store: Store, focus_city: str) -> DataFrame:
    """Write the check rows and return the one-row score."""
    checks = store.put(
        "quality", "raw_checks", quality.battery(retail.tables(), retail.primary_keys, retail.as_of, focus_city)
    )
    return store.put("quality", "score", quality.quality_score(checks))


def build_analytics(retail: Retail, store: Store) -> dict[str, DataFrame]:
    """The nine analytics tables."""
    # One date is read back: later plans get it as a literal and can push it to their scans.
    as_of = F.lit(retail.order_headers.agg(F.max("order_date")).first()[0])
    first = F.lit(retail.order_headers.agg(F.min("order_date")).first()[0])
    totals = store.put("facts", "order_totals", order_totals(retail.order_items))
    sales = store.put(
        "facts",
        "product_month_sales",
        analytics.product_sales(retail.order_headers, retail.order_items, retail.products, by_month=True),
    )

    built: dict[str, DataFrame] = {}

    def put(name: str, df: DataFrame, partition_by: str | None = None) -> None:
        built[name] = store.put("analytics", name, df, partition_by)

    put("customer_summary", analytics.customer_summary(retail.customers, retail.order_headers, totals, as_of))
    put("daily_sales", analytics.daily_sales(retail.orders, totals, retail.stores))
    put("monthly_sales", analytics.monthly_sales(built["daily_sales"], retail.order_headers, as_of))
    put("product_performance", analytics.product_performance(retail.products, sales, retail.return_lines))
    put(
        "product_monthly_sales",
        analytics.product_monthly_sales(retail.products, sales, retail.returns, first, previous_month(as_of)),
        partition_by="month",
    )
    put("store_performance", analytics.store_performance(retail.stores, retail.orders, totals, retail.return_lines))
    put(
        "inventory_health",
        analytics.inventory_health(
            retail.products,
            retail.inventory,
            retail.order_headers,
            retail.order_items,
            as_of,
            retail.latest_snapshot,
        ),
    )
    put(
        "marketing_performance",
        analytics.marketing_performance(retail.marketing_campaigns, retail.orders, totals, retail.stores),
    )
    put("returns_summary", analytics.returns_summary(retail.products, retail.return_lines, sales))

    rules = quality.analytics_rules(
        retail.customers, retail.stores, retail.products, retail.marketing_campaigns, retail.order_headers, as_of
    )
    store.put("quality", "analytics_profiles", quality.table_profiles({n: (df, rules[n]) for n, df in built.items()}))
    return built


def build_features(tables: dict[str, DataFrame], store: Store) -> dict[str, DataFrame]:
    """The four feature tables, from analytics tables only."""
    as_of = F.lit(tables["daily_sales"].agg(F.max("date")).first()[0])
    last = previous_month(as_of)
    # Months are partitions: three of them are read.
    recent = tables["product_monthly_sales"].where(F.col("month") >= month_label(F.add_months(last, -2)))
    built = {
        "sales_forecasting_features": features.sales_forecasting_features(tables["monthly_sales"]),
        "customer_features": features.customer_features(tables["customer_summary"]),
        "product_features": features.product_features(
            tables["product_performance"], tables["inventory_health"], recent, as_of
        ),
        "store_features": features.store_features(tables["store_performance"], tables["daily_sales"], as_of),
    }
    built = {name: store.put("features", name, df) for name, df in built.items()}

    def size(name: str):
        return tables[name].agg(F.count(F.lit(1))).scalar()

    rules = quality.feature_rules(size("customer_summary"), size("product_performance"), size("store_performance"))
    store.put("quality", "feature_profiles", quality.table_profiles({n: (df, rules[n]) for n, df in built.items()}))
    return built


def build_forecasts(monthly_sales: DataFrame, store: Store) -> None:
    """Predictions, metrics and the winning model of the company total."""
    total = monthly_sales.select(
        F.lit("total").alias("series_id"), parse_month("month").alias("month"), "orders", "revenue"
    )
    split = store.put(
        "predictions",
        "split",
        forecast.time_split(forecast.forecast_features(forecast.drop_partial_month(total))),
    )
    predicted = store.put("predictions", "sales_forecast", forecast.predictions(split))
    metrics = store.put("predictions", "metrics", forecast.forecast_metrics(predicted))
    store.put("predictions", "model_spec", forecast.model_specs(metrics, forecast.fit_linear_models(split)))


def run(retail: Retail, store: Store, focus_city: str, stop_on_fail: bool = False) -> bool:
    """The whole pipeline; returns whether the raw data passed the quality gate.

    A failed gate is reported and, unless asked otherwise, does not stop the run.
    """
    passed = check_raw(retail, store, focus_city).first()["gate"] == quality.PASS
    if passed or not stop_on_fail:
        tables = build_analytics(retail, store)
        build_features(tables, store)
        build_forecasts(tables["monthly_sales"], store)
    return passed


def main(argv: list[str]) -> int:
    logging.basicConfig(level=logging.INFO)
    raw_dir, out_dir, focus_city = argv
    spark = SparkSession.builder.appName("shoptally").getOrCreate()
    passed = run(RetailDirectory(spark, raw_dir), Store(spark, out_dir), focus_city)
    log.info("quality gate: %s", quality.PASS if passed else quality.FAIL)
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
