"""Every query by name, as a function of the retail data set.

Each entry only wires operators together; nothing runs until the result is read.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoptally.functions.calendar import parse_month, previous_month
from shoptally.functions.numeric import half_up
from shoptally.operators import analytics, features, forecast, profiles, quality, serving, views
from shoptally.operators.facts import order_totals
from shoptally.operators.ordering import with_position
from shoptally.plans import sql_views
from shoptally.sources.csv_scan import CsvScan, scan_csv
from shoptally.sources.files import save_table, to_records
from shoptally.sources.loads import Loads
from shoptally.sources.retail import Retail
from shoptally.sources.scratch import saved, shared_folder

Query = Callable[[Retail], DataFrame]

# Parameters of the registered queries.
FOCUS_CITY = "NATION_0"
SIGNUP_WINDOW = ("1995-01-01", "2000-06-23")
RECENT_MONTHS = 2
SECOND_LOAD = "1998-07-01"
PIVOT_ORDER_MONTHS = 6
PIVOT_REVENUE_MONTHS = 4

QUERIES: dict[str, Query] = {}


def _query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def rounded(df: DataFrame, columns: Sequence[str], digits: int = 4) -> DataFrame:
    return df.withColumns({c: half_up(F.col(c), digits) for c in columns})


# --- views -----------------------------------------------------------------------------------


@_query
def v_monthly_revenue_by_city(r: Retail) -> DataFrame:
    return views.monthly_revenue_by_city(r.orders, r.order_items, r.stores)


@_query
def v_focus_revenue_trend(r: Retail) -> DataFrame:
    return views.focus_revenue_trend(v_monthly_revenue_by_city(r), FOCUS_CITY)


@_query
def q_focus_trend_complete(r: Retail) -> DataFrame:
    return views.before_month_of(v_focus_revenue_trend(r), r.as_of)


@_query
def q_expected_vs_actual(r: Retail) -> DataFrame:
    return views.expected_vs_actual(v_monthly_revenue_by_city(r), FOCUS_CITY, r.as_of)


@_query
def v_marketing_spend_by_city_month(r: Retail) -> DataFrame:
    return views.marketing_spend_by_city_month(r.marketing_campaigns)


@_query
def q_focus_marketing_spend(r: Retail) -> DataFrame:
    return views.of_city(v_marketing_spend_by_city_month(r), FOCUS_CITY).select("city", "month", "total_spend")


@_query
def v_focus_stockout_indicators(r: Retail) -> DataFrame:
    return views.stockout_indicators(r.inventory, r.stores, FOCUS_CITY)


@_query
def v_return_rate_by_city_month(r: Retail) -> DataFrame:
    return views.return_rate_by_city_month(r.orders, r.return_lines, r.stores)


@_query
def q_focus_return_rate(r: Retail) -> DataFrame:
    return views.of_city(v_return_rate_by_city_month(r), FOCUS_CITY).drop("city")


@_query
def v_category_revenue_by_city_month(r: Retail) -> DataFrame:
    return views.category_revenue_by_city_month(r.orders, r.order_items, r.products, r.stores)


@_query
def q_focus_category_mix(r: Retail) -> DataFrame:
    mix = views.of_city(v_category_revenue_by_city_month(r), FOCUS_CITY)
    return mix.orderBy("month", F.col("revenue").desc(), "category")


@_query
def v_monthly_active_customers_by_city(r: Retail) -> DataFrame:
    return views.monthly_active_customers_by_city(r.orders, r.stores)


@_query
def v_new_vs_returning_customers_by_city_month(r: Retail) -> DataFrame:
    return views.new_vs_returning_customers(r.orders, r.stores)


@_query
def v_repeat_purchase_rate_by_city_month(r: Retail) -> DataFrame:
    return views.repeat_purchase_rate(r.orders, r.stores)


@_query
def v_avg_order_value_by_city_month(r: Retail) -> DataFrame:
    return views.average_order_value(v_monthly_revenue_by_city(r))


@_query
def v_focus_customer_retention(r: Retail) -> DataFrame:
    return views.customer_retention(r.orders, r.stores, FOCUS_CITY)


@_query
def v_customer_cohort_summary(r: Retail) -> DataFrame:
    return views.customer_cohorts(r.customers, r.order_headers)


# --- analytics and feature tables ---------------------------------------------------------------


@_query
def customer_summary(r: Retail) -> DataFrame:
    return analytics.customer_summary(r.customers, r.order_headers, r.order_items, r.as_of)


@_query
def daily_sales(r: Retail) -> DataFrame:
    return analytics.daily_sales(r.orders, r.order_items, r.stores)


@_query
def monthly_sales(r: Retail) -> DataFrame:
    return analytics.monthly_sales(daily_sales(r), r.order_headers, r.as_of)


def _product_sales(r: Retail) -> DataFrame:
    return analytics.product_sales(r.order_headers, r.order_items, r.products)


@_query
def product_performance(r: Retail) -> DataFrame:
    return analytics.product_performance(r.products, _product_sales(r), r.return_lines)


@_query
def product_performance_list_price(r: Retail) -> DataFrame:
    """The same from lines that do not say their discount: it is what the charged price is below the list price."""
    lines = r.order_items.drop("discount_pct")
    return analytics.product_performance(
        r.products, analytics.product_sales(r.order_headers, lines, r.products), r.return_lines
    )


@_query
def product_monthly_sales(r: Retail) -> DataFrame:
    sales = analytics.product_sales(r.order_headers, r.order_items, r.products, by_month=True)
    first = r.order_headers.agg(F.min("order_date")).scalar()
    return analytics.product_monthly_sales(r.products, sales, r.returns, first, previous_month(r.as_of))


@_query
def store_performance(r: Retail) -> DataFrame:
    return analytics.store_performance(r.stores, r.orders, r.order_items, r.return_lines)


@_query
def inventory_health(r: Retail) -> DataFrame:
    return analytics.inventory_health(
        r.products, r.inventory, r.order_headers, r.order_items, r.as_of, r.latest_snapshot
    )


@_query
def marketing_performance(r: Retail) -> DataFrame:
    return analytics.marketing_performance(r.marketing_campaigns, r.orders, r.order_items, r.stores)


@_query
def returns_summary(r: Retail) -> DataFrame:
    return analytics.returns_summary(r.products, r.return_lines, _product_sales(r))


@_query
def sales_forecasting_features(r: Retail) -> DataFrame:
    unrounded = ["rolling_mean_3", "rolling_mean_6", "rolling_std_3", "revenue_growth_rate", "moving_average_difference"]
    return rounded(features.sales_forecasting_features(monthly_sales(r)), unrounded)


@_query
def customer_features(r: Retail) -> DataFrame:
    return features.customer_features(customer_summary(r))


@_query
def product_features(r: Retail) -> DataFrame:
    last = previous_month(r.as_of)
    first = F.add_months(last, -2)
    recent_orders = r.order_headers.where(F.col("order_date") >= first)
    sales = analytics.product_sales(recent_orders, r.order_items, r.products, by_month=True)
    recent_returns = r.returns.where(F.col("return_date") >= first)
    recent = analytics.product_monthly_sales(r.products, sales, recent_returns, first, last)
    return features.product_features(product_performance(r), inventory_health(r), recent, r.as_of)


@_query
def store_features(r: Retail) -> DataFrame:
    return features.store_features(store_performance(r), daily_sales(r), r.as_of)


# --- ordered results ------------------------------------------------------------------------------

#: The order of each result, as columns and directions; a dash before a column is descending.  No column but
#: those with a question mark may be null, and nulls come last.
ORDERS: dict[str, tuple[str, ...]] = {
    "v_monthly_revenue_by_city": ("city", "month"),
    "v_focus_revenue_trend": ("month",),
    "v_marketing_spend_by_city_month": ("city?", "month"),
    "v_focus_stockout_indicators": ("month", "store_name"),
    "v_return_rate_by_city_month": ("city", "month"),
    "v_category_revenue_by_city_month": ("city", "month", "-revenue", "category"),
    "v_monthly_active_customers_by_city": ("city", "month"),
    "v_new_vs_returning_customers_by_city_month": ("city", "month"),
    "v_repeat_purchase_rate_by_city_month": ("city", "month"),
    "v_avg_order_value_by_city_month": ("city", "month"),
    "v_focus_customer_retention": ("month",),
    "v_customer_cohort_summary": ("city?", "cohort_month", "month_offset"),
    "customer_summary": ("customer_id",),
    "daily_sales": ("date", "store_id"),
    "monthly_sales": ("month",),
    "product_performance": ("product_id",),
    "product_monthly_sales": ("product_id", "month"),
    "store_performance": ("store_id",),
    "inventory_health": ("product_id",),
    "marketing_performance": ("campaign_id",),
    "returns_summary": ("product_id",),
    "sales_forecasting_features": ("month",),
    "customer_features": ("customer_id",),
    "product_features": ("product_id",),
    "store_features": ("store_id",),
    "closest_to_stockout_all": ("estimated_days_to_stockout?", "product_id"),
}


def order_columns(order: Sequence[str]) -> list[Column]:
    names = [F.col(c.strip("-?")) for c in order]
    return [n.desc_nulls_last() if c[0] == "-" else n.asc_nulls_last() for c, n in zip(order, names, strict=True)]


def ordered(name: str, r: Retail) -> DataFrame:
    """A result with its rows' places in its order, found by ranges; the rows themselves are not gathered."""
    build = inventory_health if name == "closest_to_stockout_all" else QUERIES[name]
    return with_position(build(r), order_columns(ORDERS[name]))


def in_order(name: str, r: Retail) -> DataFrame:
    """A result in its order, to show or to write: Spark's sort over the whole table."""
    return QUERIES[name](r).orderBy(*order_columns(ORDERS[name]))


ORDERED = (
    *(name for name in ORDERS if name.startswith("v_")),
    "daily_sales",
    "product_monthly_sales",
    "customer_features",
    "closest_to_stockout_all",
)
QUERIES |= {f"ordered_{name}": partial(ordered, name) for name in ORDERED}


# --- the views as SQL text ------------------------------------------------------------------------


def _sql_view(name: str, r: Retail) -> DataFrame:
    return sql_views.view(r.order_headers.sparkSession, r, name, FOCUS_CITY)


QUERIES |= {f"sql_{name}": partial(_sql_view, name) for name in sql_views.RESULTS}


# --- data quality ---------------------------------------------------------------------------------


@_query
def dq_primary_keys(r: Retail) -> DataFrame:
    return quality.primary_keys(r.tables(), r.primary_keys)


@_query
def dq_referential_integrity(r: Retail) -> DataFrame:
    return quality.referential_integrity(r.tables())


@_query
def dq_temporal_integrity(r: Retail) -> DataFrame:
    return quality.temporal_integrity(r.order_headers, r.customers)


@_query
def dq_temporal_offenders(r: Retail) -> DataFrame:
    return quality.temporal_offenders(r.order_headers, r.customers)


@_query
def dq_duplicates(r: Retail) -> DataFrame:
    return quality.duplicates(r.tables())


@_query
def dq_missing_values(r: Retail) -> DataFrame:
    return quality.missing_values(r.tables())


@_query
def dq_missing_by_column(r: Retail) -> DataFrame:
    return quality.missing_by_column(r.tables(), only_missing=False)


@_query
def dq_invalid_values(r: Retail) -> DataFrame:
    return quality.invalid_values({**r.tables(), "orders": r.order_headers})


@_query
def dq_business_distributions(r: Retail) -> DataFrame:
    return quality.business_distributions(r.order_headers)


@_query
def dq_missing_months(r: Retail) -> DataFrame:
    return quality.missing_months(r.order_headers, r.customers)


@_query
def dq_anomaly_changes(r: Retail) -> DataFrame:
    changes = quality.anomaly_changes(r.orders, r.order_items, r.stores, r.as_of)
    return rounded(changes, ["pre", "post", "change"])


@_query
def dq_focus_anomaly(r: Retail) -> DataFrame:
    return quality.focus_anomaly(quality.anomaly_changes(r.orders, r.order_items, r.stores, r.as_of), FOCUS_CITY)


@_query
def dq_anomaly_isolated(r: Retail) -> DataFrame:
    return quality.anomaly_isolated(quality.anomaly_changes(r.orders, r.order_items, r.stores, r.as_of), FOCUS_CITY)


@_query
def dq_ranges(r: Retail) -> DataFrame:
    return quality.ranges(r.customers, r.order_headers, *SIGNUP_WINDOW)


def _battery(r: Retail) -> DataFrame:
    return quality.battery(r.tables(), r.primary_keys, r.as_of, FOCUS_CITY)


@_query
def dq_quality_score(r: Retail) -> DataFrame:
    return quality.quality_score(_battery(r))


@_query
def dq_category_summary(r: Retail) -> DataFrame:
    return quality.category_summary(_battery(r))


def built_tables(r: Retail, both: bool = True) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    """The nine analytics and four feature tables on facts that are computed once and kept.

    Lines are read for two of the facts, whatever the number of tables.  Where `both` kinds of tables are wanted, the
    analytics tables that features are made of are kept too.
    """
    keep = saved if both else lambda df: df
    first, last = r.order_headers.agg(F.min("order_date")).scalar(), previous_month(r.as_of)
    totals = saved(order_totals(r.order_items))
    sales = saved(analytics.product_sales(r.order_headers, r.order_items, r.products, by_month=True))
    daily = saved(analytics.daily_sales(r.orders, totals, r.stores))
    monthly = saved(analytics.monthly_sales(daily, r.order_headers, r.as_of))
    built = {
        "customer_summary": keep(analytics.customer_summary(r.customers, r.order_headers, totals, r.as_of)),
        "daily_sales": daily,
        "monthly_sales": monthly,
        "product_performance": keep(analytics.product_performance(r.products, sales, r.return_lines)),
        "product_monthly_sales": analytics.product_monthly_sales(r.products, sales, r.returns, first, last),
        "store_performance": keep(analytics.store_performance(r.stores, r.orders, totals, r.return_lines)),
        "inventory_health": keep(
            analytics.inventory_health(
                r.products, r.inventory, r.order_headers, r.order_items, r.as_of, r.latest_snapshot
            )
        ),
        "marketing_performance": analytics.marketing_performance(r.marketing_campaigns, r.orders, totals, r.stores),
        "returns_summary": analytics.returns_summary(r.products, r.return_lines, sales),
    }
    begin = F.add_months(last, -2)
    recent = analytics.product_monthly_sales(
        r.products, sales.where(F.col("month") >= begin), r.returns.where(F.col("return_date") >= begin), begin, last
    )
    features_of = {
        "sales_forecasting_features": features.sales_forecasting_features(monthly),
        "customer_features": features.customer_features(built["customer_summary"]),
        "product_features": features.product_features(
            built["product_performance"], built["inventory_health"], recent, r.as_of
        ),
        "store_features": features.store_features(built["store_performance"], daily, r.as_of),
    }
    return built, features_of


def _analytics_profiles(r: Retail, tables: dict[str, DataFrame]) -> DataFrame:
    rules = quality.analytics_rules(
        r.customers, r.stores, r.products, r.marketing_campaigns, r.order_headers, r.as_of
    )
    return quality.table_profiles({name: (df, rules[name]) for name, df in tables.items()})


def _feature_profiles(r: Retail, tables: dict[str, DataFrame]) -> DataFrame:
    def size(df: DataFrame):
        return df.agg(F.count(F.lit(1))).scalar()

    rules = quality.feature_rules(size(r.customers), size(r.products), size(r.stores))
    return quality.table_profiles({name: (df, rules[name]) for name, df in tables.items()})


def _profiles(r: Retail, which: str = "all") -> DataFrame:
    built, features_of = built_tables(r, which == "all")
    if which == "analytics":
        return _analytics_profiles(r, built)
    if which == "features":
        return _feature_profiles(r, features_of)
    return _analytics_profiles(r, built).unionByName(_feature_profiles(r, features_of))


@_query
def dq_table_summary(r: Retail) -> DataFrame:
    return quality.table_summary(_profiles(r, "analytics"))


@_query
def dq_feature_table_summary(r: Retail) -> DataFrame:
    return quality.table_summary(_profiles(r, "features"))


@_query
def dq_table_checks(r: Retail) -> DataFrame:
    return quality.table_checks(_profiles(r, "analytics"))


@_query
def dq_feature_table_checks(r: Retail) -> DataFrame:
    return quality.table_checks(_profiles(r, "features"))


@_query
def dq_failed_checks(r: Retail) -> DataFrame:
    return quality.failed_checks(_profiles(r))


@_query
def dq_feature_missing(r: Retail) -> DataFrame:
    return quality.missing_report(_profiles(r, "features"))


@_query
def dq_table_profile(r: Retail) -> DataFrame:
    return quality.profile_report(_profiles(r, "analytics"))


@_query
def dq_final_listing(r: Retail) -> DataFrame:
    return quality.final_listing(_profiles(r))


# --- forecasts, one series per city -----------------------------------------------------------------


def city_series(r: Retail) -> DataFrame:
    return v_monthly_revenue_by_city(r).select(
        F.col("city").alias("series_id"), "month", F.col("order_count").alias("orders"), "revenue"
    )


def _features(r: Retail) -> DataFrame:
    return forecast.forecast_features(forecast.drop_partial_month(city_series(r)))


def _split(r: Retail) -> DataFrame:
    return forecast.time_split(_features(r))


@_query
def partial_month_guard(r: Retail) -> DataFrame:
    return forecast.drop_partial_month(city_series(r))


@_query
def forecast_features(r: Retail) -> DataFrame:
    return rounded(
        _features(r), ["previous_3_month_avg_revenue", "previous_6_month_avg_revenue", "revenue_growth_rate"]
    )


@_query
def forecast_split(r: Retail) -> DataFrame:
    return _split(r).select("series_id", "month", "revenue", "split")


@_query
def forecast_naive(r: Retail) -> DataFrame:
    return forecast.naive_forecast(_split(r))


@_query
def forecast_rolling(r: Retail) -> DataFrame:
    return rounded(forecast.rolling_forecast(_split(r)), ["rolling_pred"])


@_query
def forecast_linreg(r: Retail) -> DataFrame:
    return rounded(forecast.linear_forecast(_split(r)), ["linreg_pred"], 2)


@_query
def forecast_predictions(r: Retail) -> DataFrame:
    return rounded(rounded(forecast.predictions(_split(r)), ["rolling_pred"]), ["linreg_pred"], 2)


@_query
def forecast_metrics(r: Retail) -> DataFrame:
    return forecast.forecast_metrics(forecast.predictions(_split(r))).drop("rank")


@_query
def forecast_metrics_guarded(r: Retail) -> DataFrame:
    predicted = forecast.predictions(_split(r))
    return forecast.forecast_metrics(predicted, skip_zero_actuals=True).drop("rank")


def _product_split(r: Retail) -> DataFrame:
    """Sales per product on the calendar without gaps, where many months have none."""
    series = product_monthly_sales(r).select(
        F.col("product_id").alias("series_id"), parse_month("month").alias("month"), F.col("units_sold").alias("orders"), "revenue"
    )
    return forecast.time_split(forecast.forecast_features(series))


@_query
def forecast_product_metrics(r: Retail) -> DataFrame:
    """Errors of the two simple forecasts per product; a month without revenue makes the percentage infinite."""
    return forecast.forecast_metrics(forecast.baseline_predictions(_product_split(r))).drop("rank")


@_query
def forecast_product_metrics_guarded(r: Retail) -> DataFrame:
    predicted = forecast.baseline_predictions(_product_split(r))
    return forecast.forecast_metrics(predicted, skip_zero_actuals=True).drop("rank")


@_query
def forecast_best_model(r: Retail) -> DataFrame:
    return forecast.best_model(forecast.forecast_metrics(forecast.predictions(_split(r))))


@_query
def forecast_model_specs(r: Retail) -> DataFrame:
    split = _split(r)
    specs = forecast.model_specs(
        forecast.forecast_metrics(forecast.predictions(split)), forecast.fit_linear_models(split)
    )
    return specs.select(
        "series_id",
        "best_model",
        "rmse",
        F.array_join("features", ",").alias("features"),
        half_up(F.col("intercept"), 0).alias("intercept"),
        half_up(F.col("coefficients")[0], 3).alias("previous_month_weight"),
    )


@_query
def forecast_model_weights(r: Retail) -> DataFrame:
    """All weights of each series' regression, whichever model wins."""
    models = forecast.fit_linear_models(_split(r))
    weights = [half_up(F.col("coefficients")[i], 3).alias(f"{f}_weight") for i, f in enumerate(forecast.FEATURES)]
    return models.select("series_id", half_up(F.col("intercept"), 3).alias("intercept"), *weights)


# --- dashboard ------------------------------------------------------------------------------------------


@_query
def payload_overview(r: Retail) -> DataFrame:
    return serving.overview(monthly_sales(r), r.customers)


@_query
def payload_customers_sample(r: Retail) -> DataFrame:
    summary = analytics.customer_summary(
        *serving.first_customers(r.customers, r.order_headers, r.order_items), r.as_of
    )
    everyone = r.customers.agg(F.count(F.lit(1))).scalar()
    return serving.customers_sample(summary, features.customer_features(summary), total=everyone)


@_query
def kpi_mom_change(r: Retail) -> DataFrame:
    return serving.month_over_month(monthly_sales(r))


@_query
def kpi_alerts(r: Retail) -> DataFrame:
    return serving.alerts(kpi_mom_change(r))


@_query
def revenue_by_city(r: Retail) -> DataFrame:
    return serving.revenue_by_city(store_performance(r))


@_query
def store_ranking(r: Retail) -> DataFrame:
    return serving.store_ranking(store_performance(r))


@_query
def monthly_revenue_by_city_from_daily(r: Retail) -> DataFrame:
    return serving.monthly_revenue_by_city(daily_sales(r), r.as_of)


@_query
def daily_revenue_total(r: Retail) -> DataFrame:
    return serving.daily_revenue(daily_sales(r))


@_query
def focus_vs_others_monthly(r: Retail) -> DataFrame:
    return serving.focus_vs_others(v_monthly_revenue_by_city(r), FOCUS_CITY)


@_query
def top_products_by_revenue(r: Retail) -> DataFrame:
    return serving.top_products(product_performance(r), "revenue")


@_query
def top_products_by_return_rate(r: Retail) -> DataFrame:
    return serving.top_products(product_performance(r), "return_rate")


@_query
def revenue_by_category(r: Retail) -> DataFrame:
    return serving.revenue_by_category(product_performance(r))


@_query
def inventory_risk_distribution(r: Retail) -> DataFrame:
    return serving.risk_distribution(inventory_health(r))


@_query
def closest_to_stockout(r: Retail) -> DataFrame:
    return serving.closest_to_stockout(inventory_health(r))


@_query
def export_records_json(r: Retail) -> DataFrame:
    return to_records(monthly_sales(r))


@_query
def export_records_parsed(r: Retail) -> DataFrame:
    """Records with texts to escape, not-a-numbers, nulls, dates and decimals, out as JSON and in again by type."""
    day = F.date_add(F.lit("1995-01-01").cast("date"), (F.col("product_id") % 2000).cast("int"))
    rows = r.products.select(
        "product_id",
        F.concat(F.lit('"'), "product_name", F.lit("\\ \n\té/")).alias("label"),
        F.when(F.col("product_id") % 5 != 0, F.col("category")).alias("category"),
        "unit_price",
        F.when(F.col("product_id") % 7 == 0, F.lit(float("nan"))).otherwise(F.col("unit_cost").cast("double")).alias("unit_cost"),
        day.alias("day"),
    )
    records = to_records(rows).select("record", F.from_json("record", rows.schema).alias("r"))
    return records.select(
        "r.*", F.size(F.json_object_keys("record")).alias("fields")
    ).withColumn("unit_price", F.col("unit_price").cast("double"))


# --- files and loads ------------------------------------------------------------------------------------


def _as_csv(df: DataFrame) -> str:
    """A table as CSV in the shared folder, its columns in another order."""
    path = f"{shared_folder(df.sparkSession)}/csv-{uuid.uuid4()}"
    save_table(df.select(*sorted(df.columns)), path, "csv")
    return path


def _scanned(df: DataFrame) -> CsvScan:
    return scan_csv(df.sparkSession, _as_csv(df), df.schema)


@_query
def csv_orders(r: Retail) -> DataFrame:
    """Orders with their dates, out to CSV and in again by header names."""
    return _scanned(r.order_headers).rows


@_query
def csv_products(r: Retail) -> DataFrame:
    """Products with their prices, which come in as decimals."""
    return _scanned(r.products).rows.withColumns({c: F.col(c).cast("double") for c in ("unit_price", "unit_cost")})


@_query
def csv_rejected_orders(r: Retail) -> DataFrame:
    """What a scan sets aside of a file in which cancelled orders have no date and online ones an odd id."""
    damaged = r.order_headers.withColumns(
        {
            "order_date": F.when(F.col("order_status") == "cancelled", "none").otherwise(F.col("order_date").cast("string")),
            "customer_id": F.when(F.col("channel") == "online", F.concat(F.lit("c"), "customer_id")).otherwise(
                F.col("customer_id").cast("string")
            ),
        }
    )
    scan = scan_csv(damaged.sparkSession, _as_csv(damaged), r.order_headers.schema)
    return scan.rejected.select("record", F.array_join("failed", ",").alias("failed"))


@_query
def load_counts(r: Retail) -> DataFrame:
    """All tables loaded in two batches, the second one twice: rows that are there, and rows without a parent.

    The first batch has the older half of the orders and all lines; the second the other orders and what the
    first set aside.
    """
    spark = r.order_headers.sparkSession
    tables = r.tables()
    loads = Loads(spark, f"{shared_folder(spark)}/loads-{uuid.uuid4()}")
    loads.load({**tables, "orders": r.orders.where(F.col("order_date") < SECOND_LOAD)}, "older")
    again = {name: loads.set_aside(name, "older") for name in ("order_items", "returns")}
    newer = {"orders": r.orders.where(F.col("order_date") >= SECOND_LOAD), **again}
    for _ in range(2):
        loads.load(newer, "newer")
    notes = {n["load"]: n for n in loads.notes()}
    rows = [
        (
            name,
            sum(n["counts"].get(name, 0) for n in notes.values()),
            notes["older"]["rejected"][name] * (name not in again) + notes["newer"]["rejected"].get(name, 0),
        )
        for name in tables
    ]
    return spark.createDataFrame(rows, "table_name string, loaded long, set_aside long")


# --- profiles -------------------------------------------------------------------------------------------


@_query
def scan_table_counts(r: Retail) -> DataFrame:
    return profiles.table_counts(r.tables(), {"orders": r.order_headers, "returns": r.return_lines})


@_query
def channel_status_share(r: Retail) -> DataFrame:
    return profiles.value_shares(r.order_headers, "channel").unionByName(
        profiles.value_shares(r.order_headers, "order_status")
    )


@_query
def segment_share(r: Retail) -> DataFrame:
    return profiles.value_shares(r.customers, "segment")


@_query
def customers_by_city(r: Retail) -> DataFrame:
    return profiles.count_by(r.customers, "city", "customers")


@_query
def products_by_category(r: Retail) -> DataFrame:
    return profiles.count_by(r.products, "category", "products")


@_query
def stores_per_city(r: Retail) -> DataFrame:
    return profiles.stores_per_city(r.stores)


@_query
def snapshots_per_store(r: Retail) -> DataFrame:
    return profiles.count_by(r.inventory, "store_id", "snapshots")


@_query
def campaign_spend_by_city(r: Retail) -> DataFrame:
    return profiles.campaign_spend_by_city(r.marketing_campaigns)


@_query
def monthly_signups_pivot_city(r: Retail) -> DataFrame:
    return profiles.monthly_signups(r.customers)


@_query
def monthly_orders_pivot_city(r: Retail) -> DataFrame:
    return profiles.monthly_orders(r.orders, r.stores, PIVOT_ORDER_MONTHS)


@_query
def monthly_gross_revenue_pivot_city(r: Retail) -> DataFrame:
    return profiles.monthly_gross_revenue(
        r.orders, r.order_items, r.stores, PIVOT_REVENUE_MONTHS
    )


@_query
def returned_share_by_city_recent(r: Retail) -> DataFrame:
    return profiles.returned_share_by_city(r.orders, r.return_lines, r.stores, r.as_of, RECENT_MONTHS)


@_query
def returned_share_by_city_ranked(r: Retail) -> DataFrame:
    """The same cities, the largest share first."""
    return with_position(returned_share_by_city_recent(r), [F.col("returned_share").desc_nulls_last(), "city"])


@_query
def focus_signups_recent(r: Retail) -> DataFrame:
    """Signups of the focus city in its newest months."""
    return profiles.monthly_signups(views.of_city(r.customers, FOCUS_CITY), PIVOT_ORDER_MONTHS)


@_query
def eligible_customers_by_month(r: Retail) -> DataFrame:
    return profiles.eligible_customers(r.customers, r.order_headers)


@_query
def fx_month_parts(r: Retail) -> DataFrame:
    return profiles.month_parts(r.order_headers)


@_query
def fx_email(r: Retail) -> DataFrame:
    first, last = (F.split_part("customer_name", F.lit("#"), F.lit(n)) for n in (1, 2))
    return r.customers.select(
        "customer_id", profiles.customer_email(first, last, F.col("customer_id")).alias("email")
    )


@_query
def describe_numeric(r: Retail) -> DataFrame:
    return profiles.describe(r.products, ["unit_cost", "unit_price"]).unionByName(
        profiles.describe(r.inventory, ["stock_level"])
    )


@_query
def histogram_recency(r: Retail) -> DataFrame:
    return profiles.histogram(customer_features(r), "recency")


@_query
def histogram_monetary(r: Retail) -> DataFrame:
    return profiles.histogram(customer_features(r), "monetary")


@_query
def histogram_units(r: Retail) -> DataFrame:
    return profiles.histogram(product_features(r), "units_sold")
