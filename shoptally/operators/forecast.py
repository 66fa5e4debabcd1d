"""Baseline forecasts of monthly revenue, for any number of series at once.

Input: series_id, month (DATE), orders, revenue.  A company total is one series; cities,
stores or products are many, and every window and fit is partitioned by series_id.  A series
has one row per calendar month, so its window or fit is small whatever the size of the facts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shoptally.functions.frames import series, trailing, trailing_full
from shoptally.functions.numeric import half_up, ratio

TEST_MONTHS = 3
PARTIAL_SHARE = 0.5
# Share of a feature's variance below which it counts as a combination of the features before it.
DEPENDENT = 1e-9
FEATURES = (
    "previous_month_revenue",
    "previous_3_month_avg_revenue",
    "previous_6_month_avg_revenue",
    "month_number",
    "quarter",
    "revenue_growth_rate",
)
# Model name -> prediction column, in the order that decides ties.
MODELS = {"naive": "naive_pred", "rolling_avg": "rolling_pred", "linear_regression": "linreg_pred"}


def _in_order() -> WindowSpec:
    return series(["series_id"], "month")


def drop_partial_month(monthly: DataFrame) -> DataFrame:
    """Drop a series' last month if its orders are under half the mean of the six before."""
    order = _in_order()
    typical = trailing(F.avg, F.col("orders"), order, 6)
    is_last = F.lead("month").over(order).isNull()
    partial = is_last & F.coalesce(F.col("orders") < PARTIAL_SHARE * typical, F.lit(False))
    return monthly.withColumn("_partial", partial).where(~F.col("_partial")).drop("_partial")


def forecast_features(monthly: DataFrame) -> DataFrame:
    """Features that look back only; warm-up rows without full history are dropped."""
    order, revenue = _in_order(), F.col("revenue")
    lag_1, lag_2 = (F.lag(revenue, n).over(order) for n in (1, 2))
    return monthly.withColumns(
        {
            "previous_month_revenue": lag_1,
            "previous_3_month_avg_revenue": trailing_full(F.avg, revenue, order, 3),
            "previous_6_month_avg_revenue": trailing_full(F.avg, revenue, order, 6),
            "month_number": F.month("month"),
            "quarter": F.quarter("month"),
            "revenue_growth_rate": ratio(lag_1 - lag_2, lag_2),
        }
    ).na.drop()


def time_split(features: DataFrame, test_months: int = TEST_MONTHS) -> DataFrame:
    """Mark the last months of each series as test, the others as train."""
    newest_first = W.partitionBy("series_id").orderBy(F.col("month").desc())
    held_out = F.row_number().over(newest_first) <= test_months
    return features.withColumn("split", F.when(held_out, "test").otherwise("train"))


def naive_forecast(split: DataFrame) -> DataFrame:
    return _test_rows(split).select(
        "series_id", "month", "revenue", F.col("previous_month_revenue").alias("naive_pred")
    )


def rolling_forecast(split: DataFrame) -> DataFrame:
    return _test_rows(split).select(
        "series_id", "month", "revenue", F.col("previous_3_month_avg_revenue").alias("rolling_pred")
    )


def _test_rows(split: DataFrame) -> DataFrame:
    return split.where(F.col("split") == "test")


def fit_linear_models(split: DataFrame) -> DataFrame:
    """Least squares with intercept on each series' training rows: one model row per series.

    One aggregate gives the covariances of a series; the normal equations of the standardised
    features are then solved by elimination in columns.  A feature that depends on those before it
    gets the weight 0.
    """
    size = len(FEATURES)
    pairs = [(i, j) for i in range(size) for j in range(i, size)]
    x = [F.col(name).cast("double") for name in FEATURES]
    train = split.where(F.col("split") == "train")
    sums = train.groupBy("series_id").agg(
        F.count(F.lit(1)).alias("train_rows"),
        F.avg("revenue").alias("mean_y"),
        *(F.avg(x[i]).alias(f"mean_{i}") for i in range(size)),
        *(F.stddev_pop(x[i]).alias(f"sd_{i}") for i in range(size)),
        *(F.covar_pop(x[i], x[j]).alias(f"a_{i}_{j}") for i, j in pairs),
        *(F.covar_pop(x[i], F.col("revenue")).alias(f"b_{i}") for i in range(size)),
    )
    scaled = {f"a_{i}_{j}": _or_zero(F.col(f"a_{i}_{j}"), F.col(f"sd_{i}") * F.col(f"sd_{j}")) for i, j in pairs}
    scaled |= {f"b_{i}": _or_zero(F.col(f"b_{i}"), F.col(f"sd_{i}")) for i in range(size)}
    model = sums.withColumns(scaled)
    for p in range(size - 1):
        share = {i: _pivoted(F.col(f"a_{p}_{i}"), p) for i in range(p + 1, size)}
        step = {f"a_{i}_{j}": F.col(f"a_{i}_{j}") - share[i] * F.col(f"a_{p}_{j}") for i, j in pairs if i > p}
        step |= {f"b_{i}": F.col(f"b_{i}") - share[i] * F.col(f"b_{p}") for i in range(p + 1, size)}
        model = model.withColumns(step)
    for p in reversed(range(size)):
        known = sum((F.col(f"a_{p}_{j}") * F.col(f"w_{j}") for j in range(p + 1, size)), F.lit(0.0))
        model = model.withColumn(f"w_{p}", _pivoted(F.col(f"b_{p}") - known, p))
    weights = [_or_zero(F.col(f"w_{i}"), F.col(f"sd_{i}")) for i in range(size)]
    model = model.withColumn("coefficients", F.array(*weights))
    fitted = sum((F.col("coefficients")[i] * F.col(f"mean_{i}") for i in range(size)), F.lit(0.0))
    return model.select("series_id", (F.col("mean_y") - fitted).alias("intercept"), "coefficients", "train_rows")


def _or_zero(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def _pivoted(value: Column, p: int) -> Column:
    """value over pivot p, or 0 where what is left of feature p is rounding error."""
    pivot = F.col(f"a_{p}_{p}")
    return F.when(pivot > DEPENDENT, value / pivot).otherwise(F.lit(0.0))


def predictions(split: DataFrame) -> DataFrame:
    """Actual revenue and the three forecasts of the test months.

    The regression is one model row per series, evaluated here as a column expression.
    """
    terms = [F.col("coefficients")[i] * F.col(name) for i, name in enumerate(FEATURES)]
    return (
        _test_rows(split)
        .join(fit_linear_models(split), "series_id", "left")
        .select(
            "series_id",
            "month",
            F.col("revenue").alias("actual_revenue"),
            F.col("previous_month_revenue").alias("naive_pred"),
            F.col("previous_3_month_avg_revenue").alias("rolling_pred"),
            sum(terms, F.col("intercept")).alias("linreg_pred"),
        )
    )


def baseline_predictions(split: DataFrame) -> DataFrame:
    """Actual revenue and the two forecasts that need no model."""
    return _test_rows(split).select(
        "series_id",
        "month",
        F.col("revenue").alias("actual_revenue"),
        F.col("previous_month_revenue").alias("naive_pred"),
        F.col("previous_3_month_avg_revenue").alias("rolling_pred"),
    )


def linear_forecast(split: DataFrame) -> DataFrame:
    return predictions(split).select(
        "series_id", "month", F.col("actual_revenue").alias("revenue"), "linreg_pred"
    )


def _by_model(predicted: DataFrame) -> DataFrame:
    """Long form: one row per series, month and model present in the input."""
    present = {m: c for m, c in MODELS.items() if c in predicted.columns}
    options = [
        F.struct(F.lit(i).alias("rank"), F.lit(model).alias("model"), F.col(column).alias("predicted"))
        for i, (model, column) in enumerate(present.items())
    ]
    return predicted.select("series_id", "actual_revenue", F.inline(F.array(*options)))


def forecast_metrics(predicted: DataFrame, skip_zero_actuals: bool = False) -> DataFrame:
    """MAE, RMSE and MAPE per series and model, two digits.

    A zero actual makes the percentage error infinite, unless such months are skipped.
    """
    error = F.col("actual_revenue") - F.col("predicted")
    share = ratio(F.abs(error), F.abs(F.col("actual_revenue")))
    mape: Column = half_up(F.avg(share) * 100, 2)
    if not skip_zero_actuals:
        zero = F.count_if((F.col("actual_revenue") == 0) & error.isNotNull()) > 0
        mape = F.when(zero, F.lit(float("inf"))).otherwise(mape)
    return (
        _by_model(predicted)
        .groupBy("series_id", "rank", "model")
        .agg(
            half_up(F.avg(F.abs(error)), 2).alias("mae"),
            half_up(F.sqrt(F.avg(error * error)), 2).alias("rmse"),
            mape.alias("mape_pct"),
        )
    )


def best_model(metrics: DataFrame) -> DataFrame:
    """The model with the smallest RMSE per series; the earlier model wins a tie."""
    return metrics.where(F.col("rmse").isNotNull()).groupBy("series_id").agg(
        F.min_by("model", F.struct("rmse", "rank")).alias("best_model"), F.min("rmse").alias("rmse")
    )


def model_specs(metrics: DataFrame, models: DataFrame) -> DataFrame:
    """What to keep of a run: the winner, its feature list and, for a regression, its weights."""
    fitted = F.col("best_model") == "linear_regression"
    return (
        best_model(metrics)
        .join(models, "series_id", "left")
        .select(
            "series_id",
            "best_model",
            "rmse",
            F.array(*[F.lit(f) for f in FEATURES]).alias("features"),
            F.when(fitted, F.col("intercept")).alias("intercept"),
            F.when(fitted, F.col("coefficients")).alias("coefficients"),
        )
    )
