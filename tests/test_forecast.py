from datetime import date

import pytest
from frames import by, d
from published import FORECASTS, METRICS, MONTHLY_SALES
from pyspark.sql import functions as F

from shoptally.operators import forecast

SERIES = "series_id string, month date, orders bigint, revenue double"


def months(n, year=2024):
    return [date(year + i // 12, i % 12 + 1, 1) for i in range(n)]


@pytest.fixture(scope="module")
def split(spark):
    rows = [("total", d(f"{m}-01"), orders, revenue) for m, orders, _, _, revenue, _ in MONTHLY_SALES]
    monthly = forecast.drop_partial_month(spark.createDataFrame(rows, SERIES))
    return forecast.time_split(forecast.forecast_features(monthly))


def test_split_sizes(split):
    counts = by(split.groupBy("split").count(), "split")
    assert (counts["train"]["count"], counts["test"]["count"]) == (9, 3)


def test_predictions_reproduce_published_values(split):
    rows = by(forecast.predictions(split), "month")
    assert len(rows) == 3
    for month, actual, naive, rolling, linear in FORECASTS:
        row = rows[d(month)]
        assert row["actual_revenue"] == actual
        assert row["naive_pred"] == naive
        assert row["rolling_pred"] == pytest.approx(rolling)
        assert row["linreg_pred"] == pytest.approx(linear, rel=1e-6)


def test_single_model_forecasts(split):
    naive = by(forecast.naive_forecast(split), "month")
    rolling = by(forecast.rolling_forecast(split), "month")
    linear = by(forecast.linear_forecast(split), "month")
    for month, actual, naive_pred, rolling_pred, linreg_pred in FORECASTS:
        key = d(month)
        assert naive[key]["naive_pred"] == naive_pred
        assert rolling[key]["rolling_pred"] == pytest.approx(rolling_pred)
        assert linear[key]["linreg_pred"] == pytest.approx(linreg_pred, rel=1e-6)


def test_metrics_and_winner(split):
    metrics = forecast.forecast_metrics(forecast.predictions(split))
    rows = by(metrics, "model")
    for model, (mae, rmse, mape) in METRICS.items():
        assert (rows[model]["mae"], rows[model]["rmse"], rows[model]["mape_pct"]) == (mae, rmse, mape)
    assert forecast.best_model(metrics).first().best_model == "naive"
    spec = forecast.model_specs(metrics, forecast.fit_linear_models(split)).first()
    assert spec.best_model == "naive" and spec.coefficients is None
    assert spec.features == list(forecast.FEATURES)


def test_a_winning_regression_keeps_its_weights(split):
    metrics = forecast.forecast_metrics(forecast.predictions(split)).where("model = 'linear_regression'")
    spec = forecast.model_specs(metrics, forecast.fit_linear_models(split)).first()
    assert len(spec.coefficients) == 6 and spec.intercept is not None


def guard(spark, orders):
    rows = [("s", m, n, 1.0) for m, n in zip(months(len(orders)), orders)]
    return forecast.drop_partial_month(spark.createDataFrame(rows, SERIES)).count()


def test_partial_month_guard(spark):
    assert guard(spark, [100] * 6 + [49]) == 6
    assert guard(spark, [100] * 6 + [50]) == 7  # exactly half is kept
    assert guard(spark, [100, 10]) == 1  # fewer than six months before
    assert guard(spark, [1]) == 1
    assert guard(spark, [1000, *[10] * 6, 6]) == 8  # only the six months before count
    assert guard(spark, [100, 1, 100, 100, 100, 100, 100]) == 7  # only the last month may go


def test_short_series_yield_nothing(spark):
    rows = [("s", m, 10, 1.0) for m in months(6)]
    features = forecast.forecast_features(spark.createDataFrame(rows, SERIES))
    assert features.count() == 0
    split = forecast.time_split(features)
    assert forecast.predictions(split).count() == 0
    assert forecast.best_model(forecast.forecast_metrics(forecast.predictions(split))).count() == 0


def test_too_few_rows_to_train_leave_the_regression_out(spark):
    rows = [("s", m, 10, float(i + 1)) for i, m in enumerate(months(9))]
    split = forecast.time_split(forecast.forecast_features(spark.createDataFrame(rows, SERIES)))
    predicted = forecast.predictions(split).collect()
    assert len(predicted) == 3 and all(r.linreg_pred is None and r.naive_pred is not None for r in predicted)
    winner = forecast.best_model(forecast.forecast_metrics(forecast.predictions(split))).first()
    assert winner.best_model == "naive"


def test_series_are_fitted_apart(spark):
    up = [("up", m, 10, 100.0 + 10 * i) for i, m in enumerate(months(24))]
    flat = [("flat", m, 10, 50.0) for m in months(24)]
    split = forecast.time_split(forecast.forecast_features(spark.createDataFrame(up + flat, SERIES)))
    rows = forecast.predictions(split)
    assert by(rows.groupBy("series_id").count(), "series_id")["up"]["count"] == 3
    for row in rows.collect():
        assert row.linreg_pred == pytest.approx(row.actual_revenue, rel=1e-6)


PREDICTED = "series_id string, month date, actual_revenue double, naive_pred double, rolling_pred double"


def test_zero_actuals(spark):
    rows = [("s", d("2024-01-01"), 0.0, 10.0, 5.0), ("s", d("2024-02-01"), 100.0, 90.0, 100.0)]
    predicted = spark.createDataFrame(rows, PREDICTED)
    plain = by(forecast.forecast_metrics(predicted), "model")
    guarded = by(forecast.forecast_metrics(predicted, skip_zero_actuals=True), "model")
    assert plain["naive"]["mape_pct"] == float("inf")
    assert guarded["naive"]["mape_pct"] == 10.0
    assert plain["naive"]["mae"] == guarded["naive"]["mae"] == 10.0


def test_the_first_model_wins_a_tie(spark):
    predicted = spark.createDataFrame([("s", d("2024-01-01"), 10.0, 12.0, 8.0)], PREDICTED)
    assert forecast.best_model(forecast.forecast_metrics(predicted)).first().best_model == "naive"


def test_zero_revenue_months_have_no_growth(spark):
    rows = [("s", m, 10, 0.0 if i == 7 else 5.0) for i, m in enumerate(months(12))]
    kept = forecast.forecast_features(spark.createDataFrame(rows, SERIES)).select(F.collect_list("month")).first()[0]
    assert months(12)[9] not in kept  # its growth would divide by the zero month


def test_a_month_without_revenue_makes_the_unguarded_error_infinite(spark):
    predicted = spark.createDataFrame(
        [("a", 0.0, 5.0), ("a", 10.0, 5.0), ("b", 10.0, 5.0)], "series_id string, actual_revenue double, naive_pred double"
    )
    plain = {r.series_id: r.mape_pct for r in forecast.forecast_metrics(predicted).collect()}
    guarded = {r.series_id: r.mape_pct for r in forecast.forecast_metrics(predicted, skip_zero_actuals=True).collect()}
    assert plain == {"a": float("inf"), "b": 50.0} and guarded == {"a": 50.0, "b": 50.0}
