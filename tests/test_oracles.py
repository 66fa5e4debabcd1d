"""Every query with an SQL equivalent gives the same rows, columns and types on both engines."""

import pytest
from compare import connect, difference

import __spark_entry__ as entry
from shoptally.plans.catalog import QUERIES
from shoptally.plans.oracle import ORACLES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_result(spark, duck, name):
    assert difference(entry.queries()[name](spark, SF_DIR), duck, entry.oracle_sql()[name]) is None


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) - set(ORACLES) == {"export_records_json"}


@pytest.mark.parametrize("name", ["forecast_linreg", "forecast_predictions", "forecast_model_specs"])
def test_regression_queries_cover_every_city(spark, name):
    df = entry.queries()[name](spark, SF_DIR)
    assert df.select("series_id").distinct().count() == 25


def test_entry(spark):
    assert entry.entry(spark).columns == ["city", "month", "order_count", "revenue"]


def test_the_winner_is_the_same_in_both_queries(spark):
    best = {r.series_id: r.best_model for r in entry.queries()["forecast_best_model"](spark, SF_DIR).collect()}
    specs = {r.series_id: r.best_model for r in entry.queries()["forecast_model_specs"](spark, SF_DIR).collect()}
    assert best == specs and len(best) == 25 and "linear_regression" in best.values()
    assert entry.queries()["forecast_metrics"](spark, SF_DIR).count() == 75
