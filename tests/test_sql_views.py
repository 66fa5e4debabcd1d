"""The SQL views agree with the operators, on the small tables with their odd cases too."""

import pytest

from shoptally.plans import catalog, sql_views

ROWS = lambda df: sorted((str(sorted(r.asDict().items())) for r in df.collect()))


@pytest.fixture(scope="module")
def views(spark, retail):
    sql_views.create_views(spark, retail, "North")
    return spark


@pytest.mark.parametrize("name", sql_views.RESULTS)
def test_same_as_the_operator(views, retail, name, monkeypatch):
    monkeypatch.setattr(catalog, "FOCUS_CITY", "North")
    assert ROWS(views.table(name)) == ROWS(catalog.QUERIES[name](retail))


@pytest.mark.parametrize("name", sql_views.RESULTS)
def test_same_columns_and_types(views, retail, name):
    wanted = dict(catalog.QUERIES[name](retail).dtypes)
    assert dict(views.table(name).dtypes) == wanted


def test_all_twelve_views_are_there():
    assert len(sql_views.RESULTS) == 12
    assert {n for n in catalog.QUERIES if n.startswith("v_")} == set(sql_views.RESULTS)


def test_views_can_be_used_by_further_sql(views, retail):
    summed = views.sql("SELECT city, SUM(order_count) AS n FROM v_monthly_revenue_by_city GROUP BY city").collect()
    wanted = {}
    for r in catalog.v_monthly_revenue_by_city(retail).collect():
        wanted[r.city] = wanted.get(r.city, 0) + r.order_count
    assert {r.city: r.n for r in summed} == wanted
