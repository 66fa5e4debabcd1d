import random
from datetime import date

import numpy as np
import pytest
from frames import by, d, small_retail
from pyspark.sql import functions as F

from shoptally.operators import profiles


def column(spark, values, kind="double"):
    return spark.createDataFrame([(v,) for v in values], f"x {kind}")


def test_counts_and_shares(retail):
    counts = by(profiles.table_counts(retail.tables()), "table_name")
    assert (counts["orders"]["row_count"], counts["orders"]["column_count"]) == (10, 6)
    shares = by(profiles.value_shares(retail.orders, "channel"), "value")
    assert shares["online"]["share"] == 0.7 and shares["in_store"]["n"] == 3
    cities = by(profiles.stores_per_city(retail.stores), "city")
    assert cities["North"] == {"city": "North", "store_count": 2, "store_ids": "10,11"}
    assert by(profiles.count_by(retail.products, "category", "products"), "category")["Home"]["products"] == 2
    assert by(profiles.campaign_spend_by_city(retail.marketing_campaigns), "city")["North"]["total_spend"] == 60.0


def test_month_and_city_tables(retail):
    cities = ["North", "South", "East"]
    wide = by(profiles.across(profiles.monthly_orders(retail.orders, retail.stores), "orders", cities), "month")
    assert (wide[d("2024-04-01")]["North"], wide[d("2024-04-01")]["South"], wide[d("2024-04-01")]["East"]) == (1, 2, 0)
    newest = profiles.monthly_orders(retail.orders, retail.stores, 2)
    assert {r.month for r in newest.collect()} == {d("2024-04-01"), d("2024-05-01")}
    gross = profiles.monthly_gross_revenue(retail.orders, retail.order_items, retail.stores, 4).collect()
    found = {(r.month, r.city): r.revenue for r in gross}
    assert found[d("2024-04-01"), "South"] == 120.0  # cancelled orders included
    assert len({m for m, _ in found}) == 4 and d("2024-03-01") not in {m for m, _ in found}
    signups = {(r.month, r.city): r.signups for r in profiles.monthly_signups(retail.customers).collect()}
    assert signups[d("2024-02-01"), "South"] == 2


def test_any_number_of_cities(spark):
    customers = spark.range(1500).selectExpr("concat('c', id) AS city", "DATE '2024-01-05' AS signup_date")
    assert profiles.monthly_signups(customers).count() == 1500


def test_returned_share(retail):
    rows = by(profiles.returned_share_by_city(retail.orders, retail.returns, retail.stores, retail.as_of, 4), "city")
    assert rows["North"]["orders"] == 6 and rows["North"]["returned_share"] == round(1 / 6, 4)
    recent = by(profiles.returned_share_by_city(retail.orders, retail.returns, retail.stores, retail.as_of, 3), "city")
    assert recent["North"]["returned_share"] == 0.0


def test_eligible_customers(retail):
    rows = by(profiles.eligible_customers(retail.customers, retail.orders), "month")
    assert [rows[date(2024, m, 1)]["eligible_customers"] for m in range(1, 6)] == [2, 4, 5, 5, 5]


def test_signups_before_the_calendar_count(spark):
    r = small_retail(spark, customers=[(1, "a", "b", "e", "North", "Consumer", d("2019-01-01"))])
    assert {v["eligible_customers"] for v in by(profiles.eligible_customers(r.customers, r.orders), "month").values()} == {1}


def test_month_parts_and_email(retail):
    row = by(profiles.month_parts(retail.orders), "month_label")["2024-04"]
    assert (row["month"], row["year"], row["quarter"], row["month_number"]) == (d("2024-04-01"), 2024, 2, 4)
    email = profiles.customer_email(F.col("first_name"), F.col("last_name"), F.col("customer_id"))
    assert retail.customers.where("customer_id = 1").select(email).first()[0] == "ann.lee1@example.com"


def test_histogram_matches_numpy(spark):
    values = [random.Random(1).expovariate(0.1) for _ in range(500)]
    counts, edges = np.histogram(values, bins=30)
    rows = profiles.histogram(column(spark, [*values, None]), "x").orderBy("bin").collect()
    assert [r.n for r in rows] == counts.tolist()
    assert [r.bin_start for r in rows] == pytest.approx(edges[:-1], abs=1e-4)
    assert rows[-1].bin_end == pytest.approx(edges[-1], abs=1e-4)


def test_histogram_of_equal_values_and_of_nothing(spark):
    counts, edges = np.histogram([7.0] * 4, bins=30)
    rows = profiles.histogram(column(spark, [7.0] * 4), "x").orderBy("bin").collect()
    assert [r.n for r in rows] == counts.tolist() and rows[0].bin_start == edges[0] == 6.5
    assert sum(r.n for r in profiles.histogram(column(spark, []), "x").collect()) == 0


@pytest.mark.parametrize(
    "values",
    [
        [1.0, 2.0, 3.0, 4.0],
        [5.0],
        [3.0] * 9,
        [0.0] * 900 + [1e9],  # an outlier puts everything else in one bucket
        [round(random.Random(3).gauss(50, 20), 2) for _ in range(997)],
        [float(i % 7) for i in range(1000)],
    ],
)
def test_quartiles_are_exact(spark, values):
    row = profiles.describe(column(spark, [*values, None]), ["x"]).first()
    assert row["count"] == len(values)
    assert [row.p25, row.p50, row.p75] == pytest.approx(np.percentile(values, [25, 50, 75]), abs=1e-4)
    assert (row["min"], row["max"]) == (min(values), max(values))
    assert row["mean"] == pytest.approx(np.mean(values), abs=1e-4)
    if len(values) > 1:
        assert row["std"] == pytest.approx(np.std(values, ddof=1), abs=1e-4)


def test_describe_keeps_columns_apart(spark):
    df = spark.createDataFrame([(i, 100 - i) for i in range(101)], "a int, b int")
    rows = by(profiles.describe(df, ["a", "b"]), "column_name")
    assert rows["a"]["p25"] == 25.0 and rows["b"]["p75"] == 75.0


def test_quartiles_with_an_outlier_are_found_in_small_ranges(spark):
    """One value of 1e300 does not leave all others in one range."""
    df = spark.range(40_000).selectExpr("CASE WHEN id = 0 THEN 1e300 ELSE 1 + id * 1e-9 END AS x")
    row = profiles.describe(df, ["x"]).first()
    values = [1e300, *(1 + i * 1e-9 for i in range(1, 40_000))]
    assert [row.p25, row.p50, row.p75] == pytest.approx(np.percentile(values, [25, 50, 75]), abs=1e-4)
    from shoptally.operators.ordering import sorted_in_ranges

    distinct = df.selectExpr("'x' AS column", "x").distinct()
    sizes = [r["count"] for r in sorted_in_ranges(distinct, ["column", "x"]).groupBy("_o_range").count().collect()]
    assert max(sizes) < 40_000 / 2


def test_newest_signups(spark):
    df = spark.createDataFrame([(1, "2024-01-05", "A"), (2, "2024-02-05", "A"), (3, "2024-03-05", "A")], "i int, d string, city string")
    signups = profiles.monthly_signups(df.selectExpr("CAST(d AS DATE) AS signup_date", "city"), 2).collect()
    assert sorted(str(r.month) for r in signups) == ["2024-02-01", "2024-03-01"]
