from datetime import date
from decimal import Decimal as D

import pytest
from frames import BASE, by, d, small_retail, with_row
from pyspark.sql import functions as F

from shoptally.operators import analytics, features, quality


def checks(df):
    return {row["check"]: (row["status"], row["detail"]) for row in df.collect()}


def structure(r):
    found = checks(quality.structure(r.tables(), r.primary_keys))
    separate = {
        **checks(quality.primary_keys(r.tables(), r.primary_keys)),
        **checks(quality.duplicates(r.tables())),
        **checks(quality.missing_values(r.tables())),
    }
    assert all(separate[name] == outcome for name, outcome in found.items())
    return separate


def test_clean_tables_pass(retail):
    found = structure(retail)
    assert len(found) == 16 + 10 + 8
    assert {status for status, _ in found.values()} == {"PASS"}
    assert {s for s, _ in checks(quality.referential_integrity(retail.tables())).values()} == {"PASS"}
    assert {s for s, _ in checks(quality.invalid_values(retail.tables())).values()} == {"PASS"}


def test_repeated_rows_keys_and_nulls(spark):
    stores = [*BASE["stores"], BASE["stores"][0], BASE["stores"][0], (10, "X", "North", "N", "r1", d("2020-01-01")),
              (None, None, "South", "S", "r2", d("2020-01-01"))]
    found = structure(small_retail(spark, stores=stores))
    assert found["stores.store_id is unique"] == ("FAIL", "3 duplicate values")
    assert found["stores has no exact duplicate rows"] == ("FAIL", "2 duplicate rows")
    assert found["stores.store_id has no nulls"] == ("FAIL", "1 nulls")
    assert found["stores has zero nulls across all columns"] == ("FAIL", "2 null cells")
    assert found["orders.order_id is unique"] == ("PASS", "0 duplicate values")


def test_semantic_duplicates(spark):
    items = [*BASE["order_items"], (99, 1, 100, 1, D("10.00"), D("10.00"))]
    r = small_retail(spark, order_items=items, customers=with_row("customers", 1, email="ann@x"))
    found = checks(quality.duplicates(r.tables()))
    assert found["order_items has no repeated (order_id, product_id) pairs"] == ("FAIL", "1 repeated pairs")
    assert found["customers.email is unique"] == ("FAIL", "1 duplicate emails")


def test_missing_by_column(spark):
    r = small_retail(spark, customers=with_row("customers", 0, city=None))
    assert by(quality.missing_by_column(r.tables()), "table_name", "column_name") == {
        ("customers", "city"): {"table_name": "customers", "column_name": "city", "null_count": 1}
    }
    assert quality.missing_by_column(r.tables(), only_missing=False).count() == 49  # columns of the eight schemas


@pytest.mark.parametrize(
    ("table", "changes", "check"),
    [
        ("orders", {"customer_id": 77}, "orders.customer_id -> customers.customer_id"),
        ("orders", {"customer_id": None}, "orders.customer_id -> customers.customer_id"),
        ("orders", {"store_id": 77}, "orders.store_id -> stores.store_id"),
        ("order_items", {"order_id": 77}, "order_items.order_id -> orders.order_id"),
        ("order_items", {"product_id": 77}, "order_items.product_id -> products.product_id"),
        ("inventory", {"store_id": 77}, "inventory.store_id -> stores.store_id"),
        ("inventory", {"product_id": 77}, "inventory.product_id -> products.product_id"),
        ("returns", {"order_id": 77}, "returns.order_id -> orders.order_id"),
        ("returns", {"product_id": 77}, "returns.product_id -> products.product_id"),
        ("marketing_campaigns", {"city_target": "Nort"}, "marketing_campaigns.city_target is a known city"),
    ],
)
def test_orphans(spark, table, changes, check):
    r = small_retail(spark, **{table: with_row(table, 0, **changes)})
    found = checks(quality.referential_integrity(r.tables()))
    assert [name for name, (status, _) in found.items() if status == "FAIL"] == [check]
    assert found[check][1].startswith("1 ")


def test_orders_before_signup(spark):
    r = small_retail(spark, customers=with_row("customers", 0, signup_date=d("2024-01-06")))
    assert checks(quality.temporal_integrity(r.orders, r.customers)) == {
        "orders.order_date >= customers.signup_date": ("FAIL", "1 orders precede their customer's signup date")
    }
    (row,) = quality.temporal_offenders(r.orders, r.customers).collect()
    assert (row.order_id, row.customer_id) == (1, 1)


@pytest.mark.parametrize(
    ("table", "changes", "check"),
    [
        ("products", {"unit_price": D("0.00"), "unit_cost": D("-1.00")}, "products.unit_price > 0"),
        ("products", {"unit_cost": D("0.00")}, "products.unit_cost > 0"),
        ("products", {"unit_cost": D("10.00")}, "products.unit_cost < unit_price (positive margin)"),
        ("order_items", {"quantity": 0, "line_total": D("0.00")}, "order_items.quantity > 0"),
        ("order_items", {"unit_price": D("0.00"), "line_total": D("0.00")}, "order_items.unit_price > 0"),
        ("order_items", {"line_total": D("20.02")}, "order_items.line_total == quantity * unit_price"),
        ("inventory", {"stock_level": -1}, "inventory.stock_level >= 0"),
        ("inventory", {"reorder_level": -1}, "inventory.reorder_level >= 0"),
        ("marketing_campaigns", {"budget": D("0.00")}, "marketing_campaigns.budget > 0"),
        ("marketing_campaigns", {"spend": D("-0.01")}, "marketing_campaigns.spend >= 0"),
        ("marketing_campaigns", {"end_date": d("2024-02-02")}, "marketing_campaigns.start_date <= end_date"),
        ("returns", {"return_date": d("2024-01-04")}, "returns.return_date >= the order's order_date"),
    ],
)
def test_invalid_values(spark, table, changes, check):
    r = small_retail(spark, **{table: with_row(table, 0, **changes)})
    failed = {n for n, (status, _) in checks(quality.invalid_values(r.tables())).items() if status == "FAIL"}
    assert check in failed
    if changes.get("unit_cost") != D("-1.00"):
        assert failed == {check}


def test_a_cent_is_tolerated(spark):
    r = small_retail(spark, order_items=with_row("order_items", 0, line_total=D("20.01")))
    assert {s for s, _ in checks(quality.invalid_values(r.tables())).values()} == {"PASS"}


def orders_with(online, cancelled, total):
    return [
        (i, 1, 10, d("2024-01-05"), "online" if i < online else "in_store", "cancelled" if i < cancelled else "completed")
        for i in range(total)
    ]


def test_business_distributions(spark):
    good = small_retail(spark, orders=orders_with(55, 5, 100)).orders
    assert {d for _, d in checks(quality.business_distributions(good)).values()} == {
        "actual online share: 55.0%", "actual cancellation rate: 5.0%",
    }
    assert {s for s, _ in checks(quality.business_distributions(good)).values()} == {"PASS"}
    edge = small_retail(spark, orders=orders_with(65, 10, 100)).orders
    assert {s for s, _ in checks(quality.business_distributions(edge)).values()} == {"PASS"}
    bad = small_retail(spark, orders=orders_with(66, 11, 100)).orders
    assert {s for s, _ in checks(quality.business_distributions(bad)).values()} == {"FAIL"}


def test_missing_months(spark):
    orders = [BASE["orders"][0], BASE["orders"][7]]  # January and April
    found = checks(quality.missing_months(small_retail(spark, orders=orders).orders, small_retail(spark).customers))
    assert found["every month in the window has at least one order"] == ("FAIL", "2 months with zero orders")
    assert found["every month in the window has at least one new signup"] == ("PASS", "0 months with zero signups")


def anomaly_retail(spark, factor, other=1.0):
    """Two years of level revenue in three cities; the last two complete months change by a factor."""
    orders, items = [], []
    for city, store in enumerate((10, 20, 30)):
        for i in range(25):
            key = city * 100 + i + 1
            day = date(2022 + i // 12, i % 12 + 1, 1)
            scale = 1.0
            if i in (22, 23):
                scale = factor if store == 10 else other
            orders.append((key, 1, store, day, "online", "completed"))
            items.append((key, key, 100, 1, D("1000.00"), D(f"{1000 * scale:.2f}")))
    return small_retail(spark, orders=orders, order_items=items)


def anomaly(r, **options):
    return quality.anomaly_changes(r.orders, r.order_items, r.stores, r.as_of, **options)


def test_an_injected_drop_is_found(spark):
    r = anomaly_retail(spark, 0.6)
    changes = anomaly(r)  # the window starts a month late, so half the drop is in the baseline
    assert by(changes, "city")["North"]["change"] == pytest.approx((600 - 866.67) / 866.67, abs=1e-4)
    assert checks(quality.focus_anomaly(changes, "North")) == {
        "North revenue drops by at least 20% in the anomaly window": ("PASS", "North changed -30.8% (867 -> 600)")
    }
    assert checks(quality.anomaly_isolated(changes, "North"))[
        "every city but North stays within +/-25% over the same window"
    ] == ("PASS", "largest change among other cities: +0.0%")


def test_the_intended_window_can_be_given(spark):
    r = anomaly_retail(spark, 0.6)
    rows = by(anomaly(r, anomaly_start=F.lit(d("2023-11-01"))), "city")
    assert rows["North"]["change"] == pytest.approx(-0.4)
    assert rows["South"]["change"] == 0.0


def test_no_drop_and_a_spread_drop_fail(spark):
    level = anomaly(anomaly_retail(spark, 1.0))
    assert checks(quality.focus_anomaly(level, "North")).popitem()[1][0] == "FAIL"
    spread = anomaly(anomaly_retail(spark, 0.6, other=0.5), anomaly_start=F.lit(d("2023-11-01")))
    assert checks(quality.anomaly_isolated(spread, "North")).popitem()[1] == (
        "FAIL", "largest change among other cities: +50.0%",
    )


def test_an_unknown_city_fails_without_error(spark, retail):
    assert checks(quality.focus_anomaly(anomaly(retail), "Nowhere")).popitem()[1] == ("FAIL", "no revenue to compare")


def test_ranges(retail):
    found = checks(quality.ranges(retail.customers, retail.orders, "2024-01-02", "2024-12-31"))
    assert found["orders.customer_id in 1..customer count"] == ("PASS", "0 out-of-range values")
    assert found["customers.signup_date in window"] == ("FAIL", "1 out-of-range values")
    assert found["orders has more than 30000 rows"] == ("FAIL", "10 rows")


def test_battery_score_and_categories(retail):
    battery = quality.battery(retail.tables(), retail.primary_keys, retail.as_of, "North").cache()
    rows = battery.collect()
    assert len(rows) == len({(r.category, r.check) for r in rows}) == 62
    score = quality.quality_score(battery).first()
    assert score.total_checks == 62
    assert score.quality_score == round(100 * score.passed_checks / 62, 1)
    matrix = by(quality.category_summary(battery), "category")
    assert sum(m["PASS"] + m["FAIL"] for m in matrix.values()) == 62
    assert matrix["Primary key uniqueness"] == {"category": "Primary key uniqueness", "FAIL": 0, "PASS": 16}


@pytest.mark.parametrize(("passed", "gate"), [(95, "PASS"), (94, "FAIL")])
def test_gate(spark, passed, gate):
    rows = [("c", str(i), "PASS" if i < passed else "FAIL", "") for i in range(100)]
    df = spark.createDataFrame(rows, "category string, check string, status string, detail string")
    assert quality.quality_score(df).first().gate == gate


def test_table_rules(spark):
    rows = [(1, 5.0, 0.5), (1, 5.0, 0.5), (2, -1.0, 1.5), (None, 1.0, 0.1)]
    df = spark.createDataFrame(rows, "k bigint, v double, rate double")
    rules = quality.TableRules(["k"], ["v"], 5, {"rate": (0, 1)}, whole_row_unique=True, never={"no fives": "v = 5"})
    profile = quality.table_profile("t", df, rules)
    found = {r.check: (r.passed, r.detail) for r in quality.table_checks(profile).collect()}
    assert found == {
        "unique primary key ['k']": (False, "1 duplicate(s)"),
        "no missing primary key ['k']": (False, "1 missing"),
        "no fully duplicate rows": (False, "1 duplicate row(s)"),
        "no fives": (False, "2 violation(s)"),
        "v >= 0": (False, "1 negative row(s)"),
        "rate in [0, 1]": (False, "1 out-of-range row(s)"),
        "row count >= 5": (False, "4 rows"),
    }
    summary = quality.table_summary(profile).first()
    assert (summary.total_checks, summary.passed_checks, summary.status) == (7, 0, "FAIL")
    assert quality.final_listing(profile).first().asDict() == {
        "table_name": "t", "row_count": 4, "column_count": 3, "status": "FAIL",
    }


def test_an_empty_table_has_too_few_rows(spark):
    df = spark.createDataFrame([], "k bigint, v double")
    found = {r.check: r.passed for r in quality.table_checks(quality.table_profile("t", df, quality.TableRules(["k"], ["v"]))).collect()}
    assert found.pop("row count >= 1") is False
    assert set(found.values()) == {True}


def test_built_tables_pass_their_rules(retail):
    rules = quality.analytics_rules(
        retail.customers, retail.stores, retail.products, retail.marketing_campaigns, retail.orders, retail.as_of
    )
    assert len(rules) == 9
    summary = analytics.customer_summary(retail.customers, retail.orders, retail.order_items, retail.as_of)
    daily = analytics.daily_sales(retail.orders, retail.order_items, retail.stores)
    profiles = quality.table_profiles(
        {"customer_summary": (summary, rules["customer_summary"]), "daily_sales": (daily, rules["daily_sales"])}
    )
    assert {r.status for r in quality.table_summary(profiles).collect()} == {"PASS"}
    wanted = quality.feature_rules(F.lit(5), F.lit(4), F.lit(4))["customer_features"]
    profile = quality.table_profile("customer_features", features.customer_features(summary), wanted)
    assert quality.table_summary(profile).first().status == "PASS"


def test_a_profile_lists_failed_checks_and_missing_values(spark):
    rows = [(1, 5.0, None), (1, -1.0, "x"), (None, None, None)]
    df = spark.createDataFrame(rows, "k int, v double, t string")
    profiles = quality.table_profiles({"t1": (df, quality.TableRules(["k"], ["v"], min_rows=4))})
    failed = {(r.check, r.detail) for r in quality.failed_checks(profiles).collect()}
    assert failed == {
        ("unique primary key ['k']", "1 duplicate(s)"), ("no missing primary key ['k']", "1 missing"),
        ("v >= 0", "1 negative row(s)"), ("row count >= 4", "3 rows"),
    }
    missing = {r.column_name: (r.missing, r.missing_pct) for r in quality.missing_report(profiles).collect()}
    assert missing == {"k": (1, 33.3), "v": (1, 33.3), "t": (2, 66.7)}
    (row,) = quality.profile_report(profiles).collect()
    assert (row.status, row.missing_values) == ("FAIL", "k: 1; v: 1; t: 2")
    assert row.failed_checks.split("; ")[2] == "v >= 0: 1 negative row(s)"


def test_a_profile_of_repeated_rows_counts_each_null(spark):
    df = spark.createDataFrame([(1, None)] * 3, "k int, v double")
    rules = quality.TableRules(["k"], whole_row_unique=True)
    missing = quality.missing_report(quality.table_profiles({"t": (df, rules)})).collect()
    assert {r.column_name: r.missing for r in missing} == {"k": 0, "v": 3}
