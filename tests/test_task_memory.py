"""What a task holds at once: rows that fan out or meet several hash tables are not merged into few tasks."""

import pytest
from frames import small_retail

from shoptally.operators import quality
from shoptally.plans import catalog
from shoptally.plans.catalog import QUERIES
from shoptally.sources.star_schema import StarSchemaRetail

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().toString().split("== Physical Plan ==")[1]


def tasks_of(spark, df):
    return df.rdd.getNumPartitions(), int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_the_derived_inventory_keeps_all_shuffle_partitions(spark):
    tasks, wanted = tasks_of(spark, StarSchemaRetail(spark, SF_DIR).inventory)
    assert tasks == wanted


def test_lines_are_not_combined_before_they_become_snapshots(spark):
    plan = plan_of(StarSchemaRetail(spark, SF_DIR).inventory)
    assert "HashAggregate" not in plan[plan.index("Exchange") :]


def test_the_calendar_of_products_keeps_all_shuffle_partitions(spark):
    tasks, wanted = tasks_of(spark, QUERIES["product_monthly_sales"](StarSchemaRetail(spark, SF_DIR)))
    assert tasks == wanted


@pytest.mark.parametrize("whole_row_unique", [False, True])
def test_a_profile_sums_only_what_can_be(spark, whole_row_unique):
    df = spark.sql("SELECT id % 3 AS k, nullif(id, 1) AS a, id * 2 AS b FROM range(5)")
    rules = quality.TableRules(["k"], ["b"], whole_row_unique=whole_row_unique)
    profile = quality.table_profile("t", df, rules)
    plan = plan_of(profile)
    assert "null_1" in plan and "null_2" not in plan and ("extra" in plan) == whole_row_unique
    row = profile.first()
    assert [(n.column, n.n) for n in row.nulls] == [("k", 0), ("a", 1), ("b", 0)]
    assert row.row_count == 5 and row.checks[0].detail == "2 duplicate(s)"


def test_features_are_made_of_the_kept_tables(spark):
    _, features_of = catalog.built_tables(small_retail(spark))
    assert "Join" not in plan_of(features_of["customer_features"])
