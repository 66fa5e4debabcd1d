"""Data-quality checks as DataFrames of (category, check, status, detail).

A failed check is a row, never an exception.  Each function reads its table once and counts
everything it needs in that pass; the counts become check rows by inlining an array.  Key
counts are combined map-side before they are shuffled, so repeated keys are no hot spot.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from shoptally.functions.calendar import date_bounds, month_of, months
from shoptally.functions.frames import series
from shoptally.functions.numeric import percent, half_up, ratio
from shoptally.operators.facts import city_of, store_month_revenue
from shoptally.sources.schemas import CANCELLED, FOREIGN_KEYS

PASS, FAIL = "PASS", "FAIL"
# Thresholds of the checks and of the gate (fixed values).
GATE_SCORE = 95
ONLINE_SHARE = (0.45, 0.65)
CANCEL_RATE = (0.02, 0.10)
LINE_TOLERANCE = "0.01"
FOCUS_DROP = -0.20
OTHERS_WITHIN = 0.25
ANOMALY_MONTHS = 2
BASELINE_MONTHS = 3
MIN_ORDERS = 30_000


@dataclass(frozen=True)
class Check:
    """A named check over a one-row DataFrame of counts; `passed` and `detail` are SQL expressions."""

    category: str
    name: str
    passed: str
    detail: str


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def none_of(category: str, name: str, count: str, what: str) -> Check:
    """Passes if the counted offenders are none."""
    return Check(category, name, f"{count} = 0", f"concat({count}, {_quoted(' ' + what)})")


def _rows(counts: DataFrame, checks: Sequence[Check]) -> DataFrame:
    options = ", ".join(
        f"named_struct('category', {_quoted(c.category)}, 'check', {_quoted(c.name)}, "
        f"'status', if({c.passed}, '{PASS}', '{FAIL}'), 'detail', {c.detail})"
        for c in checks
    )
    return counts.selectExpr(f"inline(array({options}))")


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionAll, frames)


def _total(value: str, name: str) -> Column:
    return F.expr(f"coalesce(sum({value}), 0) AS {name}")


def _any_null(columns: Sequence[str]) -> str:
    return "(" + " OR ".join(f"`{c}` IS NULL" for c in columns) + ")"


def _null_cells(columns: Sequence[str]) -> str:
    return "(" + " + ".join(f"int(`{c}` IS NULL)" for c in columns) + ")"


def _counted(df: DataFrame, columns: Sequence[str | Column]) -> DataFrame:
    """Distinct values of the columns with their row count `n`, combined map-side."""
    return df.groupBy(*columns).agg(F.expr("count(*) AS n"))


def _surplus(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: how many rows repeat an earlier value of the columns (nulls are equal)."""
    return _counted(df, columns).agg(_total("n - 1", "surplus"))


# --- structure: keys, duplicates, missing values --------------------------------------------


def _key_checks(table: str, key: Sequence[str]) -> list[Check]:
    name, category = f"{table}.{'+'.join(key)}", "Primary key uniqueness"
    return [
        none_of(category, f"{name} has no nulls", "key_nulls", "nulls"),
        none_of(category, f"{name} is unique", "key_surplus", "duplicate values"),
    ]


def _duplicate_check(table: str) -> Check:
    return none_of("Duplicate detection", f"{table} has no exact duplicate rows", "surplus", "duplicate rows")


def _missing_check(table: str) -> Check:
    return none_of("Missing values", f"{table} has zero nulls across all columns", "null_cells", "null cells")


def _key_counts(key: Sequence[str]) -> list[Column]:
    return [_total(f"if({_any_null(key)}, n, 0)", "key_nulls"), _total("n - 1", "key_surplus")]


def primary_keys(tables: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]]) -> DataFrame:
    return _union(
        [
            _rows(_counted(df, keys[t]).agg(*_key_counts(keys[t])), _key_checks(t, keys[t]))
            for t, df in tables.items()
        ]
    )


def semantic_duplicates(order_items: DataFrame, customers: DataFrame) -> DataFrame:
    """Rows with different keys that state the same fact."""
    category = "Duplicate detection"
    pairs = none_of(
        category, "order_items has no repeated (order_id, product_id) pairs", "surplus", "repeated pairs"
    )
    emails = none_of(category, "customers.email is unique", "surplus", "duplicate emails")
    return _union(
        [
            _rows(_surplus(order_items, ["order_id", "product_id"]), [pairs]),
            _rows(_surplus(customers, ["email"]), [emails]),
        ]
    )


def duplicates(tables: Mapping[str, DataFrame]) -> DataFrame:
    exact = [_rows(_surplus(df, df.columns), [_duplicate_check(t)]) for t, df in tables.items()]
    return _union([*exact, semantic_duplicates(tables["order_items"], tables["customers"])])


def missing_values(tables: Mapping[str, DataFrame]) -> DataFrame:
    return _union(
        [
            _rows(df.agg(_total(_null_cells(df.columns), "null_cells")), [_missing_check(t)])
            for t, df in tables.items()
        ]
    )


def missing_by_column(tables: Mapping[str, DataFrame], only_missing: bool = True) -> DataFrame:
    """Null count per table and column, in one aggregation per table."""

    def of(table: str, df: DataFrame) -> DataFrame:
        counts = df.agg(*[F.expr(f"count_if(`{c}` IS NULL) AS `{c}`") for c in df.columns])
        cells = ", ".join(f"{_quoted(c)}, `{c}`" for c in df.columns)
        return counts.selectExpr(
            f"{_quoted(table)} AS table_name", f"stack({len(df.columns)}, {cells}) AS (column_name, null_count)"
        )

    listed = _union([of(t, df) for t, df in tables.items()])
    return listed.where("null_count > 0") if only_missing else listed


def structure(tables: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]]) -> DataFrame:
    """Key, exact-duplicate and missing-value checks of each table from a single scan.

    Rows are counted per distinct row, and those counts per key.
    """

    def of(table: str, df: DataFrame) -> DataFrame:
        key = keys[table]
        per_key = (
            _counted(df, df.columns)
            .withColumnRenamed("n", "copies")
            .groupBy(*key)
            .agg(
                F.expr("sum(copies) AS n"),
                F.expr("sum(copies - 1) AS extra"),
                F.expr(f"sum({_null_cells(df.columns)} * copies) AS nulls"),
            )
        )
        counts = per_key.agg(*_key_counts(key), _total("extra", "surplus"), _total("nulls", "null_cells"))
        return _rows(counts, [*_key_checks(table, key), _duplicate_check(table), _missing_check(table)])

    return _union([of(t, df) for t, df in tables.items()])


# --- references -------------------------------------------------------------------------------


def orphans(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """One row: child rows whose value is null or unknown to the parent.

    Child values are counted first, so the join sees each value once.
    """
    known = parent.select(F.col(key).alias("value"))
    values = _counted(child, [F.col(column).alias("value")])
    return values.join(known, "value", "left_anti").agg(_total("n", "orphans"))


def referential_integrity(tables: Mapping[str, DataFrame]) -> DataFrame:
    category = "Referential integrity"
    relations = [
        _rows(
            orphans(tables[child], column, tables[parent], key),
            [none_of(category, f"{child}.{column} -> {parent}.{key}", "orphans", "orphaned rows")],
        )
        for child, column, parent, key in FOREIGN_KEYS
    ]
    strangers = orphans(tables["marketing_campaigns"], "city_target", tables["stores"], "city")
    known_city = none_of(
        category, "marketing_campaigns.city_target is a known city", "orphans", "unrecognised city values"
    )
    return _union([*relations, _rows(strangers, [known_city])])


# --- values -----------------------------------------------------------------------------------


def temporal_integrity(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders before their customer's signup, counted per (customer, day) before the join."""
    signups = customers.select("customer_id", "signup_date")
    counts = (
        _counted(orders, ["customer_id", "order_date"])
        .join(signups, "customer_id")
        .agg(_total("if(order_date < signup_date, n, 0)", "early"))
    )
    check = none_of(
        "Temporal integrity",
        "orders.order_date >= customers.signup_date",
        "early",
        "orders precede their customer's signup date",
    )
    return _rows(counts, [check])


def temporal_offenders(orders: DataFrame, customers: DataFrame, shown: int = 10) -> DataFrame:
    """The first offending orders, by order_id."""
    return (
        orders.select("order_id", "customer_id", "order_date")
        .join(customers.select("customer_id", "signup_date"), "customer_id")
        .where(F.col("order_date") < F.col("signup_date"))
        .orderBy("order_id")
        .limit(shown)
        .select("order_id", "customer_id", "order_date", "signup_date")
    )


# Table -> (check, condition that must never hold, what its offenders are called); the texts are
# fixed values.
VALUE_RULES = {
    "products": [
        ("products.unit_price > 0", "unit_price <= 0", "non-positive prices"),
        ("products.unit_cost > 0", "unit_cost <= 0", "non-positive costs"),
        (
            "products.unit_cost < unit_price (positive margin)",
            "NOT coalesce(unit_cost < unit_price, false)",
            "products priced at or below cost",
        ),
    ],
    "order_items": [
        ("order_items.quantity > 0", "quantity <= 0", "non-positive quantities"),
        ("order_items.unit_price > 0", "unit_price <= 0", "non-positive unit prices"),
        (
            "order_items.line_total == quantity * unit_price",
            f"abs(round(quantity * unit_price, 2) - line_total) > {LINE_TOLERANCE}",
            "mismatched line totals",
        ),
    ],
    "inventory": [
        ("inventory.stock_level >= 0", "stock_level < 0", "negative stock levels"),
        ("inventory.reorder_level >= 0", "reorder_level < 0", "negative reorder levels"),
    ],
    "marketing_campaigns": [
        ("marketing_campaigns.budget > 0", "budget <= 0", "non-positive budgets"),
        ("marketing_campaigns.spend >= 0", "spend < 0", "negative spend values"),
        ("marketing_campaigns.start_date <= end_date", "start_date > end_date", "campaigns with end before start"),
    ],
}


def invalid_values(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Typed, non-null values that make no business sense; one pass per table."""
    category = "Invalid values"

    def of(table: str) -> DataFrame:
        rules = VALUE_RULES[table]
        counts = tables[table].agg(*[F.expr(f"count_if({bad}) AS bad_{i}") for i, (_, bad, _) in enumerate(rules)])
        return _rows(
            counts, [none_of(category, name, f"bad_{i}", what) for i, (name, _, what) in enumerate(rules)]
        )

    ordered = tables["orders"].select("order_id", "order_date")
    dated = (
        _counted(tables["returns"], ["order_id", "return_date"])
        .join(ordered, "order_id")
        .agg(_total("if(return_date < order_date, n, 0)", "early"))
    )
    in_order = none_of(
        category, "returns.return_date >= the order's order_date", "early", "returns dated before their order"
    )
    return _union([*[of(table) for table in VALUE_RULES], _rows(dated, [in_order])])


def ranges(customers: DataFrame, orders: DataFrame, signup_from: str, signup_to: str) -> DataFrame:
    """Key values in 1..n, signups within their window, and a floor on the order volume."""
    category, what = "Ranges", "out-of-range values"
    headcount = customers.agg(F.expr("count(*)")).scalar()
    in_orders = orders.agg(
        F.count_if(~F.col("customer_id").between(F.lit(1), headcount)).alias("strange"),
        F.expr("count(*) AS orders"),
    )
    window = f"DATE '{signup_from}' AND DATE '{signup_to}'"
    in_customers = customers.agg(F.expr(f"count_if(signup_date NOT BETWEEN {window}) AS outside"))
    volume = Check(
        category, f"orders has more than {MIN_ORDERS} rows", f"orders > {MIN_ORDERS}", "concat(orders, ' rows')"
    )
    return _union(
        [
            _rows(
                in_orders, [none_of(category, "orders.customer_id in 1..customer count", "strange", what), volume]
            ),
            _rows(in_customers, [none_of(category, "customers.signup_date in window", "outside", what)]),
        ]
    )


def _percent_text(prefix: str, column: str, sign: str = "") -> str:
    return f"format_string({_quoted(prefix + '%' + sign + '.1f%%')}, {column})"


def business_distributions(orders: DataFrame) -> DataFrame:
    category = "Business distributions"
    online = F.coalesce(ratio(F.count_if(F.col("channel") == "online"), F.count("channel")), F.lit(0.0))
    cancelled = ratio(F.count_if(F.col("order_status") == CANCELLED), F.count(F.lit(1)))
    counts = orders.agg(online.alias("online"), cancelled.alias("cancelled")).select(
        "*", half_up(F.col("online") * 100, 1).alias("online_pct"), half_up(F.col("cancelled") * 100, 1).alias("cancel_pct")
    )

    def within(bounds: tuple[float, float], column: str) -> str:
        return f"{column} BETWEEN {bounds[0]}D AND {bounds[1]}D"

    return _rows(
        counts,
        [
            Check(
                category,
                "online channel share is within 45%-65%",
                within(ONLINE_SHARE, "online"),
                _percent_text("actual online share: ", "online_pct"),
            ),
            Check(
                category,
                "cancellation rate is within 2%-10%",
                within(CANCEL_RATE, "cancelled"),
                _percent_text("actual cancellation rate: ", "cancel_pct"),
            ),
        ],
    )


# --- time series --------------------------------------------------------------------------------


def missing_months(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Months without orders or signups, each series within its own first and last month."""

    def gaps(df: DataFrame, date: str, name: str, what: str) -> DataFrame:
        span = df.agg(F.min(date).alias("lo"), F.max(date).alias("hi"))
        expected = span.select(F.explode(months(F.col("lo"), F.col("hi"))).alias("month"))
        present = df.select(month_of(date).alias("month")).distinct()
        counts = expected.join(present, "month", "left_anti").agg(F.expr("count(*) AS gaps"))
        return _rows(counts, [none_of("Time-series validation", name, "gaps", what)])

    return _union(
        [
            gaps(orders, "order_date", "every month in the window has at least one order", "months with zero orders"),
            gaps(
                customers,
                "signup_date",
                "every month in the window has at least one new signup",
                "months with zero signups",
            ),
        ]
    )


def anomaly_changes(
    orders: DataFrame,
    order_items: DataFrame,
    stores: DataFrame,
    as_of: Column,
    anomaly_months: int = ANOMALY_MONTHS,
    anomaly_start: Column | None = None,
) -> DataFrame:
    """city, pre, post, change: mean monthly revenue before and inside the anomaly window.

    The latest month with revenue is partial and left out.  The window starts
    `anomaly_months - 1` months before the month of `as_of` (or at `anomaly_start`), and the
    baseline is the three remaining months before it.
    """
    per_month = (
        store_month_revenue(orders, order_items)
        .join(city_of(stores), "store_id")
        .groupBy("city", "month")
        .agg(F.sum("revenue").cast("double").alias("revenue"))
    )
    start = anomaly_start if anomaly_start is not None else F.add_months(month_of(as_of), 1 - anomaly_months)
    inside = F.col("inside")
    newest_first = W.partitionBy("inside").orderBy(F.col("month").desc())
    # Distinct months, so these windows are as long as the calendar.
    compared = (
        per_month.select("month")
        .distinct()
        .withColumn("next", F.lead("month").over(series([], "month")))
        .where(F.col("next").isNotNull())
        .select("month", (F.col("month") >= start).alias("inside"))
        .withColumn("recency", F.row_number().over(newest_first))
        .where(inside | (F.col("recency") <= BASELINE_MONTHS))
    )
    return (
        per_month.join(compared, "month")
        .groupBy("city")
        .agg(
            F.avg(F.when(~inside, F.col("revenue"))).alias("pre"),
            F.avg(F.when(inside, F.col("revenue"))).alias("post"),
        )
        .withColumn("change", ratio(F.col("post") - F.col("pre"), F.col("pre")))
    )


def focus_anomaly(changes: DataFrame, city: str) -> DataFrame:
    """The focus city must have dropped by at least 20%."""
    counts = (
        changes.where(F.col("city") == city)
        .agg(*[F.expr(f"max({c}) AS {c}") for c in ("pre", "post", "change")])
        .withColumn("change_pct", half_up(F.col("change") * 100, 1))
    )
    moved = _percent_text(f"{city} changed ", "change_pct", "+")
    check = Check(
        "Focus anomaly",
        f"{city} revenue drops by at least 20% in the anomaly window",
        f"change <= {FOCUS_DROP}D",
        f"coalesce(concat({moved}, ' (', format_number(pre, 0), ' -> ', format_number(post, 0), ')'), "
        "'no revenue to compare')",
    )
    return _rows(counts, [check])


def anomaly_isolated(changes: DataFrame, city: str) -> DataFrame:
    """No other city may have moved by more than 25% over the same months."""
    counts = (
        changes.where(F.col("city") != city)
        .agg(F.expr("coalesce(max(abs(change)), 0D) AS largest"))
        .withColumn("largest_pct", half_up(F.col("largest") * 100, 1))
    )
    check = Check(
        "Focus anomaly",
        f"every city but {city} stays within +/-25% over the same window",
        f"largest <= {OTHERS_WITHIN}D",
        _percent_text("largest change among other cities: ", "largest_pct", "+"),
    )
    return _rows(counts, [check])


# --- the battery ----------------------------------------------------------------------------------


def battery(
    tables: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]], as_of: Column, focus_city: str
) -> DataFrame:
    """All checks of the raw tables."""
    orders, items, customers, stores = (tables[t] for t in ("orders", "order_items", "customers", "stores"))
    changes = anomaly_changes(orders, items, stores, as_of)
    return _union(
        [
            structure(tables, keys),
            semantic_duplicates(items, customers),
            referential_integrity(tables),
            temporal_integrity(orders, customers),
            invalid_values(tables),
            business_distributions(orders),
            missing_months(orders, customers),
            focus_anomaly(changes, focus_city),
            anomaly_isolated(changes, focus_city),
        ]
    )


def quality_score(checks: DataFrame) -> DataFrame:
    passed = F.count_if(F.col("status") == PASS)
    return (
        checks.agg(F.count(F.lit(1)).alias("total_checks"), passed.alias("passed_checks"))
        .withColumn("quality_score", half_up(ratio(F.lit(100.0) * F.col("passed_checks"), F.col("total_checks")), 1))
        .withColumn(
            "gate",
            F.when(100 * F.col("passed_checks") >= GATE_SCORE * F.col("total_checks"), PASS).otherwise(FAIL),
        )
    )


def category_summary(checks: DataFrame) -> DataFrame:
    return checks.groupBy("category").pivot("status", [FAIL, PASS]).agg(F.count(F.lit(1))).na.fill(0)


# --- validation of built tables ---------------------------------------------------------------------


@dataclass(frozen=True)
class TableRules:
    """What a built table must satisfy.  `never` maps a check to a condition that must not hold."""

    key: Sequence[str]
    non_negative: Sequence[str] = ()
    min_rows: int | Column = 1
    within: Mapping[str, tuple[int, int]] = field(default_factory=dict)
    whole_row_unique: bool = False
    never: Mapping[str, str] = field(default_factory=dict)


def table_profile(name: str, df: DataFrame, rules: TableRules) -> DataFrame:
    """One row: table, rows, columns, nulls of each column and the outcome of each rule, in one pass over the table."""
    bad = [
        *[(check, condition, "violation(s)") for check, condition in rules.never.items()],
        *[(f"{c} >= 0", f"`{c}` < 0", "negative row(s)") for c in rules.non_negative],
        *[
            (f"{c} in [{lo}, {hi}]", f"`{c}` NOT BETWEEN {lo} AND {hi}", "out-of-range row(s)")
            for c, (lo, hi) in rules.within.items()
        ],
    ]
    if rules.whole_row_unique:
        rows, copies = _counted(df, df.columns).withColumnRenamed("n", "copies"), "copies"
    else:
        rows, copies = df, "1"
    # Each key holds its sums in memory, so there are none for what cannot be.
    nullable = [f.nullable for f in df.schema.fields]
    per_key = rows.groupBy(*rules.key).agg(
        F.expr(f"sum({copies}) AS n"),
        *([F.expr(f"sum({copies} - 1) AS extra")] if rules.whole_row_unique else []),
        *[F.expr(f"sum(if({condition}, {copies}, 0)) AS bad_{i}") for i, (_, condition, _) in enumerate(bad)],
        *[F.expr(f"sum(if(`{c}` IS NULL, {copies}, 0)) AS null_{i}") for i, c in enumerate(df.columns) if nullable[i]],
    )
    floor = rules.min_rows if isinstance(rules.min_rows, Column) else F.lit(rules.min_rows)
    counts = per_key.agg(
        _total("n", "row_count"),
        *_key_counts(rules.key),
        *([_total("extra", "surplus")] if rules.whole_row_unique else []),
        *[_total(f"bad_{i}", f"bad_{i}") for i in range(len(bad))],
        *[_total(f"null_{i}", f"null_{i}") for i in range(len(df.columns)) if nullable[i]],
    ).withColumn("floor", floor)
    nulls = [
        f"named_struct('column', {_quoted(c)}, 'n', {f'null_{i}' if nullable[i] else '0L'})"
        for i, c in enumerate(df.columns)
    ]

    listed = str(list(rules.key))
    checks = [
        (f"unique primary key {listed}", "key_surplus", "duplicate(s)"),
        (f"no missing primary key {listed}", "key_nulls", "missing"),
        *([("no fully duplicate rows", "surplus", "duplicate row(s)")] if rules.whole_row_unique else []),
        *[(check, f"bad_{i}", what) for i, (check, _, what) in enumerate(bad)],
    ]
    outcomes = [
        f"named_struct('check', {_quoted(check)}, 'passed', {count} = 0, 'detail', concat({count}, {_quoted(' ' + what)}))"
        for check, count, what in checks
    ]
    outcomes.append(
        "named_struct('check', concat('row count >= ', floor), 'passed', coalesce(row_count >= floor, false), "
        "'detail', concat(row_count, ' rows'))"
    )
    return counts.selectExpr(
        f"{_quoted(name)} AS table_name",
        "row_count",
        f"{len(df.columns)} AS column_count",
        f"array({', '.join(outcomes)}) AS checks",
        f"array({', '.join(nulls)}) AS nulls",
    )


def table_profiles(tables: Mapping[str, tuple[DataFrame, TableRules]]) -> DataFrame:
    return _union([table_profile(name, df, rules) for name, (df, rules) in tables.items()])


def table_checks(profiles: DataFrame) -> DataFrame:
    return profiles.selectExpr("table_name", "inline(checks)")


_PASSED = "size(filter(checks, c -> c.passed))"
_STATUS = f"if({_PASSED} = size(checks), '{PASS}', '{FAIL}') AS status"


def table_summary(profiles: DataFrame) -> DataFrame:
    return profiles.selectExpr(
        "table_name", "size(checks) AS total_checks", f"{_PASSED} AS passed_checks", _STATUS
    )


def failed_checks(profiles: DataFrame) -> DataFrame:
    """(table_name, check, detail) of the rules that do not hold."""
    return table_checks(profiles).where("NOT passed").drop("passed")


def missing_report(profiles: DataFrame) -> DataFrame:
    """(table_name, column_name, missing, missing_pct) of every column, those without nulls too."""
    listed = profiles.selectExpr("table_name", "row_count", "inline(nulls)")
    return listed.select(
        "table_name",
        F.col("column").alias("column_name"),
        F.col("n").alias("missing"),
        percent(F.col("n"), F.col("row_count")).alias("missing_pct"),
    )


def profile_report(profiles: DataFrame) -> DataFrame:
    """One row per table: its size and status, the rules that do not hold, and the columns that have nulls."""
    return profiles.selectExpr(
        "table_name",
        "row_count",
        "column_count",
        _STATUS,
        "array_join(transform(filter(checks, c -> NOT c.passed), c -> concat(c.check, ': ', c.detail)), '; ') AS failed_checks",
        "array_join(transform(filter(nulls, c -> c.n > 0), c -> concat(c.column, ': ', c.n)), '; ') AS missing_values",
    )


def final_listing(profiles: DataFrame) -> DataFrame:
    return profiles.selectExpr("table_name", "row_count", "column_count", _STATUS)


def analytics_rules(
    customers: DataFrame,
    stores: DataFrame,
    products: DataFrame,
    campaigns: DataFrame,
    orders: DataFrame,
    as_of: Column,
) -> dict[str, TableRules]:
    """Rules of the analytics tables; expected sizes are counted from the raw tables."""

    def size(df: DataFrame) -> Column:
        return df.agg(F.count(F.lit(1))).scalar()

    span = date_bounds(orders, "order_date")
    day_count = F.datediff(span["hi"], span["lo"]) + 1
    month_count = F.size(months(span["lo"], F.add_months(as_of, -1)))
    return {
        "customer_summary": TableRules(
            ["customer_id"],
            ["total_spent", "total_orders", "total_items"],
            size(customers),
            never={"no order before signup_date": "first_order_date < signup_date"},
        ),
        "daily_sales": TableRules(
            ["date", "store_id"], ["revenue", "orders", "units_sold"], day_count * size(stores)
        ),
        "monthly_sales": TableRules(["month"], ["revenue", "orders", "units_sold"]),
        "product_performance": TableRules(["product_id"], ["revenue", "units_sold"], size(products)),
        "product_monthly_sales": TableRules(
            ["product_id", "month"], ["units_sold", "revenue", "returns"], month_count * size(products)
        ),
        "store_performance": TableRules(["store_id"], ["revenue", "orders"], size(stores)),
        "inventory_health": TableRules(
            ["product_id"], ["current_stock", "units_sold_last_30_days"], size(products)
        ),
        "marketing_performance": TableRules(
            ["campaign_id"], ["marketing_spend", "revenue_generated"], size(campaigns)
        ),
        "returns_summary": TableRules(["product_id"], ["returns", "units_sold"], size(products)),
    }


def feature_rules(
    customer_count: Column, product_count: Column, store_count: Column
) -> dict[str, TableRules]:
    """Rules of the feature tables; expected sizes are those of the analytics tables."""
    share = (0, 1)
    return {
        "sales_forecasting_features": TableRules(
            ["month"], ["revenue", "orders", "customers", "units_sold"], 12, whole_row_unique=True
        ),
        "customer_features": TableRules(
            ["customer_id"], ["total_orders", "total_spent", "total_items"], customer_count, whole_row_unique=True
        ),
        "product_features": TableRules(
            ["product_id"],
            ["units_sold", "revenue", "sales_last_30_days"],
            product_count,
            {"return_rate": share, "average_discount": share},
            whole_row_unique=True,
        ),
        "store_features": TableRules(
            ["store_id"],
            ["orders", "customers", "revenue", "average_daily_sales"],
            store_count,
            {"return_rate": share},
            whole_row_unique=True,
        ),
    }
