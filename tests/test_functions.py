from decimal import Decimal as D

import pytest
from frames import d
from pyspark.sql import functions as F

from shoptally.functions import calendar, numeric


def value(spark, column):
    return spark.range(1).select(column).first()[0]


@pytest.mark.parametrize(
    ("x", "digits", "expected"),
    [(1.005, 2, 1.01), (2.675, 2, 2.68), (-1.005, 2, -1.01), (0.25, 1, 0.3), (-0.04, 1, 0.0), (0.00005, 4, 0.0001),
     (1.00499996, 2, 1.0), (12.3499996, 1, 12.3)],
)
def test_ties_round_away_from_zero(spark, x, digits, expected):
    assert value(spark, numeric.half_up(F.lit(x), digits)) == expected


def test_ratios_without_a_denominator(spark):
    nothing = F.lit(None).cast("double")
    for whole in (F.lit(0), nothing):
        assert value(spark, numeric.ratio(F.lit(3), whole)) is None
        assert value(spark, numeric.ratio_or_zero(F.lit(3), whole, 2)) == 0.0
        assert value(spark, numeric.percent(F.lit(3), whole)) is None
    assert value(spark, numeric.percent(F.lit(1), F.lit(8))) == 12.5


def test_money_is_rounded_as_decimal(spark):
    assert value(spark, numeric.money(F.lit(D("10.0050")))) == 10.01
    assert value(spark, numeric.money_or_zero(F.lit(None).cast("decimal(18,4)"))) == 0.0


def test_months(spark):
    lo, hi = F.lit(d("2023-11-30")), F.lit(d("2024-02-01"))
    assert value(spark, calendar.months(lo, hi)) == [d("2023-11-01"), d("2023-12-01"), d("2024-01-01"), d("2024-02-01")]
    assert value(spark, calendar.months(hi, lo)) == []
    assert value(spark, calendar.months_apart(lo, hi)) == 3
    assert value(spark, calendar.previous_month(hi)) == d("2024-01-01")
    assert value(spark, calendar.month_label(lo)) == "2023-11"
    assert value(spark, calendar.parse_month(F.lit("2023-11"))) == d("2023-11-01")


def test_rounding_of_large_doubles(spark):
    from shoptally.functions.numeric import half_up

    values = [1e300, -1e21, 123456789012345678.0, 1.005, float("inf"), None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r[0] for r in df.select(half_up(df.v, 2)).collect()] == [1e300, -1e21, 123456789012345678.0, 1.01, float("inf"), None]
    assert str(spark.sql("SELECT double('NaN') AS v").select(half_up(F.col("v"), 2)).first()[0]) == "nan"
