import json
import math

import pytest
from frames import BASE, by

from shoptally.operators import views
from shoptally.plans import catalog
from shoptally.sources import files
from shoptally.sources.retail import RetailDirectory
from shoptally.sources.schemas import FOREIGN_KEYS, LOAD_ORDER, SCHEMAS


def test_parents_load_before_children():
    for child, _, parent, _ in FOREIGN_KEYS:
        assert LOAD_ORDER.index(parent) < LOAD_ORDER.index(child)


def test_csv_and_parquet_round_trip(spark, retail, tmp_path):
    for fmt, suffix in (("csv", ".csv"), ("parquet", "")):
        for name, df in retail.tables().items():
            files.save_table(df, f"{tmp_path}/{fmt}/{name}{suffix}", fmt)
        read = RetailDirectory(spark, f"{tmp_path}/{fmt}", fmt)
        for name in LOAD_ORDER:
            table = getattr(read, name)
            assert [(f.name, f.dataType) for f in table.schema] == [(f.name, f.dataType) for f in SCHEMAS[name]]
            assert sorted(map(tuple, table.collect())) == sorted(BASE[name])
        revenue = views.monthly_revenue_by_city(read.orders, read.order_items, read.stores)
        assert revenue.count() == 6


def test_try_load_never_raises(spark, tmp_path):
    assert files.try_load(spark, f"{tmp_path}/nowhere") is None
    assert files.try_load(spark, f"{tmp_path}/nowhere.csv", SCHEMAS["stores"], "csv") is None
    broken = tmp_path / "broken.parquet"
    broken.write_bytes(b"this is not a parquet file")
    assert files.try_load(spark, str(broken)) is None
    assert files.try_load(spark, str(broken), SCHEMAS["stores"]) is None


def test_try_load_returns_the_table(spark, retail, tmp_path):
    files.save_table(retail.stores, f"{tmp_path}/stores")
    assert files.try_load(spark, f"{tmp_path}/stores").count() == 4


def test_append_and_refresh(spark, retail, tmp_path):
    target = str(tmp_path)
    first = files.load_all(lambda name: retail.tables()[name], target)
    assert list(first) == list(LOAD_ORDER)
    assert first["order_items"] == 10
    files.load_all(lambda name: retail.tables()[name], target)
    assert spark.read.parquet(f"{target}/orders").count() == 20
    files.load_all(lambda name: retail.tables()[name], target, refresh=True)
    assert spark.read.parquet(f"{target}/orders").count() == 10


def test_views_can_be_named_for_sql(spark, retail):
    files.register_views(spark, {"city_revenue": catalog.v_monthly_revenue_by_city(retail)})
    assert spark.sql("SELECT SUM(revenue) FROM city_revenue WHERE city = 'North'").first()[0] == 103.0


def test_records_have_nulls_for_nan(spark):
    df = spark.createDataFrame([(1, math.nan, None), (2, 1.5, "x")], "k int, v double, t string")
    records = [json.loads(r.record) for r in files.to_records(df).collect()]
    assert sorted(records, key=lambda r: r["k"]) == [{"k": 1, "v": None, "t": None}, {"k": 2, "v": 1.5, "t": "x"}]


def test_exported_records_equal_the_table(retail):
    table = by(catalog.monthly_sales(retail), "month")
    records = [json.loads(r.record) for r in catalog.export_records_json(retail).collect()]
    assert {r["month"]: r for r in records} == table


def test_csv_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("name,extra,id\nx,1,7\n")
    rows = files.read_table(spark, str(tmp_path / "a.csv"), "id INT, name STRING", "csv").collect()
    assert [tuple(r) for r in rows] == [(7, "x")]
    assert files.try_load(spark, str(tmp_path / "a.csv"), "id INT, other STRING", "csv") is None


def test_a_bad_cell_is_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,name\n1,x\nfour,y\n")
    assert files.try_load(spark, str(tmp_path / "a.csv"), "id INT, name STRING", "csv") is None


def test_a_damaged_later_file_is_noticed(spark, tmp_path):
    spark.range(100).repartition(1).write.parquet(str(tmp_path / "t"))
    (tmp_path / "t" / "part-99999.parquet").write_bytes(b"PAR1 damaged PAR1")
    assert files.try_load(spark, str(tmp_path / "t"), "id LONG") is None


def test_a_second_engine_reads_the_records(spark):
    """DuckDB takes each field out of the exported JSON; the values are those of the table."""
    import datetime
    import decimal

    import duckdb

    text = 'q"uo\\te\n\té/\x01'
    table = [
        (1, text, 2.5, decimal.Decimal("12.30"), datetime.date(2024, 2, 29), True),
        (2, None, math.nan, None, None, None),
        (3, "", -0.0, decimal.Decimal("-0.01"), datetime.date(1, 1, 1), False),
        (2**60, "x", 1e300, decimal.Decimal("9999999.99"), datetime.date(9999, 12, 31), True),
    ]
    df = spark.createDataFrame(table, "k long, t string, v double, m decimal(9,2), d date, b boolean")
    records = [r.record for r in files.to_records(df).collect()]
    fields = {"k": "BIGINT", "t": "VARCHAR", "v": "DOUBLE", "m": "DECIMAL(9,2)", "d": "DATE", "b": "BOOLEAN"}
    cells = ", ".join(f"CAST(json_extract_string(r, '$.{c}') AS {kind}) AS {c}" for c, kind in fields.items())
    con = duckdb.connect()
    found = [con.execute(f"SELECT json_keys(r), {cells} FROM (SELECT CAST(? AS JSON) AS r)", [x]).fetchone() for x in records]
    assert all(keys == list(fields) for keys, *_ in found)
    wanted = [tuple(None if isinstance(x, float) and math.isnan(x) else x for x in row) for row in table]
    assert [row[1:] for row in found] == wanted
