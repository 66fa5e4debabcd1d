"""CSV rows that do not fit are set aside; the others come typed."""

import datetime
import decimal

import pytest

from shoptally.plans import catalog
from shoptally.sources.csv_scan import scan_csv

SCHEMA = "id LONG, day DATE, price DECIMAL(10,2), name STRING"


def write(path, text):
    path.write_text(text)
    return str(path)


def test_permuted_header_and_other_columns(spark, tmp_path):
    path = write(tmp_path / "a.csv", 'price,extra,name,id,day\n1.50,zz,"a, ""b""",7,2024-02-29\n,,,8,\n')
    scan = scan_csv(spark, path, SCHEMA)
    assert [tuple(r) for r in scan.rows.collect()] == [
        (7, datetime.date(2024, 2, 29), decimal.Decimal("1.50"), 'a, "b"'),
        (8, None, None, None),
    ]
    assert scan.rows.schema.simpleString() == "struct<id:bigint,day:date,price:decimal(10,2),name:string>"
    assert scan.rejected.count() == 0


def test_bad_cells_are_named(spark, tmp_path):
    rows = ["1,2024-02-30,1.5,x", "two,2024-01-01,cheap,y", "3,2024-01-01,2,z", "4,01/02/2024,3,w", "99999999999999999999,,,"]
    scan = scan_csv(spark, write(tmp_path / "a.csv", "id,day,price,name\n" + "\n".join(rows)), SCHEMA)
    assert [r.id for r in scan.rows.collect()] == [3]
    assert {r.record: r.failed for r in scan.rejected.collect()} == {
        rows[0]: ["day"], rows[1]: ["id", "price"], rows[3]: ["day"], rows[4]: ["id"],
    }


@pytest.mark.parametrize("line", ["1,2024-01-01,1", "1,2024-01-01,1,x,more"])
def test_rows_with_too_few_or_many_cells(spark, tmp_path, line):
    scan = scan_csv(spark, write(tmp_path / "a.csv", f"id,day,price,name\n2,2024-01-01,1,x\n{line}\n"), "id LONG")
    assert [r.id for r in scan.rows.collect()] == [2]
    assert [tuple(r) for r in scan.rejected.collect()] == [(line, [])]


def test_a_missing_column_is_an_error(spark, tmp_path):
    with pytest.raises(ValueError, match="price, name"):
        scan_csv(spark, write(tmp_path / "a.csv", "id,day\n1,2024-01-01\n"), SCHEMA)


def test_empty_file_with_a_header(spark, tmp_path):
    scan = scan_csv(spark, write(tmp_path / "a.csv", "id,day,price,name\n"), SCHEMA)
    assert scan.rows.count() == 0 and scan.rejected.count() == 0


def test_registered_scan_keeps_types(retail):
    rows = catalog.csv_orders(retail)
    assert dict(rows.dtypes)["order_date"] == "date" and rows.count() == retail.orders.count()
