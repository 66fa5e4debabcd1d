"""Hand-written retail tables.

Calendar: orders from 2024-01-05 to 2024-05-02, so 2024-05 is the partial month.
"""

from __future__ import annotations

from datetime import date
from decimal import Decimal as D

from shoptally.sources.retail import RetailTables
from shoptally.sources.schemas import SCHEMAS


def d(text: str) -> date:
    return date.fromisoformat(text)


BASE = {
    "customers": [
        (1, "Ann", "Lee", "ann@x", "North", "Consumer", d("2024-01-01")),
        (2, "Bob", "Ray", "bob@x", "North", "Business", d("2024-01-02")),
        (3, "Cy", "Fox", "cy@x", "South", "Consumer", d("2024-02-10")),
        (4, "Di", "Orr", "di@x", "South", "Consumer", d("2024-02-20")),  # never ordered
        (5, "Ed", "Poe", "ed@x", "South", "Consumer", d("2024-03-01")),  # only a cancelled order
    ],
    "stores": [
        (10, "North A", "North", "N", "r1", d("2020-01-01")),
        (11, "North B", "North", "N", "r1", d("2020-01-01")),
        (20, "South A", "South", "S", "r2", d("2020-01-01")),
        (30, "East A", "East", "E", "r3", d("2020-01-01")),  # no orders
    ],
    "products": [
        (100, "lamp", "Home", D("10.00"), D("6.00")),
        (101, "desk", "Home", D("40.00"), D("25.00")),
        (102, "pen", "Office", D("2.00"), D("1.00")),
        (103, "safe", "Office", D("90.00"), D("50.00")),  # never sold, never stocked
    ],
    "orders": [
        (1, 1, 10, d("2024-01-05"), "online", "completed"),
        (2, 1, 10, d("2024-01-20"), "online", "completed"),
        (3, 2, 11, d("2024-02-03"), "in_store", "completed"),
        (4, 1, 11, d("2024-02-03"), "online", "completed"),
        (5, 3, 20, d("2024-02-15"), "in_store", "completed"),
        (6, 1, 20, d("2024-04-10"), "online", "completed"),
        (7, 5, 20, d("2024-04-11"), "online", "cancelled"),
        (8, 2, 10, d("2024-04-28"), "online", "completed"),
        (9, 3, 20, d("2024-05-02"), "in_store", "completed"),  # partial month
        (10, 2, 11, d("2024-03-09"), "online", "completed"),  # no lines
    ],
    "order_items": [
        (1, 1, 100, 2, D("10.00"), D("20.00")),
        (2, 1, 102, 5, D("2.00"), D("10.00")),
        (3, 2, 101, 1, D("36.00"), D("36.00")),  # 10% off
        (4, 3, 100, 1, D("9.00"), D("9.00")),  # 10% off
        (5, 4, 102, 10, D("2.00"), D("20.00")),
        (6, 5, 100, 3, D("8.00"), D("24.00")),  # 20% off
        (7, 6, 101, 2, D("40.00"), D("80.00")),
        (8, 7, 101, 1, D("40.00"), D("40.00")),  # cancelled order
        (9, 8, 102, 4, D("2.00"), D("8.00")),
        (10, 9, 100, 1, D("10.00"), D("10.00")),
    ],
    "inventory": [
        (1, 10, 100, d("2024-04-21"), 9, 5),
        (2, 10, 100, d("2024-04-28"), 0, 5),
        (3, 20, 100, d("2024-04-28"), 3, 5),
        (4, 10, 101, d("2024-04-28"), 0, 5),
        (5, 10, 102, d("2024-04-28"), 50, 5),
    ],
    "returns": [
        (1, 1, 100, d("2024-01-10"), "Changed mind"),
        (2, 1, 102, d("2024-02-02"), "Damaged item"),
        (3, 7, 101, d("2024-04-15"), "Wrong size"),  # of a cancelled order
    ],
    "marketing_campaigns": [
        (1, "north", "North", "email", d("2024-02-03"), d("2024-04-28"), D("100.00"), D("10.00")),
        (2, "overlap", "North", "tv", d("2024-01-20"), d("2024-02-03"), D("100.00"), D("50.00")),
        (3, "free", "South", "email", d("2024-01-01"), d("2024-12-31"), D("5.00"), D("0.00")),
        (4, "quiet", "East", "email", d("2024-01-01"), d("2024-12-31"), D("5.00"), D("4.00")),
        (5, "early", "South", "tv", d("2023-01-01"), d("2023-06-01"), D("5.00"), D("4.00")),
        (6, "late", "South", "tv", d("2025-01-01"), d("2025-06-01"), D("5.00"), D("4.00")),
    ],
}


def small_retail(spark, **replaced) -> RetailTables:
    """The base tables; keyword arguments replace the rows of single tables."""
    rows = {**BASE, **replaced}
    return RetailTables({name: spark.createDataFrame(rows[name], schema) for name, schema in SCHEMAS.items()})


def with_row(table: str, index: int, **changes) -> list[tuple]:
    """A copy of a base table with one row changed."""
    names = SCHEMAS[table].fieldNames()
    rows = list(BASE[table])
    row = dict(zip(names, rows[index]))
    row.update(changes)
    rows[index] = tuple(row[n] for n in names)
    return rows


def by(df, *keys: str) -> dict:
    """Collected rows as dicts, keyed by one or more columns."""
    out = {}
    for row in df.collect():
        key = tuple(row[k] for k in keys)
        out[key if len(keys) > 1 else key[0]] = row.asDict()
    return out
