"""Run a query on Spark and its SQL on DuckDB and describe the first difference."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

_SPARK_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _cell(value):
    if value is None:
        return (0, "")
    if isinstance(value, bool):
        return (1, str(value))
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return (2, "nan") if math.isnan(value) else (2, repr(float(value) + 0.0))
    if isinstance(value, datetime.datetime):
        value = value.date()
    return (3, str(value))


def _sorted(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    result = con.execute(sql)
    described = {d[0]: str(d[1]) for d in result.description}
    columns = [d[0] for d in result.description]
    expected = result.fetchall()
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    for name, spark_type in df.dtypes:
        if _SPARK_TYPES.get(spark_type, spark_type) != described[name]:
            return f"type of {name}: {spark_type} != {described[name]}"
    actual = _sorted([tuple(r) for r in df.collect()], df.columns)
    wanted = _sorted(expected, columns)
    if len(actual) != len(wanted):
        return f"{len(actual)} rows != {len(wanted)}"
    wrong = [(a, w) for a, w in zip(actual, wanted) if a != w]
    if wrong:
        shown = "; ".join(f"{[c[1] for c in a]} != {[c[1] for c in w]}" for a, w in wrong[:3])
        return f"{len(wrong)} of {len(actual)} rows differ: {shown}"
    return None
