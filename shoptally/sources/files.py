"""Readers and writers for table directories.

Tables move between layers as Parquet; CSV with a header is kept as an exchange format.
Schemas are always declared for CSV, never inferred.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable, Mapping

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StringType, StructField, StructType

from shoptally.sources.loads import Loads
from shoptally.sources.schemas import LOAD_ORDER, SCHEMAS

log = logging.getLogger(__name__)


def read_table(
    spark: SparkSession, path: str, schema: StructType | str | None = None, fmt: str = "parquet"
) -> DataFrame:
    """A table; columns of a CSV file are found by the names in its header, and a bad cell is an error."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    if fmt == "csv":
        options = {"header": True, "escape": '"', "dateFormat": "yyyy-MM-dd", "mode": "FAILFAST"}
        if schema is None:
            return spark.read.options(**options).csv(path)
        # With a schema Spark takes columns by place, so the header's order comes first.
        header = spark.read.option("header", True).csv(path).columns
        wanted = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
        missing = [f.name for f in wanted if f.name not in header]
        if missing:
            raise ValueError(f"{path} has no column {', '.join(missing)}")
        types = {f.name: f for f in wanted}
        in_file = StructType([types.get(name, StructField(name, StringType())) for name in header])
        found = spark.read.schema(in_file).options(enforceSchema=False, **options).csv(path)
        return found.select(*wanted.fieldNames())
    return reader.format(fmt).load(path)


def try_load(
    spark: SparkSession, path: str, schema: StructType | str | None = None, fmt: str = "parquet"
) -> DataFrame | None:
    """The table, or None if it is absent or unreadable.  Never raises.

    All of it is read once, because a damaged file shows only when a task gets to it.
    """
    try:
        df = read_table(spark, path, schema, fmt)
        df.write.format("noop").mode("overwrite").save()
        return df
    except (PySparkException, Py4JError, OSError, ValueError) as problem:
        log.info("no table at %s: %s", path, type(problem).__name__)
        return None


def save_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: str | None = None) -> None:
    """Replace the table at path.

    With `partition_by`, rows are first rebalanced by that column: AQE then gives every
    partition value as many tasks as its size needs, so there are neither tiny files nor one
    huge task for a large value.
    """
    if partition_by is not None:
        df = df.hint("rebalance", partition_by)
    writer = df.write.mode("overwrite")
    if partition_by is not None:
        writer = writer.partitionBy(partition_by)
    if fmt == "csv":
        writer.options(header=True, escape='"').csv(path)
    else:
        writer.format(fmt).save(path)


def append_table(df: DataFrame, path: str, fmt: str = "parquet") -> int:
    """Append a batch and return its row count, counted while it is written."""
    from pyspark.sql import Observation

    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("append").format(fmt).save(path)
    return seen.get["rows"]


def append_jdbc(df: DataFrame, url: str, table: str, properties: Mapping[str, str] | None = None) -> None:
    """Append to a database table in batches of 5,000 rows per insert, one connection per task."""
    df.write.mode("append").option("batchsize", 5000).jdbc(url, table, properties=dict(properties or {}))


def load_all(
    read: Callable[[str], DataFrame], target: str, refresh: bool = False, load: str | None = None
) -> dict[str, int]:
    """Load the eight tables, parents first; a repeated ``load`` id adds nothing, `refresh` replaces what is there.

    Until all of them are written, readers see the tables as they were.
    """
    tables = {name: read(name).select(*SCHEMAS[name].fieldNames()) for name in LOAD_ORDER}
    loads = Loads(tables[LOAD_ORDER[0]].sparkSession, target)
    counts = loads.load(tables, load or uuid.uuid4().hex, refresh)
    if refresh:
        loads.clear_hidden()
    return counts


def register_views(spark: SparkSession, views: Mapping[str, DataFrame]) -> None:
    """Name lazy results, so that SQL text can use them; nothing is materialised."""
    for name, df in views.items():
        df.createOrReplaceTempView(name)


def to_records(df: DataFrame) -> DataFrame:
    """One JSON object per row, NaN written as null and nulls kept."""

    def value(field) -> Column:
        column = F.col(field.name)
        if isinstance(field.dataType, (DoubleType, FloatType)):
            column = F.when(~F.isnan(column), column)
        return column.alias(field.name)

    record = F.struct(*[value(f) for f in df.schema.fields])
    return df.select(F.to_json(record, {"ignoreNullFields": "false"}).alias("record"))
