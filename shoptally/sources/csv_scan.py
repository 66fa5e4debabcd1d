"""CSV by header names, with rows that do not fit set aside instead of failing the read."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, StringType, StructField, StructType

_BROKEN = "_broken"


@dataclass(frozen=True)
class CsvScan:
    """``rows`` in the declared schema; ``rejected`` as (record, failed): the line, and which columns do not fit."""

    rows: DataFrame
    rejected: DataFrame


def _typed(cell: Column, kind: DataType) -> Column:
    if isinstance(kind, StringType):
        return cell
    if isinstance(kind, DateType):
        return F.try_to_date(cell, "yyyy-MM-dd")
    return cell.try_cast(kind)


def scan_csv(spark: SparkSession, path: str, schema: StructType | str) -> CsvScan:
    """Read a CSV file or folder with a header; columns are found by name and the others ignored.

    A row is set aside if a cell is not of its column's type, or if it has more or fewer cells than the
    header (``failed`` is then empty and ``record`` the line as it is).  Empty cells are null and fit.  A
    declared column that the header lacks is an error, as are files whose headers differ.
    """
    wanted = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    header = spark.read.option("header", True).csv(path).columns
    missing = [name for name in wanted.fieldNames() if name not in header]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    cells = StructType([StructField(name, StringType()) for name in [*header, _BROKEN]])
    # All columns are parsed, or a row with too many cells would pass for a good one.
    options = {"header": True, "escape": '"', "enforceSchema": False, "mode": "PERMISSIVE", "columnPruning": False}
    text = spark.read.schema(cells).options(columnNameOfCorruptRecord=_BROKEN, **options).csv(path)
    typed = [_typed(F.col(f"`{f.name}`"), f.dataType) for f in wanted]
    unfit = [
        F.when(F.col(f"`{f.name}`").isNotNull() & value.isNull(), F.lit(f.name)) for f, value in zip(wanted, typed, strict=True)
    ]
    read = text.select(
        F.coalesce(_BROKEN, F.to_csv(F.struct(*(F.col(f"`{name}`") for name in header)), {"escape": '"'})).alias("record"),
        F.when(F.col(_BROKEN).isNull(), F.array_compact(F.array(*unfit))).otherwise(F.array().cast("array<string>")).alias("failed"),
        F.col(_BROKEN).isNotNull().alias("broken"),
        F.struct(*(v.alias(f.name) for f, v in zip(wanted, typed, strict=True))).alias("row"),
    )
    fits = ~F.col("broken") & (F.size("failed") == 0)
    return CsvScan(read.where(fits).select("row.*"), read.where(~fits).select("record", "failed"))
