"""Window frames over an ordered series.

Two rolling semantics exist side by side: `trailing` averages whatever rows the frame
holds, `trailing_full` is null until the frame is complete.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def series(keys: Sequence[str], order: str) -> WindowSpec:
    """One ordered series per key.  Rows per series are periods of a calendar, never facts."""
    return W.partitionBy(*[F.col(k) for k in keys]).orderBy(order)


def before(window: WindowSpec, rows: int) -> WindowSpec:
    """The given number of rows before the current one, current row excluded."""
    return window.rowsBetween(-rows, -1)


def trailing(agg: Callable[[Column], Column], value: Column, window: WindowSpec, rows: int) -> Column:
    return agg(value).over(before(window, rows))


def trailing_full(agg: Callable[[Column], Column], value: Column, window: WindowSpec, rows: int) -> Column:
    frame = before(window, rows)
    return F.when(F.count(value).over(frame) == rows, agg(value).over(frame))


def dealt(df: DataFrame, *columns: str) -> DataFrame:
    """The same rows, dealt by the columns to as many tasks as `spark.sql.shuffle.partitions` says.

    Small partitions are not merged again: where rows fan out or meet several hash tables after a shuffle, a task
    would hold many times what it has read.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *columns)
