"""The place of every row in an order over the whole table.

Rows are dealt out by ranges of the sort keys and sorted inside a range, by as many tasks as there are
ranges.  A row's place is the number of rows in the ranges before its own, which is one row
per range, and its place inside the range.  No task sees more than one range, and rows that are
equal in all keys are dealt out further by a row number.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoptally.sources.scratch import saved

#: A row's number inside its partition is in these bits of monotonically_increasing_id.
_IN_PARTITION = (1 << 33) - 1


def sorted_in_ranges(rows: DataFrame, order: Sequence[Column | str]) -> DataFrame:
    """Rows in ranges of ``order``, with ``_o_range`` and ``_o_at``, the place in it from 0; kept as a table.

    The columns may give any direction and place of nulls (``asc_nulls_last`` and so on).
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [*order, "_o_row"]
    settled = saved(rows.withColumn("_o_row", F.monotonically_increasing_id()))
    ranged = settled.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).drop("_o_row")
    at = F.monotonically_increasing_id().bitwiseAND(F.lit(_IN_PARTITION))
    return saved(ranged.withColumns({"_o_range": F.spark_partition_id(), "_o_at": at}))


def with_position(rows: DataFrame, order: Sequence[Column | str], name: str = "position") -> DataFrame:
    """Add the place of each row, from 1, in the order of ``order`` over all rows.

    Rows equal in all columns of ``order`` get places next to each other, in any order.  An empty table
    stays empty.
    """
    placed = sorted_in_ranges(rows, order)
    counts = placed.groupBy("_o_range").agg(F.count(F.lit(1)).alias("_o_rows"))
    before = F.sum("_o_rows").over(Window.orderBy("_o_range")) - F.col("_o_rows")
    begins = counts.select(F.col("_o_range").alias("_o_of"), before.alias("_o_before"))  # one row per range
    found = placed.join(F.broadcast(begins), F.col("_o_range") == F.col("_o_of"))
    place = (F.col("_o_before") + F.col("_o_at") + 1).cast("long")
    return found.select(*(F.col(f"`{c}`") for c in rows.columns if c != name), place.alias(name))
