"""The additive columns of the daily sales table, kept up to date from a stream of orders.

Input: a streaming DataFrame of orders with their totals (store_id, order_time, order_status,
units, revenue).  Orders later than the watermark are dropped, so a day is final, and appended
once, when the watermark has passed its end.  Distinct customers are not additive and stay with
the batch table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from shoptally.functions.numeric import money
from shoptally.sources.schemas import CANCELLED, COMPLETED


def daily_sales_stream(orders: DataFrame, lateness: str = "2 days") -> DataFrame:
    done = F.col("order_status") == COMPLETED
    return (
        orders.withWatermark("order_time", lateness)
        .groupBy(F.window("order_time", "1 day").alias("day"), "store_id")
        .agg(
            F.count_if(done).alias("orders"),
            F.coalesce(F.sum(F.when(done, F.col("units"))), F.lit(0)).alias("units_sold"),
            money(F.coalesce(F.sum(F.when(done, F.col("revenue"))), F.lit(0))).alias("revenue"),
            F.count_if(F.col("order_status") == CANCELLED).alias("cancelled_orders"),
        )
        .select(
            F.to_date("day.start").alias("date"), "store_id", "orders", "units_sold", "revenue", "cancelled_orders"
        )
    )


def write_daily_sales(daily: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Append finished days; offsets and state live in `checkpoint`, on shared storage."""
    return (
        daily.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
