from datetime import datetime, time, timedelta

from frames import by, d

from shoptally.operators import analytics
from shoptally.operators.facts import order_totals
from shoptally.streaming.daily_sales import daily_sales_stream, write_daily_sales


def test_stream_agrees_with_the_batch_table(spark, retail, tmp_path):
    priced = retail.orders.join(order_totals(retail.order_items), "order_id", "left")
    columns = "store_id bigint, order_time timestamp, order_status string, units bigint, revenue decimal(22,2)"
    rows = [
        (r.store_id, datetime.combine(r.order_date, time(12)), r.order_status, r.units, r.revenue) for r in priced.collect()
    ]
    closing = (10, datetime.combine(d("2024-06-01"), time(12)), "completed", 0, None)  # moves the watermark on
    late = (10, datetime.combine(d("2024-01-05"), time(13)), "completed", 1, None)
    for i, batch in enumerate(([*rows], [closing], [late, closing])):
        spark.createDataFrame(batch, columns).coalesce(1).write.parquet(f"{tmp_path}/in/{i}")

    source = spark.readStream.schema(columns).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
    query = write_daily_sales(daily_sales_stream(source), f"{tmp_path}/out", f"{tmp_path}/state")
    query.trigger(availableNow=True).start().awaitTermination(240)

    streamed = by(spark.read.parquet(f"{tmp_path}/out"), "store_id", "date")
    batch = by(analytics.daily_sales(retail.orders, retail.order_items, retail.stores), "store_id", "date")
    busy = {k: v for k, v in batch.items() if v["orders"] or v["cancelled_orders"]}
    assert set(streamed) == set(busy)
    for key, row in streamed.items():
        for name in ("orders", "units_sold", "revenue", "cancelled_orders"):
            assert row[name] == busy[key][name], (key, name)
    assert max(k[1] for k in streamed) < d("2024-06-01") - timedelta(days=2)
