"""Places in an order over the whole table."""

import random

import pytest
from pyspark.sql import functions as F

from shoptally.operators.ordering import with_position
from shoptally.sources import scratch


@pytest.mark.parametrize("partitions", [1, 7])
def test_places_with_several_keys_and_nulls(spark, partitions):
    r = random.Random(partitions)
    rows = [(r.choice([None, "a", "b", "ä"]), r.choice([None, 1.5, -2.0, 7.25]), i) for i in range(500)]
    r.shuffle(rows)
    df = spark.createDataFrame(rows, "city string, share double, position long").repartition(5)
    df = df.withColumnRenamed("position", "id")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        found = with_position(df, [F.col("city").asc_nulls_last(), F.col("share").desc_nulls_first(), "id"]).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)
    wanted = sorted(rows, key=lambda x: (x[0] is None, x[0] or "", x[1] is not None, -(x[1] or 0), x[2]))
    assert [(x.city, x.share, x.id) for x in sorted(found, key=lambda x: x.position)] == wanted
    assert sorted(x.position for x in found) == list(range(1, 501))


def test_equal_rows_and_empty_tables(spark):
    hot = spark.range(3000).select(F.lit("x").alias("city"))
    placed = with_position(hot, ["city"])
    assert sorted(x.position for x in placed.collect()) == list(range(1, 3001))
    assert with_position(hot.limit(0), ["city"]).collect() == []
    assert with_position(hot.limit(0), ["city"]).columns == ["city", "position"]


def test_equal_rows_are_dealt_out(spark):
    from shoptally.operators.ordering import sorted_in_ranges

    sizes = sorted_in_ranges(spark.range(8000).select(F.lit(1).alias("k")), ["k"]).groupBy("_o_range").count().collect()
    assert len(sizes) > 1 and max(x["count"] for x in sizes) < 4000


def test_a_cluster_needs_a_named_folder(monkeypatch):
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "local-cluster[3,2,3000]"
        getCheckpointDir = staticmethod(lambda: None)  # noqa: N815
        getConf = staticmethod(Conf)  # noqa: N815

    class Session:
        sparkContext, conf = Context(), Conf()  # noqa: N815

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch.shared_folder(Session())
