"""The star-schema test tables, projected onto the retail model."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoptally.functions.frames import dealt
from shoptally.sources.files import read_table
from shoptally.sources.retail import Retail
from shoptally.sources.schemas import PRIMARY_KEYS

SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": (
        "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
        "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
    ),
    "lineitem": (
        "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
        "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
        "l_shipdate TIMESTAMP_NTZ"
    ),
}

# Fixed values of the mapping: calendar start, key of a line.  The key has room for 134,217,727 parts and
# lines 0 to 7; an order key it has no room for is an error.
_START = "DATE '1995-01-01'"
_LINE_ID = "(l_orderkey * 134217728 + l_partkey) * 8 + l_linenumber"


class StarSchemaRetail(Retail):
    primary_keys = {**PRIMARY_KEYS, "inventory": ("store_id", "product_id", "snapshot_date")}

    def __init__(self, spark: SparkSession, base: str):
        self._spark, self._base = spark, base

    def _source(self, name: str) -> DataFrame:
        return read_table(self._spark, f"{self._base}/{name}.parquet", SCHEMAS[name])

    def open(self, name: str) -> DataFrame:
        return getattr(self, f"_{name}")()

    def _customers(self) -> DataFrame:
        return (
            self._source("customer")
            .join(self._source("nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .selectExpr(
                "c_custkey AS customer_id",
                "c_name AS customer_name",
                "concat(lower(c_name), '@example.com') AS email",
                "n_name AS city",
                "c_mktsegment AS segment",
                f"date_add({_START}, CAST(c_custkey * 37 % 2000 AS INT)) AS signup_date",
            )
        )

    def _stores(self) -> DataFrame:
        """Two stores per nation."""
        return (
            self._source("nation")
            .join(self._source("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .selectExpr("n_nationkey", "n_name", "r_name", "explode(array(0, 1)) AS k")
            .selectExpr(
                "CAST(n_nationkey * 2 + k AS BIGINT) AS store_id",
                "concat(n_name, ' Store ', CAST(k AS STRING)) AS store_name",
                "n_name AS city",
                "r_name AS region",
                "DATE '1994-01-01' AS open_date",
            )
        )

    def _products(self) -> DataFrame:
        return self._source("part").selectExpr(
            "p_partkey AS product_id",
            "p_name AS product_name",
            "p_type AS category",
            "CAST(p_retailprice AS DECIMAL(10,2)) AS unit_price",
            "CAST(FLOOR(p_retailprice * 60) / 100 AS DECIMAL(10,2)) AS unit_cost",
        )

    @cached_property
    def order_headers(self) -> DataFrame:
        return self._source("orders").selectExpr(
            "o_orderkey AS order_id",
            "o_custkey AS customer_id",
            "CAST(o_orderdate AS DATE) AS order_date",
            "CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') THEN 'online' "
            "ELSE 'in_store' END AS channel",
            "CASE WHEN o_orderstatus = 'P' THEN 'cancelled' ELSE 'completed' END AS order_status",
        )

    def _orders(self) -> DataFrame:
        """The store follows from the customer's nation."""
        home = self._source("customer").selectExpr("c_custkey AS customer_id", "c_nationkey")
        return self.order_headers.join(home, "customer_id", "left").selectExpr(
            "order_id",
            "customer_id",
            "CAST(c_nationkey * 2 + order_id % 2 AS BIGINT) AS store_id",
            "order_date",
            "channel",
            "order_status",
        )

    def _order_items(self) -> DataFrame:
        """Prices and discounts have two digits; they become decimals by way of whole cents.

        The values are those of a direct cast, which would print and parse every double.
        """
        cents, percent = "FLOOR(l_extendedprice * 100 + 0.5D)", "FLOOR(l_discount * 100 + 0.5D)"
        charged = "FLOOR(l_extendedprice * (1 - l_discount) / l_quantity * 100 + 0.5D)"
        return self._source("lineitem").selectExpr(
            f"{_LINE_ID} AS order_item_id",
            "l_orderkey AS order_id",
            "l_partkey AS product_id",
            "CAST(l_quantity AS BIGINT) AS quantity",
            f"CAST(CAST({charged} AS DECIMAL(18,0)) * 0.01BD AS DECIMAL(10,2)) AS unit_price",
            f"CAST(CAST({percent} AS DECIMAL(18,0)) * 0.01BD AS DECIMAL(4,2)) AS discount_pct",
            f"CAST(CAST({cents} * (100 - {percent}) AS DECIMAL(18,0)) * 0.0001BD AS DECIMAL(18,4)) AS line_total",
        )

    def _returned(self) -> DataFrame:
        return self._source("lineitem").where("l_returnflag = 'R'")

    @cached_property
    def return_lines(self) -> DataFrame:
        return self._returned().selectExpr(
            f"{_LINE_ID} AS return_id",
            "l_orderkey AS order_id",
            "l_partkey AS product_id",
            "l_linestatus AS return_reason",
        )

    def _returns(self) -> DataFrame:
        """A return comes back some days after its order."""
        returned = self._returned().selectExpr(
            f"{_LINE_ID} AS return_id",
            "l_orderkey AS order_id",
            "l_partkey AS product_id",
            "CAST(l_linenumber * 3 % 13 + 1 AS INT) AS days_after",
            "l_linestatus AS return_reason",
        )
        dated = self.order_headers.select("order_id", "order_date")
        return returned.join(dated, "order_id", "left").selectExpr(
            "return_id",
            "order_id",
            "product_id",
            "date_add(order_date, days_after) AS return_date",
            "return_reason",
        )

    def _inventory(self) -> DataFrame:
        """Nearly every line is a snapshot of its own, so lines are not combined before they are shuffled."""
        lines = self._source("lineitem").selectExpr(
            "CAST(l_suppkey % 50 AS BIGINT) AS store_id",
            "l_partkey AS product_id",
            "trunc(l_shipdate, 'month') AS snapshot_date",
            "l_quantity",
        )
        key = ("store_id", "product_id", "snapshot_date")
        return (
            dealt(lines, *key)
            .groupBy(*key)
            .agg(F.sum("l_quantity").alias("shipped"))
            .selectExpr(
                "store_id",
                "product_id",
                "snapshot_date",
                "CAST(CAST(shipped AS BIGINT) % 40 AS BIGINT) AS stock_level",
                "CAST(8 AS BIGINT) AS reorder_level",
            )
        )

    @property
    def latest_snapshot(self) -> Column:
        """The newest month of the derived inventory, read off the shipping dates."""
        return self._source("lineitem").agg(F.trunc(F.max("l_shipdate"), "month")).scalar()

    def _marketing_campaigns(self) -> DataFrame:
        """Every part is the subject of one campaign in one city."""
        return (
            self._source("part")
            .join(self._source("nation"), F.expr("p_partkey % 25 = n_nationkey"), "left")
            .selectExpr(
                "p_partkey AS campaign_id",
                "p_name AS campaign_name",
                "n_name AS city_target",
                "p_brand AS channel",
                f"date_add({_START}, CAST(p_partkey * 79 % 2300 AS INT)) AS start_date",
                f"date_add({_START}, CAST(p_partkey * 79 % 2300 + 14 + p_size AS INT)) AS end_date",
                "CAST(p_retailprice * 10 AS DECIMAL(12,2)) AS budget",
                "CAST(p_retailprice * 9 AS DECIMAL(12,2)) AS spend",
            )
        )
