"""The retail data set as a bundle of lazy DataFrames."""

from __future__ import annotations

from collections.abc import Mapping
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession

from shoptally.functions.calendar import latest_date
from shoptally.sources.files import read_table
from shoptally.sources.schemas import LOAD_ORDER, PRIMARY_KEYS, SCHEMAS


class Retail:
    """The eight tables, each opened when first used, plus narrower versions of two of them.

    ``order_headers`` is ``orders`` without ``store_id`` and ``return_lines`` is ``returns``
    without ``return_date``.  Where those columns are stored in the table the narrow version
    is the table itself; where they come from a join, operators that do not need the column
    take the narrow version and spare the join.
    """

    primary_keys: Mapping[str, tuple[str, ...]] = PRIMARY_KEYS

    def open(self, name: str) -> DataFrame:
        raise NotImplementedError

    @cached_property
    def customers(self) -> DataFrame:
        return self.open("customers")

    @cached_property
    def stores(self) -> DataFrame:
        return self.open("stores")

    @cached_property
    def products(self) -> DataFrame:
        return self.open("products")

    @cached_property
    def orders(self) -> DataFrame:
        return self.open("orders")

    @cached_property
    def order_items(self) -> DataFrame:
        return self.open("order_items")

    @cached_property
    def inventory(self) -> DataFrame:
        return self.open("inventory")

    @cached_property
    def returns(self) -> DataFrame:
        return self.open("returns")

    @cached_property
    def marketing_campaigns(self) -> DataFrame:
        return self.open("marketing_campaigns")

    @property
    def order_headers(self) -> DataFrame:
        return self.orders

    @property
    def return_lines(self) -> DataFrame:
        return self.returns

    @property
    def as_of(self) -> Column:
        """The reference date: the latest order date, cancelled orders included."""
        return latest_date(self.order_headers, "order_date")

    @property
    def latest_snapshot(self) -> Column:
        return latest_date(self.inventory, "snapshot_date")

    def tables(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in LOAD_ORDER}


class RetailTables(Retail):
    """DataFrames at hand."""

    def __init__(self, tables: Mapping[str, DataFrame]):
        self._tables = tables

    def open(self, name: str) -> DataFrame:
        return self._tables[name]


class RetailDirectory(Retail):
    """One sub-directory per table (one .csv file or directory each for CSV), declared schemas."""

    def __init__(self, spark: SparkSession, base: str, fmt: str = "parquet"):
        self._spark, self._base, self._fmt = spark, base, fmt

    def open(self, name: str) -> DataFrame:
        suffix = ".csv" if self._fmt == "csv" else ""
        return read_table(self._spark, f"{self._base}/{name}{suffix}", SCHEMAS[name], self._fmt)
