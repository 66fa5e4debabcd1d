"""Loads are repeatable, orphans are set aside, and a refresh is all or nothing."""

import pytest
from frames import BASE

from shoptally.sources import files
from shoptally.sources.loads import Loads
from shoptally.sources.schemas import LOAD_ORDER, SCHEMAS


class Killed(Exception):
    pass


def dying_at(name, tables):
    """The same tables, but the load ends when it comes to ``name``."""

    class Tables(dict):
        def __getitem__(self, key):
            if key == name:
                raise Killed
            return super().__getitem__(key)

    return Tables(tables)


def sizes(loads):
    return {name: loads.table(name).count() for name in LOAD_ORDER}


FULL = {name: len(rows) for name, rows in BASE.items()}


def test_a_repeated_load_adds_nothing(spark, retail, tmp_path):
    loads = Loads(spark, str(tmp_path))
    assert loads.load(retail.tables(), "a") == loads.load(retail.tables(), "a") == FULL
    assert sizes(loads) == FULL
    loads.load(retail.tables(), "b")
    assert sizes(loads) == {name: 2 * n for name, n in FULL.items()}


@pytest.mark.parametrize("at", ["customers", "orders", "marketing_campaigns"])
def test_a_killed_load_shows_nothing_and_can_be_repeated(spark, retail, tmp_path, at):
    loads = Loads(spark, str(tmp_path))
    loads.load(retail.tables(), "first")
    with pytest.raises(Killed):
        loads.load(dying_at(at, retail.tables()), "second")
    assert sizes(loads) == FULL
    loads.load(retail.tables(), "second")
    assert sizes(loads) == {name: 2 * n for name, n in FULL.items()}


def test_a_failed_refresh_leaves_the_old_tables(spark, retail, tmp_path):
    loads = Loads(spark, str(tmp_path))
    loads.load(retail.tables(), "old")
    fewer = {**retail.tables(), "marketing_campaigns": retail.marketing_campaigns.limit(1)}
    with pytest.raises(Killed):
        loads.load(dying_at("returns", fewer), "new", refresh=True)
    assert sizes(loads) == FULL
    loads.load(fewer, "new", refresh=True)
    assert sizes(loads) == FULL | {"marketing_campaigns": 1}
    loads.clear_hidden()
    assert sizes(loads) == FULL | {"marketing_campaigns": 1}
    assert spark.read.parquet(f"{tmp_path}/orders").count() == FULL["orders"]


def test_children_without_parents_are_set_aside(spark, retail, tmp_path):
    loads = Loads(spark, str(tmp_path))
    known = retail.orders.where("order_id <> 1")
    nameless = retail.orders.limit(1).selectExpr(
        *(f"CAST(NULL AS BIGINT) AS {c}" if c == "store_id" else "9999 AS order_id" if c == "order_id" else c for c in known.columns)
    )
    loads.load({**retail.tables(), "orders": known.unionByName(nameless.select(*known.columns))}, "a")
    assert [r.order_id for r in loads.set_aside("orders", "a").collect()] == [9999]
    lost = loads.set_aside("order_items", "a")
    assert {r.order_id for r in lost.collect()} == {1}
    assert loads.table("order_items").count() + lost.count() == FULL["order_items"]
    assert lost.columns == SCHEMAS["order_items"].fieldNames()
    # Once the parent is there, what was set aside can be loaded.
    loads.load({"orders": retail.orders.where("order_id = 1"), "order_items": lost}, "b")
    assert loads.table("order_items").count() == FULL["order_items"]
    assert loads.table("orders").count() == FULL["orders"]


def test_empty_tables(spark, retail, tmp_path):
    loads = Loads(spark, str(tmp_path))
    assert loads.notes() == []
    counts = loads.load({name: df.limit(0) for name, df in retail.tables().items()}, "none")
    assert set(counts.values()) == {0} and loads.table("stores").count() == 0
    with pytest.raises(ValueError, match="nothing of stores"):
        Loads(spark, f"{tmp_path}/elsewhere").table("stores")


def test_load_all_by_id(retail, tmp_path):
    read = retail.tables().__getitem__
    assert files.load_all(read, str(tmp_path), load="x") == files.load_all(read, str(tmp_path), load="x") == FULL
    assert Loads(retail.orders.sparkSession, str(tmp_path)).table("orders").count() == FULL["orders"]
