"""Declared schemas, load order and keys of the eight retail tables (fixed values)."""

from __future__ import annotations

from pyspark.sql.types import DataType, DateType, DecimalType, LongType, StringType, StructField, StructType

_ID, _COUNT, _TEXT, _DAY = LongType(), LongType(), StringType(), DateType()
_PRICE, _AMOUNT = DecimalType(10, 2), DecimalType(12, 2)


def _schema(**columns: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


# Parents before children, so that a foreign key never precedes its target.
SCHEMAS: dict[str, StructType] = {
    "customers": _schema(
        customer_id=_ID, first_name=_TEXT, last_name=_TEXT, email=_TEXT, city=_TEXT, segment=_TEXT, signup_date=_DAY
    ),
    "stores": _schema(store_id=_ID, store_name=_TEXT, city=_TEXT, state=_TEXT, region=_TEXT, open_date=_DAY),
    "products": _schema(product_id=_ID, product_name=_TEXT, category=_TEXT, unit_price=_PRICE, unit_cost=_PRICE),
    "orders": _schema(
        order_id=_ID, customer_id=_ID, store_id=_ID, order_date=_DAY, channel=_TEXT, order_status=_TEXT
    ),
    "order_items": _schema(
        order_item_id=_ID, order_id=_ID, product_id=_ID, quantity=_COUNT, unit_price=_PRICE, line_total=_AMOUNT
    ),
    "inventory": _schema(
        inventory_id=_ID, store_id=_ID, product_id=_ID, snapshot_date=_DAY, stock_level=_COUNT, reorder_level=_COUNT
    ),
    "returns": _schema(return_id=_ID, order_id=_ID, product_id=_ID, return_date=_DAY, return_reason=_TEXT),
    "marketing_campaigns": _schema(
        campaign_id=_ID,
        campaign_name=_TEXT,
        city_target=_TEXT,
        channel=_TEXT,
        start_date=_DAY,
        end_date=_DAY,
        budget=_AMOUNT,
        spend=_AMOUNT,
    ),
}

LOAD_ORDER: tuple[str, ...] = tuple(SCHEMAS)

PRIMARY_KEYS: dict[str, tuple[str, ...]] = {
    "customers": ("customer_id",),
    "stores": ("store_id",),
    "products": ("product_id",),
    "orders": ("order_id",),
    "order_items": ("order_item_id",),
    "inventory": ("inventory_id",),
    "returns": ("return_id",),
    "marketing_campaigns": ("campaign_id",),
}

# child table, child column, parent table, parent column
FOREIGN_KEYS: tuple[tuple[str, str, str, str], ...] = (
    ("orders", "customer_id", "customers", "customer_id"),
    ("orders", "store_id", "stores", "store_id"),
    ("order_items", "order_id", "orders", "order_id"),
    ("order_items", "product_id", "products", "product_id"),
    ("inventory", "store_id", "stores", "store_id"),
    ("inventory", "product_id", "products", "product_id"),
    ("returns", "order_id", "orders", "order_id"),
    ("returns", "product_id", "products", "product_id"),
)

COMPLETED = "completed"
CANCELLED = "cancelled"
