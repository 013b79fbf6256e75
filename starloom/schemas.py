"""Declared shape of the eight operational tables and the constraints their source enforces."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(12, 2)
PERCENT = T.DecimalType(5, 2)
_LONG, _TEXT, _DATE = T.LongType(), T.StringType(), T.DateType()
_TIME, _FLAG = T.TimestampType(), T.BooleanType()
_REQUIRED, _OPTIONAL = True, False


def _table(*columns: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, not required) for name, kind, required in columns])


# Table -> columns; loaded in this order, parents before children.
TABLES: dict[str, T.StructType] = {
    "customers": _table(
        ("customer_id", _LONG, _REQUIRED),
        ("first_name", _TEXT, _REQUIRED),
        ("last_name", _TEXT, _REQUIRED),
        ("email", _TEXT, _REQUIRED),
        ("phone", _TEXT, _OPTIONAL),
        ("city", _TEXT, _OPTIONAL),
        ("prefecture", _TEXT, _OPTIONAL),
        ("postal_code", _TEXT, _OPTIONAL),
        ("created_at", _TIME, _OPTIONAL),
        ("gender", _TEXT, _OPTIONAL),
        ("birth_date", _DATE, _OPTIONAL),
        ("registration_channel", _TEXT, _OPTIONAL),
    ),
    "categories": _table(
        ("category_id", _LONG, _REQUIRED),
        ("name", _TEXT, _REQUIRED),
        ("parent_id", _LONG, _OPTIONAL),
    ),
    "products": _table(
        ("product_id", _LONG, _REQUIRED),
        ("product_name", _TEXT, _REQUIRED),
        ("category_id", _LONG, _REQUIRED),
        ("unit_price", MONEY, _REQUIRED),
        ("description", _TEXT, _OPTIONAL),
        ("created_at", _TIME, _OPTIONAL),
        ("cost_price", MONEY, _OPTIONAL),
        ("weight_gram", _LONG, _OPTIONAL),
        ("is_active", _FLAG, _OPTIONAL),
    ),
    "orders": _table(
        ("order_id", _LONG, _REQUIRED),
        ("customer_id", _LONG, _REQUIRED),
        ("order_date", _DATE, _REQUIRED),
        ("shipping_address", _TEXT, _OPTIONAL),
        ("status", _TEXT, _REQUIRED),
        ("created_at", _TIME, _OPTIONAL),
        ("updated_at", _TIME, _OPTIONAL),
        ("order_timestamp", _TIME, _REQUIRED),
        ("payment_method", _TEXT, _OPTIONAL),
        ("device_type", _TEXT, _OPTIONAL),
        ("coupon_code", _TEXT, _OPTIONAL),
    ),
    "order_items": _table(
        ("order_item_id", _LONG, _REQUIRED),
        ("order_id", _LONG, _REQUIRED),
        ("product_id", _LONG, _REQUIRED),
        ("quantity", _LONG, _REQUIRED),
        ("unit_price", MONEY, _REQUIRED),
        ("discount", PERCENT, _OPTIONAL),
    ),
    "page_views": _table(
        ("page_view_id", _LONG, _REQUIRED),
        ("customer_id", _LONG, _OPTIONAL),
        ("session_id", _TEXT, _REQUIRED),
        ("page_type", _TEXT, _REQUIRED),
        ("product_id", _LONG, _OPTIONAL),
        ("category_id", _LONG, _OPTIONAL),
        ("referrer_type", _TEXT, _OPTIONAL),
        ("view_timestamp", _TIME, _REQUIRED),
        ("duration_seconds", _LONG, _OPTIONAL),
    ),
    "inventory_snapshots": _table(
        ("snapshot_id", _LONG, _REQUIRED),
        ("product_id", _LONG, _REQUIRED),
        ("snapshot_date", _DATE, _REQUIRED),
        ("quantity_on_hand", _LONG, _REQUIRED),
        ("quantity_reserved", _LONG, _REQUIRED),
        ("reorder_point", _LONG, _REQUIRED),
        ("lead_time_days", _LONG, _REQUIRED),
    ),
    "coupons": _table(
        ("coupon_id", _LONG, _REQUIRED),
        ("coupon_code", _TEXT, _REQUIRED),
        ("coupon_type", _TEXT, _REQUIRED),
        ("discount_value", MONEY, _REQUIRED),
        ("min_order_amount", MONEY, _OPTIONAL),
        ("valid_from", _DATE, _REQUIRED),
        ("valid_to", _DATE, _REQUIRED),
        ("campaign_name", _TEXT, _OPTIONAL),
    ),
}

# Keys the operational database enforces: (table, columns) must be unique.
UNIQUE_KEYS: list[tuple[str, tuple[str, ...]]] = [
    ("customers", ("customer_id",)),
    ("customers", ("email",)),
    ("categories", ("category_id",)),
    ("products", ("product_id",)),
    ("orders", ("order_id",)),
    ("order_items", ("order_item_id",)),
    ("page_views", ("page_view_id",)),
    ("inventory_snapshots", ("snapshot_id",)),
    ("inventory_snapshots", ("product_id", "snapshot_date")),
    ("coupons", ("coupon_id",)),
    ("coupons", ("coupon_code",)),
]

# Fixed values: (child table, column, parent table, parent column); NULL children are allowed.
FOREIGN_KEYS: list[tuple[str, str, str, str]] = [
    ("categories", "parent_id", "categories", "category_id"),
    ("products", "category_id", "categories", "category_id"),
    ("orders", "customer_id", "customers", "customer_id"),
    ("order_items", "order_id", "orders", "order_id"),
    ("order_items", "product_id", "products", "product_id"),
    ("page_views", "customer_id", "customers", "customer_id"),
    ("page_views", "product_id", "products", "product_id"),
    ("page_views", "category_id", "categories", "category_id"),
    ("inventory_snapshots", "product_id", "products", "product_id"),
]


def required_columns(table: str) -> list[str]:
    return [field.name for field in TABLES[table] if not field.nullable]


def reading_schema(table: str) -> T.StructType:
    """The declared schema with every column nullable: files cannot promise NOT NULL."""
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in TABLES[table]])
