"""Facts of the star schema.

Natural ids are the dimension keys, so a key lookup only has to confirm that the member exists.
The calendar holds every day of every source by construction; a date key is computed from the
date, and only a missing date has no key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.amounts import as_decimal
from starloom.functions.calendar import date_key
from starloom.operators.joins import left_key_lookup, members
from starloom.plans.intermediate import with_amounts


def hour_key(moment: str) -> Column:
    return F.hour(moment).cast("bigint")


def sale_headers(
    orders: DataFrame, customers: DataFrame, statuses: DataFrame, used: DataFrame | None = None
) -> DataFrame:
    """Orders of the sales fact, or their lines, with the keys that stand in the fact.

    ``customers`` needs its id. Other columns of ``orders`` stay. With ``used``, a narrow table of all customers
    of ``orders``, the orders are not moved to find the known ones.
    """
    codes = statuses.select("order_status_key", F.col("status_code").alias("status"))
    dated = orders.where(F.col("order_date").isNotNull()).join(codes, "status")
    if used is None:
        known = dated.join(customers.select("customer_id"), "customer_id", "left_semi")
    else:
        known = members(dated, customers, "customer_id", used)
    return (
        known
        .withColumn("date_key", date_key("order_date"))
        .withColumn("time_key", hour_key("order_timestamp"))
        .withColumnRenamed("customer_id", "customer_key")
        .drop("status", "order_date", "order_timestamp")
    )


def priced_sales(lines: DataFrame, products: DataFrame) -> DataFrame:
    """What the sales fact follows from: ``lines`` with their headers, and of ``products`` the cost price."""
    return lines.join(products.select("product_id", "cost_price"), "product_id").select(
        "customer_key", F.col("product_id").alias("product_key"), "date_key", "order_status_key", "order_id",
        "order_item_id", "quantity", "unit_price", "discount_rate", "time_key", "payment_method", "device_type",
        "coupon_code", "cost_price",
    )


def sale_amounts(priced: DataFrame) -> DataFrame:
    """The sales fact of :func:`priced_sales`, row by row."""
    cost = as_decimal(F.col("quantity")) * F.col("cost_price")
    return with_amounts(priced).select(
        "customer_key", "product_key",
        "date_key", "order_status_key", "order_id", "order_item_id", "quantity", "unit_price", "discount_rate",
        "gross_amount", "discount_amount", "net_amount", "time_key",
        "payment_method", "device_type", "coupon_code",
        cost.alias("cost_amount"),
        (F.col("net_amount") - cost).alias("gross_profit"),
    )


def fact_sales(lines: DataFrame, products: DataFrame) -> DataFrame:
    """One row per order line. ``lines`` come with their headers, ``products`` with id and cost."""
    return sale_amounts(priced_sales(lines, products))


def fact_page_views(views: DataFrame, customers: DataFrame, products: DataFrame, look_up=left_key_lookup) -> DataFrame:
    """One row per page view; views without a known customer or product keep NULL keys."""
    seen = views.where(F.col("view_timestamp").isNotNull())
    seen = look_up(
        seen, customers.select(F.col("customer_id").alias("customer_key")), "customer_id", "customer_key", "page_view_id"
    )
    seen = look_up(
        seen, products.select(F.col("product_id").alias("product_key")), "product_id", "product_key", "page_view_id"
    )
    return seen.select(
        "page_view_id", "customer_key", "product_key",
        date_key("view_timestamp").alias("date_key"),
        hour_key("view_timestamp").alias("time_key"),
        "session_id", "page_type", "referrer_type", "duration_seconds",
    )


def fact_inventory_daily(inventory: DataFrame, products: DataFrame, used: DataFrame | None = None) -> DataFrame:
    """One row per product and day. With ``used``, a narrow table of all products of ``inventory``, its rows are not
    moved to find the known ones."""
    left = F.col("quantity_available")
    dated = inventory.where(F.col("snapshot_date").isNotNull())
    if used is None:
        known = dated.join(products.select("product_id"), "product_id", "left_semi")
    else:
        known = members(dated, products, "product_id", used)
    return known.select(
        F.col("product_id").alias("product_key"),
        date_key("snapshot_date").alias("date_key"),
        "quantity_on_hand", "quantity_reserved", "quantity_available", "reorder_point",
        (left < F.col("reorder_point")).alias("is_below_reorder_point"),
        (left <= 0).alias("is_out_of_stock"),
        "days_of_supply",
    )
