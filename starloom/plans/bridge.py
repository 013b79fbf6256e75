"""A weighted bridge between orders and the promotions that apply to them.

An order with several promotions stands in several rows of the bridge. Their weights add up to
exactly one, and money is allocated by them to the last unit, so totals over promotions are
those of the fact and nothing is counted twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.operators.allocation import allocate

WEIGHT_DIGITS = 6
MONEY_DIGITS = 6


def order_promotions(
    applied: DataFrame, promotions: DataFrame, digits: int = WEIGHT_DIGITS, wide: DataFrame | None = None
) -> DataFrame:
    """(order_id, promotion_key, weight_factor) for ``applied``: distinct (order_id, promotion_key) with the ``basis``
    their weights are proportional to, as whole numbers. Promotions that do not exist take no weight. ``wide`` holds
    the orders with more promotions than a task should sort, if they are known (see ``allocate``)."""
    if not 0 < digits <= 9:
        raise ValueError("weights have 1 to 9 digits")
    known = applied.join(promotions.select("promotion_key"), "promotion_key", "left_semi")
    parts = known.withColumn("_whole", F.lit(10**digits).cast("bigint"))
    split = allocate(parts, "order_id", "promotion_key", "basis", "_whole", "_units", wide)
    weight = (F.col("_units") * F.lit(f"1e-{digits}").cast(f"decimal({digits},{digits})")).cast(f"decimal({digits + 1},{digits})")
    return split.select("order_id", "promotion_key", weight.alias("weight_factor"))


def allocated(bridge: DataFrame, amounts: DataFrame, amount: str, wide: DataFrame | None = None) -> DataFrame:
    """The bridge with ``amount`` of its order split by weight: the parts add up to the amount of the order.

    ``amounts`` has one row per order with a decimal of at most six places. Orders without a promotion
    have no rows here.
    """
    one = 10**MONEY_DIGITS
    units = (F.col(amount).cast("decimal(25,6)") * one).cast("bigint")
    share = (F.col("weight_factor") * 10**9).cast("bigint")
    parts = bridge.join(amounts.select("order_id", units.alias("_amount")), "order_id").withColumn("_share", share)
    split = allocate(parts, "order_id", "promotion_key", "_share", "_amount", "_units", wide)
    money = (F.col("_units").cast("decimal(19,0)") * F.lit("0.000001").cast("decimal(6,6)")).cast("decimal(25,6)")
    return split.select("order_id", "promotion_key", "weight_factor", money.alias(amount))


def promotion_sales(bridge: DataFrame, orders: DataFrame, wide: DataFrame | None = None) -> DataFrame:
    """Per promotion its orders and its part of their revenue."""
    return (
        allocated(bridge, orders, "net_amount", wide)
        .groupBy("promotion_key")
        .agg(F.count(F.lit(1)).alias("order_count"), F.sum("net_amount").alias("allocated_sales"))
    )
