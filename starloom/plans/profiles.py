"""Junk and mini-dimensions: combinations of flags or bands whose key stands in the fact.

Both keep a fact narrow and a large dimension stable. What changes often about a customer is not a
version of the customer but a band, and the fact row carries the key of the bands at its own time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions import labels
from starloom.functions.calendar import attribute
from starloom.operators.combinations import Combinations, vocabulary
from starloom.operators.ranking import index_in_group
from starloom.plans.star import Star

#: Orders placed before -> activity level; the last level is open.
ACTIVITY: tuple[tuple[int, str], ...] = ((1, "new"), (3, "low"), (10, "medium"))
HIGHEST_ACTIVITY = "high"
FLAGS = ("is_weekend", "is_holiday", "is_business_hours", "has_coupon")


def order_flags(star: Star) -> Combinations:
    """The junk dimension of orders: four flags, payment method and device. Asks the orders for the last two."""
    orders = star.order_totals
    words = {name: vocabulary(orders, name) for name in ("payment_method", "device_type")}
    return Combinations({**{name: (False, True) for name in FLAGS}, **words})


def flagged_sales(star: Star, flags: Combinations) -> DataFrame:
    """One row per order of the sales fact with one key in the place of its flag columns."""
    key = flags.key(
        is_weekend=attribute("is_weekend", "order_date"),
        is_holiday=attribute("is_holiday", "order_date"),
        is_business_hours=F.col("time_key").between(*labels.BUSINESS_HOURS),
        has_coupon=F.col("coupon_code").isNotNull(),
        payment_method=F.col("payment_method"),
        device_type=F.col("device_type"),
    )
    return star.order_totals.select(
        "order_id", "customer_id", "order_date", key.alias("flag_key"), "line_count", "quantity", "net_amount"
    )


def flag_sales(sales: DataFrame, flags: Combinations, *names: str) -> DataFrame:
    """Orders and revenue by some of the flags. Summed by key first, so the values are looked up once per key."""
    per_key = sales.groupBy("flag_key").agg(F.count(F.lit(1)).alias("orders"), F.sum("net_amount").alias("sales"))
    return flags.with_values(per_key, "flag_key").groupBy(*names).agg(
        F.sum("orders").alias("orders"), F.sum("sales").alias("sales")
    )


def profiles(star: Star) -> Combinations:
    """The mini-dimension of customers: age band, activity level and region."""
    return Combinations({
        "age_band": [labels.UNKNOWN, *(band for _, band in labels.AGE_BANDS), labels.OLDEST_BAND],
        "activity_level": [*(level for _, level in ACTIVITY), HIGHEST_ACTIVITY],
        "region": [*star.regions, labels.UNKNOWN],
    })


def profiled_orders(star: Star, bands: Combinations) -> DataFrame:
    """One row per order of the sales fact with the profile of its customer at that time.

    The activity level counts the customer's orders before this one; orders of one day count by id.
    """
    orders = star.order_totals.select("order_id", "customer_id", "order_date", "net_amount")
    placed = index_in_group(orders, "customer_id", [F.col("order_date"), F.col("order_id")], "_number")
    people = star.staged("customers", ["customer_id", "birth_date", "prefecture"])
    before = F.col("_number") - 1
    key = bands.key(
        age_band=labels.age_band(F.col("birth_date"), F.col("order_date")),
        activity_level=labels.first_match([(before < end, F.lit(level)) for end, level in ACTIVITY], F.lit(HIGHEST_ACTIVITY)),
        region=labels.region_of(F.col("prefecture"), star.regions),
    )
    return placed.join(people, "customer_id").select(
        "order_id", "customer_id", "order_date", key.alias("profile_key"), "net_amount"
    )


def usage(facts: DataFrame, combinations: Combinations, key: str) -> DataFrame:
    """Every combination with its orders and revenue, zero where it never occurred."""
    zero = F.lit(0).cast("decimal(38,6)")
    seen = facts.groupBy(key).agg(F.count(F.lit(1)).alias("_orders"), F.sum("net_amount").alias("_sales"))
    return combinations.dimension(facts.sparkSession, key).join(seen, key, "left").select(
        key, *combinations.vocabularies,
        F.coalesce("_orders", F.lit(0)).cast("bigint").alias("order_count"),
        F.coalesce(F.col("_sales").cast("decimal(38,6)"), zero).alias("total_sales"),
    )
