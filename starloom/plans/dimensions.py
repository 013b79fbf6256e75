"""Dimensions of the star schema."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.functions import calendar, labels
from starloom.operators.ranking import dense_index


def dim_date(days: list[DataFrame]) -> DataFrame:
    """One row per day between the first and the last day of any source, however far apart.

    ``days`` are one-column frames of dates. Their bounds are aggregated per source, so only
    one row per source reaches the task that unrolls the spine.
    """
    bounds = None
    for frame in days:
        (column,) = frame.columns
        one = frame.agg(F.min(column).alias("first"), F.max(column).alias("last"))
        bounds = one if bounds is None else bounds.unionByName(one)
    spine = bounds.agg(F.min("first").alias("first"), F.max("last").alias("last")).select(
        F.explode(F.sequence("first", "last", F.expr("INTERVAL 1 DAY"))).alias("day")
    )
    return spine.select(*[calendar.attribute(name, "day") for name in calendar.ATTRIBUTES])


def dim_time(spark: SparkSession) -> DataFrame:
    hour = F.col("id")
    return spark.range(0, 24, 1, 1).select(
        hour.alias("time_key"),
        hour.alias("hour_of_day"),
        labels.day_part(hour).alias("time_period"),
        hour.between(*labels.BUSINESS_HOURS).alias("is_business_hours"),
    )


def dim_customer(customers: DataFrame, metrics: DataFrame, as_of: date) -> DataFrame:
    """Customer attributes with scores and lifetime value, for buyers and others alike."""
    spent = F.coalesce(F.col("total_spent"), F.lit(0).cast("decimal(38,6)"))
    tenure = F.datediff(F.lit(as_of), F.col("created_at").cast("date")).cast("bigint")
    return customers.join(metrics, "customer_id", "left").select(
        F.col("customer_id").alias("customer_key"),
        "customer_id", "full_name", "email", "phone", "city", "prefecture", "region", "gender", "age_group",
        "registration_channel",
        tenure.alias("customer_tenure_days"),
        "rfm_recency_score", "rfm_frequency_score", "rfm_monetary_score",
        F.coalesce("rfm_segment", F.lit(labels.NEVER_BOUGHT)).alias("rfm_segment"),
        "first_order_date",
        F.coalesce(F.col("total_orders"), F.lit(0).cast("bigint")).alias("total_orders"),
        spent.alias("total_spent"),
        "ltv_estimated",
    )


def dim_product(products: DataFrame, abc: DataFrame) -> DataFrame:
    ranks = abc.select("product_id", "abc_rank")
    return products.join(ranks, "product_id", "left").select(
        F.col("product_id").alias("product_key"),
        "product_id", "product_name", "category_name", "parent_category_name", "unit_price", "cost_price",
        "gross_margin_pct", "is_active",
        F.coalesce("abc_rank", F.lit(labels.LOWEST_RANK)).alias("abc_rank"),
    )


def dim_order_status(orders: DataFrame) -> DataFrame:
    """Distinct statuses, numbered alphabetically. A status is a word of a small vocabulary, so
    the distinct set fits one window task."""
    codes = orders.select(F.col("status").alias("status_code")).distinct()
    return codes.select(
        F.row_number().over(Window.orderBy("status_code")).cast("bigint").alias("order_status_key"),
        "status_code",
        labels.status_label(F.col("status_code")).alias("status_label"),
    )


def dim_coupon(coupons: DataFrame) -> DataFrame:
    return dense_index(coupons, ["coupon_id"], "coupon_key").select(
        "coupon_key", "coupon_code", "coupon_type", "discount_value", "campaign_name"
    )
