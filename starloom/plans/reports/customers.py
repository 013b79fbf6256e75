"""Customers: segments, value, regions, cohorts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.functions.amounts import rounded_ratio
from starloom.functions.calendar import with_calendar
from starloom.operators.shares import share_of_total
from starloom.plans.star import Star


def rfm_segment_sales(star: Star) -> DataFrame:
    """All sales by segment; the average is per order line."""
    return (
        star.customer_sales.groupBy("rfm_segment")
        .agg(
            F.count(F.lit(1)).alias("customer_count"),
            F.sum("all_net").alias("total_revenue"),
            rounded_ratio(F.sum("all_net"), F.sum("all_lines"), 0).alias("avg_order_amount"),
        )
        .orderBy(F.desc("total_revenue"), "rfm_segment")
    )


def cohort_retention(star: Star) -> DataFrame:
    """Customers active per month, by the month of their first order.

    One set of (customer, month) pairs gives both; a customer has at most one row per month, so
    the per-customer window stays small however many orders the customer placed.
    """
    active = (
        with_calendar(star.order_totals.select("customer_id", "order_date"), "order_date", "year_month")
        .select("customer_id", F.col("year_month").alias("activity_month"))
        .distinct()
    )
    first = F.min("activity_month").over(Window.partitionBy("customer_id"))
    return (
        active.withColumn("cohort_month", first)
        .groupBy("cohort_month", "activity_month")
        .agg(F.count(F.lit(1)).alias("active_customers"))
        .orderBy("cohort_month", "activity_month")
    )


def _buyers(star: Star) -> DataFrame:
    return star.dim_customer.where("total_orders > 0")


def ltv_distribution(star: Star) -> DataFrame:
    return (
        _buyers(star)
        .groupBy("rfm_segment", "age_group")
        .agg(
            F.count(F.lit(1)).alias("customer_count"),
            F.round(F.avg("ltv_estimated"), 0).alias("avg_ltv"),
            rounded_ratio(F.sum("total_spent"), F.count("total_spent"), 0).alias("avg_total_spent"),
            rounded_ratio(F.sum("total_orders"), F.count("total_orders"), 1).alias("avg_orders"),
        )
        .orderBy(F.desc_nulls_last("avg_ltv"), "rfm_segment", "age_group")
    )


def rfm_segment_distribution(star: Star) -> DataFrame:
    return (
        _buyers(star)
        .groupBy("rfm_segment")
        .agg(
            F.count(F.lit(1)).alias("customer_count"),
            rounded_ratio(F.sum("total_spent"), F.count("total_spent"), 0).alias("avg_spent"),
            F.round(F.avg("ltv_estimated"), 0).alias("avg_ltv"),
        )
        .orderBy(F.desc("avg_spent"), "rfm_segment")
    )


def top_ltv_customers(star: Star, top: int = 20) -> DataFrame:
    """Ranked on the unrounded value; the customer id breaks ties."""
    return (
        star.dim_customer.where(F.col("ltv_estimated").isNotNull())
        .orderBy(F.desc("ltv_estimated"), "customer_id")
        .limit(top)
        .select(
            "full_name", "prefecture", "region", "rfm_segment", "total_orders", "total_spent",
            F.round("ltv_estimated", 0).alias("ltv_estimated"),
        )
    )


def _by_region(star: Star) -> DataFrame:
    """One row per customer who ordered, with region; sums of it are sums over orders."""
    per_customer = star.customer_sales.select("customer_id", "all_orders", "all_lines", "all_net")
    return per_customer.join(star.customers.select("customer_id", "region"), "customer_id").groupBy("region")


def region_customer_analysis(star: Star) -> DataFrame:
    customers, orders = F.count(F.lit(1)), F.sum("all_orders")
    return (
        _by_region(star)
        .agg(
            customers.alias("customer_count"),
            orders.alias("order_count"),
            rounded_ratio(F.sum("all_net"), F.sum("all_lines"), 2).alias("avg_order_amount"),
            rounded_ratio(orders, customers, 2).alias("orders_per_customer"),
        )
        .orderBy(F.desc("customer_count"), "region")
    )


def region_sales(star: Star) -> DataFrame:
    return (
        _by_region(star)
        .agg(
            F.count(F.lit(1)).alias("customers"),
            F.sum("all_orders").alias("orders"),
            F.sum("all_net").alias("total_sales"),
        )
        .orderBy(F.desc("total_sales"), "region")
    )


def _customer_shares(customers: DataFrame, column: str, title: str) -> DataFrame:
    return (
        customers.groupBy(column)
        .agg(F.count(F.lit(1)).alias("customer_count"))
        .select(F.lit(title).alias("analysis_type"), column, "customer_count",
                share_of_total("customer_count").alias("pct"))
    )


def segment_distribution(star: Star) -> DataFrame:
    return _customer_shares(star.dim_customer, "rfm_segment", "RFMセグメント分布").orderBy(
        F.desc("customer_count"), "rfm_segment"
    )


def gender_distribution(star: Star) -> DataFrame:
    return _customer_shares(star.customers, "gender", "性別分布").orderBy(F.desc("customer_count"), "gender")


def age_distribution(star: Star) -> DataFrame:
    return _customer_shares(star.customers, "age_group", "年代分布").orderBy("age_group")
