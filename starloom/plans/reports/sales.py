"""Sales over time, status, payment and device.

All of these group by attributes of the order, so they start from one row per order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, GroupedData, Window
from pyspark.sql import functions as F

from starloom.functions import labels
from starloom.functions.amounts import percentage, ratio, rounded_ratio
from starloom.functions.calendar import with_calendar
from starloom.operators.shares import share_of_total
from starloom.plans.star import Star


def _orders() -> Column:
    return F.count("order_id")


def _lines() -> Column:
    return F.sum("line_count")


def _net() -> Column:
    return F.sum("net_amount")


def _line_average(digits: int) -> Column:
    return rounded_ratio(_net(), _lines(), digits)


def _per_day(order_totals: DataFrame) -> DataFrame:
    """One row per day with sales. Calendar attributes are computed on these few rows and
    rolled up from there, not once per order."""
    return order_totals.groupBy("order_date").agg(
        _orders().alias("orders"),
        _lines().alias("line_count"),
        F.sum("quantity").alias("quantity"),
        _net().alias("net_amount"),
        F.sum("gross_profit").alias("gross_profit"),
    )


def _by_calendar(order_totals: DataFrame, *attributes: str) -> GroupedData:
    return with_calendar(_per_day(order_totals), "order_date", *attributes).groupBy(*attributes)


def _orders_of_days() -> Column:
    return F.sum("orders")


def monthly_sales(star: Star) -> DataFrame:
    return (
        _by_calendar(star.order_totals, "year", "month", "month_name")
        .agg(
            _orders_of_days().alias("order_count"),
            _lines().alias("line_item_count"),
            _net().alias("total_net_amount"),
            F.sum("quantity").alias("total_quantity"),
        )
        .orderBy("year", "month")
    )


def monthly_sales_profit(star: Star) -> DataFrame:
    return (
        _by_calendar(star.order_totals, "year", "month", "month_name")
        .agg(
            _orders_of_days().alias("order_count"),
            _net().alias("total_sales"),
            F.sum("gross_profit").alias("total_profit"),
        )
        .orderBy("year", "month")
    )


def seasonal_trend(star: Star) -> DataFrame:
    return (
        _by_calendar(star.order_totals, "month", "year")
        .agg(_net().alias("monthly_revenue"), _orders_of_days().alias("order_count"))
        .orderBy("year", "month")
    )


def monthly_sales_yoy(star: Star) -> DataFrame:
    """Month totals next to the same month of the fiscal year before.

    The same month one fiscal year earlier is the row twelve months back, which a range window
    over the month number finds. The window sees one row per month.
    """
    months = (
        _by_calendar(star.order_totals, "year_month", "year", "month")
        .agg(_net().alias("monthly_revenue"), _orders_of_days().alias("order_count"))
        .withColumn("_number", F.col("year") * 12 + F.col("month"))
    )
    year_back = Window.partitionBy(F.lit(True)).orderBy("_number").rangeBetween(-12, -12)
    before = F.first("monthly_revenue").over(year_back)
    growth = percentage(F.col("monthly_revenue") - F.col("prev_year_revenue"), F.col("prev_year_revenue"))
    return (
        months.withColumn("prev_year_revenue", before)
        .select("year_month", "monthly_revenue", "order_count", "prev_year_revenue", growth.alias("yoy_growth_pct"))
        .orderBy("year_month")
    )


def moving_average(star: Star, rows: int = 7) -> DataFrame:
    """Daily revenue and its average over the last ``rows`` days that had sales.

    The window runs over one row per day, a few thousand per decade.
    """
    daily = _per_day(star.order_totals).select(
        F.col("order_date").alias("full_date"), F.col("net_amount").alias("daily_revenue")
    )
    recent = Window.partitionBy(F.lit(True)).orderBy("full_date").rowsBetween(1 - rows, Window.currentRow)
    average = ratio(F.sum("daily_revenue").over(recent), F.count("daily_revenue").over(recent))
    return daily.withColumn(f"moving_avg_{rows}d", average).orderBy("full_date")


def _by_hour(star: Star, **measures: Column) -> DataFrame:
    """Measures per hour of the day with the hour's name; 24 rows at most meet the dimension."""
    per_hour = (
        star.order_totals.groupBy("time_key")
        .agg(*[measure.alias(name) for name, measure in measures.items()])
    )
    return per_hour.join(F.broadcast(star.dim_time), "time_key").select("time_period", "hour_of_day", *measures)


def hourly_sales(star: Star) -> DataFrame:
    return _by_hour(star, order_count=_orders(), total_revenue=_net()).orderBy("hour_of_day")


def hourly_order_pattern(star: Star) -> DataFrame:
    return (
        _by_hour(star, order_count=_orders(), total_sales=_net())
        .select("hour_of_day", "time_period", "order_count", "total_sales")
        .orderBy("hour_of_day")
    )


def weekday_pattern(star: Star, digits: int = 2) -> DataFrame:
    return (
        _by_calendar(star.order_totals, "day_of_week", "day_name")
        .agg(
            _orders_of_days().alias("order_count"),
            _net().alias("total_net_amount"),
            _line_average(digits).alias("avg_net_amount"),
        )
        .orderBy("day_of_week")
    )


def order_status_analysis(star: Star) -> DataFrame:
    return (
        star.order_totals.groupBy(F.col("status").alias("status_code"))
        .agg(
            _lines().alias("item_count"),
            _net().alias("total_net_amount"),
            _line_average(2).alias("avg_net_amount"),
        )
        .withColumn("status_label", labels.status_label(F.col("status_code")))
        .orderBy(F.desc("total_net_amount"), "status_code")
    )


def _order_shares(star: Star, column: str) -> DataFrame:
    """Share of orders; each order has one value of ``column``, so the groups add up to all."""
    return (
        star.order_totals.groupBy(column)
        .agg(_orders().alias("order_count"))
        .withColumn("pct", share_of_total("order_count"))
    )


def order_status_distribution(star: Star) -> DataFrame:
    return (
        _order_shares(star, "status")
        .withColumnRenamed("status", "status_code")
        .orderBy(F.desc("order_count"), "status_code")
    )


def payment_distribution(star: Star) -> DataFrame:
    return (
        _order_shares(star, "payment_method")
        .select(F.lit("決済方法分布").alias("analysis_type"), "payment_method", "order_count", "pct")
        .orderBy(F.desc("order_count"), "payment_method")
    )


def device_distribution(star: Star) -> DataFrame:
    return (
        _order_shares(star, "device_type")
        .select(F.lit("デバイス分布").alias("analysis_type"), "device_type", "order_count", "pct")
        .orderBy(F.desc("order_count"), "device_type")
    )


def payment_mix(star: Star) -> DataFrame:
    return (
        star.order_totals.groupBy("payment_method")
        .agg(_orders().alias("orders"), _net().alias("sales"))
        .orderBy(F.desc("sales"), "payment_method")
    )


def order_line_rollup(star: Star, top: int = 10) -> DataFrame:
    """The orders with most lines."""
    return (
        star.order_totals.select(
            "order_id",
            F.col("line_count").alias("line_items"),
            F.col("quantity").alias("total_qty"),
            F.col("net_amount").alias("order_total"),
        )
        .orderBy(F.desc("line_items"), "order_id")
        .limit(top)
    )


def coupon_usage(star: Star) -> DataFrame:
    """Order lines bought with a known coupon."""
    offers = star.staged("coupons", ["coupon_code", "coupon_type", "discount_value"])
    return star.sales.where(F.col("coupon_code").isNotNull()).join(offers, "coupon_code").select(
        "order_id", "coupon_code", "coupon_type", "discount_value", "discount_rate", "net_amount"
    )
