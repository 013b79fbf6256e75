"""Page views: funnels, page types, session conversion."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starloom.functions import labels
from starloom.functions.amounts import percentage, rounded_ratio
from starloom.plans.star import Star


def conversion_funnel(star: Star, stages: Sequence[str] = labels.FUNNEL_STAGES) -> DataFrame:
    """Sessions per page type, as a share of the sessions that saw the first stage."""
    sessions = (
        star.views.where(F.col("page_type").isin(list(stages)))
        .groupBy("page_type")
        .agg(F.count_distinct("session_id").alias("sessions"))
    )
    first = F.max(F.when(F.col("page_type") == stages[0], F.col("sessions"))).over(Window.partitionBy(F.lit(True)))
    return sessions.withColumn("pct_of_top", percentage(F.col("sessions"), first)).orderBy(
        F.desc("sessions"), "page_type"
    )


def page_type_traffic(star: Star) -> DataFrame:
    return (
        star.views.groupBy("page_type")
        .agg(
            F.count(F.lit(1)).alias("page_views"),
            F.count_distinct("session_id").alias("sessions"),
            rounded_ratio(F.sum("duration_seconds"), F.count("duration_seconds"), 1).alias("avg_duration_sec"),
        )
        .orderBy(F.desc("page_views"), "page_type")
    )


def funnel_page_views(star: Star, stages: Sequence[str] = labels.DASHBOARD_STAGES) -> DataFrame:
    """Views per page type in funnel order; other page types follow."""
    place = F.array_position(F.array(*map(F.lit, stages)), F.col("page_type"))
    return (
        star.views.groupBy("page_type")
        .agg(F.count(F.lit(1)).alias("views"))
        .orderBy(F.nullif(place, F.lit(0)).asc_nulls_last(), "page_type")
    )


def session_conversion(star: Star) -> DataFrame:
    purchases = F.count_if("has_purchase")
    return (
        star.sessions.groupBy("referrer_type")
        .agg(
            F.count(F.lit(1)).alias("sessions"),
            F.count_if("has_cart").alias("cart_sessions"),
            purchases.alias("purchase_sessions"),
            percentage(purchases, F.count(F.lit(1))).alias("cvr_pct"),
        )
        .orderBy(F.desc("sessions"), F.asc_nulls_first("referrer_type"))
    )


def sales_vs_views_monthly(star: Star) -> DataFrame:
    """Order lines and page views per calendar month.

    Each fact is counted per day before it meets the calendar, so the two never multiply.
    """
    sold = star.order_totals.groupBy(F.col("order_date").alias("full_date")).agg(F.sum("line_count").alias("sold"))
    seen = star.views.groupBy(F.col("view_timestamp").cast("date").alias("full_date")).agg(
        F.count(F.lit(1)).alias("seen")
    )
    zero = F.lit(0).cast("bigint")
    return (
        star.dim_date.select("full_date", "year", "month", "month_name")
        .join(sold, "full_date", "left")
        .join(seen, "full_date", "left")
        .groupBy("year", "month", "month_name")
        .agg(
            F.coalesce(F.sum("sold"), zero).alias("sales_count"),
            F.coalesce(F.sum("seen"), zero).alias("page_view_count"),
        )
        .orderBy("year", "month")
    )
