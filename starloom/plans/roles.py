"""One calendar in several roles: the day of the order, of its shipment, of the customer's registration."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.amounts import rounded_ratio
from starloom.functions.calendar import attribute
from starloom.plans.star import Star


def role_view(calendar: DataFrame, role: str) -> DataFrame:
    """The calendar table as seen in one role, for SQL users: every column carries the role."""
    return calendar.select(*[F.col(name).alias(f"{role}_{name}") for name in calendar.columns])


def with_roles(facts: DataFrame, days: Mapping[str, str], names: Sequence[str]) -> DataFrame:
    """Add the calendar columns ``names`` of every role, as ``role_name``. ``days`` tells the date column of a role.

    Attributes are expressions of the date, so no role costs a join; a missing date has NULL attributes.
    """
    return facts.select(
        "*", *[attribute(name, day).alias(f"{role}_{name}") for role, day in days.items() for name in names]
    )


def _days(start: str, end: str) -> Column:
    return F.datediff(end, start).cast("bigint")


def delivery_lags(star: Star, shipments: DataFrame) -> DataFrame:
    """By month of the order and kind of day of the shipment: lines, and days from registration to order to shipment.

    ``shipments`` has (order_id, ship_date) with the number of ``lines`` shipped then.
    """
    people = star.staged("customers", ["customer_id", "created_at"])
    orders = star.staged("orders", ["order_id", "customer_id", "order_date"]).join(people, "customer_id")
    dated = shipments.join(orders, "order_id").withColumn("registered_on", F.col("created_at").cast("date"))
    days = {"order": "order_date", "ship": "ship_date", "registration": "registered_on"}
    dated = with_roles(dated.where("order_date IS NOT NULL AND ship_date IS NOT NULL"), days, ["year_month", "is_weekend"])
    lag, age = _days("order_date", "ship_date"), _days("registered_on", "order_date")
    sums = dated.groupBy("order_year_month", "ship_is_weekend").agg(
        F.sum("lines").alias("line_count"),
        F.sum(F.when(F.col("ship_year_month") == F.col("order_year_month"), F.col("lines")).otherwise(0)).alias("same_month_lines"),
        F.sum(lag * F.col("lines")).alias("_lag"),
        F.min(lag).alias("fewest_days_to_ship"),
        F.max(lag).alias("most_days_to_ship"),
        F.sum(age * F.col("lines")).alias("_age"),
        F.sum(F.when(F.col("registered_on").isNotNull(), F.col("lines"))).alias("_aged"),
    )
    return sums.select(
        "order_year_month", "ship_is_weekend", "line_count", "same_month_lines",
        rounded_ratio(F.col("_lag"), F.col("line_count"), 2).alias("avg_days_to_ship"),
        "fewest_days_to_ship", "most_days_to_ship",
        rounded_ratio(F.col("_age"), F.col("_aged"), 2).alias("avg_days_since_registration"),
    )
