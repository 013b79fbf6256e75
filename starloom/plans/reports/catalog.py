"""Row counts and previews of the warehouse tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.plans.star import DIMENSIONS, FACTS, Star
from starloom.schemas import TABLES

# Table -> (columns or None for all, order, rows) as shown to readers.
PREVIEWS: dict[str, tuple[tuple[str, ...] | None, tuple[str, ...], int]] = {
    "fact_sales": (
        ("date_key", "time_key", "customer_key", "product_key", "order_id", "order_item_id", "quantity",
         "unit_price", "discount_rate", "net_amount", "gross_profit"),
        ("order_item_id",), 10,
    ),
    "dim_product": (None, ("product_key",), 10),
    "dim_customer": (
        ("customer_key", "customer_id", "full_name", "prefecture", "region", "rfm_segment"), ("customer_key",), 10,
    ),
    "dim_date": (None, ("date_key",), 5),
    "dim_time": (None, ("time_key",), 10),
}


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _count(df: DataFrame, **literals: str) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        *[F.lit(value).alias(name) for name, value in literals.items()], "row_count"
    )


def raw_row_counts(star: Star) -> DataFrame:
    """Rows per operational table. Numbering the lines does not change their count, so the
    lines are counted without their id."""
    counted = {
        name: star.raw.table(name, ["order_id"] if name == "order_items" else None) for name in TABLES
    }
    return _union([_count(df, table_name=name) for name, df in counted.items()]).orderBy("table_name")


def table_row_counts(star: Star) -> DataFrame:
    """Rows per fact and dimension."""
    frames = [
        _count(star.model(name), table_name=name, type=kind)
        for kind, names in (("fact", FACTS), ("dimension", DIMENSIONS))
        for name in names
    ]
    return _union(frames).orderBy("type", "table_name")


def preview(star: Star, table: str) -> DataFrame:
    columns, order, rows = PREVIEWS[table]
    df = star.model(table)
    return df.select(*(columns or df.columns)).orderBy(*order).limit(rows)


def fact_label_preview(star: Star, rows: int = 3) -> DataFrame:
    """A few fact rows with the fact's name in front."""
    return preview(star, "fact_sales").limit(rows).select(
        F.lit("fact_sales").alias("fact_table"), "order_id", "order_item_id", "quantity", "net_amount"
    )
