"""Data-quality checks over the warehouse and the operational tables.

``tables`` is anything with ``model(name)``: a Star, or a Warehouse already written.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions import labels
from starloom.operators.checks import dangling, duplicates, null_counts, outside
from starloom.schemas import FOREIGN_KEYS, TABLES, UNIQUE_KEYS, required_columns
from starloom.sources.raw import RawTables


class Tables(Protocol):
    def model(self, name: str) -> DataFrame: ...


# Table -> its key column.
KEYS: dict[str, str] = {
    "stg_customers": "customer_id",
    "stg_categories": "category_id",
    "stg_products": "product_id",
    "stg_orders": "order_id",
    "stg_order_items": "order_item_id",
    "stg_page_views": "page_view_id",
    "stg_inventory_snapshots": "snapshot_id",
    "stg_coupons": "coupon_id",
    "int_customers_with_region": "customer_id",
    "int_products_with_categories": "product_id",
    "int_orders_with_items": "order_item_id",
    "int_customer_rfm": "customer_id",
    "int_customer_ltv": "customer_id",
    "int_product_abc": "product_id",
    "int_page_view_sessions": "session_id",
    "int_inventory_with_sales": "snapshot_id",
    "dim_date": "date_key",
    "dim_customer": "customer_key",
    "dim_product": "product_key",
    "dim_order_status": "order_status_key",
    "dim_time": "time_key",
    "dim_coupon": "coupon_key",
    "fact_page_views": "page_view_id",
}

# (fact, foreign key, dimension); the key has the same name on both sides.
REFERENCES: list[tuple[str, str, str]] = [
    ("fact_sales", "customer_key", "dim_customer"),
    ("fact_sales", "product_key", "dim_product"),
    ("fact_sales", "date_key", "dim_date"),
    ("fact_sales", "order_status_key", "dim_order_status"),
    ("fact_sales", "time_key", "dim_time"),
    ("fact_page_views", "date_key", "dim_date"),
    ("fact_page_views", "time_key", "dim_time"),
    ("fact_inventory_daily", "product_key", "dim_product"),
    ("fact_inventory_daily", "date_key", "dim_date"),
]


def not_null_columns() -> dict[str, list[str]]:
    """Every key, every foreign key, and the two attributes reports always group by."""
    columns: dict[str, list[str]] = {table: [key] for table, key in KEYS.items()}
    for fact, key, _ in REFERENCES:
        columns.setdefault(fact, []).append(key)
    columns["dim_customer"].append("region")
    columns["dim_product"].append("abc_rank")
    return columns


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _labelled(df: DataFrame, **literals: str) -> DataFrame:
    return df.select(*[F.lit(value).alias(name) for name, value in literals.items()], *df.columns)


# generic checks ----------------------------------------------------------------------------


def unique(tables: Tables) -> DataFrame:
    """(table_name, column_name, value, occurrences) for every repeated key."""
    return _union([
        _labelled(
            duplicates(tables.model(table).select(key), [key]).select(F.col(key).cast("string").alias("value"), "occurrences"),
            table_name=table, column_name=key,
        )
        for table, key in KEYS.items()
    ])


def not_null(tables: Tables) -> DataFrame:
    """(table_name, column_name, null_rows), one row per required column, zeros included."""
    return _union([
        _labelled(null_counts(tables.model(table), columns), table_name=table)
        for table, columns in not_null_columns().items()
    ])


def relationships(tables: Tables) -> DataFrame:
    """(table_name, column_name, value, occurrences) for every key missing from its dimension."""
    return _union([
        _labelled(
            dangling(tables.model(fact), key, tables.model(dimension), key).withColumn("value", F.col("value").cast("string")),
            table_name=fact, column_name=key,
        )
        for fact, key, dimension in REFERENCES
    ])


# business checks ---------------------------------------------------------------------------


def abc_rank_values(tables: Tables) -> DataFrame:
    return outside(tables.model("dim_product"), "abc_rank", labels.ABC_RANKS).select(
        "product_key", "product_name", "abc_rank"
    )


def rfm_segment_values(tables: Tables) -> DataFrame:
    return outside(tables.model("dim_customer"), "rfm_segment", labels.SEGMENTS).select("customer_key", "rfm_segment")


def net_amount_not_negative(tables: Tables) -> DataFrame:
    return tables.model("fact_sales").where("net_amount < 0").select("order_item_id", "net_amount")


def inventory_available(tables: Tables) -> DataFrame:
    expected = F.col("quantity_on_hand") - F.col("quantity_reserved")
    return (
        tables.model("fact_inventory_daily")
        .withColumn("expected_available", expected)
        .where("quantity_available <> expected_available")
        .select("product_key", "date_key", "quantity_on_hand", "quantity_reserved", "quantity_available",
                "expected_available")
    )


def inventory_not_negative(tables: Tables) -> DataFrame:
    return tables.model("fact_inventory_daily").where("quantity_on_hand < 0").select(
        "product_key", "date_key", "quantity_on_hand"
    )


def funnel_consistency(tables: Tables) -> DataFrame:
    """Sessions that completed without a checkout: two flags per session, one shuffle."""
    page = F.col("page_type")
    return (
        tables.model("fact_page_views")
        .where(page.isin("complete", "checkout") & F.col("session_id").isNotNull())
        .groupBy("session_id")
        .agg(F.bool_or(page == "complete").alias("completed"), F.bool_or(page == "checkout").alias("checked_out"))
        .where("completed AND NOT checked_out")
        .select("session_id")
    )


def _score_defects() -> Column:
    """A score outside 1..5, or any score without orders."""
    scores = [F.col(f"rfm_{part}_score") for part in ("recency", "frequency", "monetary")]
    out_of_range = reduce(Column.__or__, [~score.between(1, 5) for score in scores])
    unearned = (F.col("total_orders") == 0) & F.coalesce(*scores).isNotNull()
    return F.coalesce(out_of_range, F.lit(False)) | unearned


def rfm_score_range(tables: Tables) -> DataFrame:
    return tables.model("dim_customer").where(_score_defects()).select(
        "customer_key", "total_orders", "rfm_recency_score", "rfm_frequency_score", "rfm_monetary_score"
    )


BUSINESS_CHECKS: dict[str, tuple[str, str, Callable[[Tables], DataFrame]]] = {
    "abc_rank_values": ("dim_product", "abc_rank", abc_rank_values),
    "net_amount_not_negative": ("fact_sales", "net_amount", net_amount_not_negative),
    "inventory_available": ("fact_inventory_daily", "quantity_available", inventory_available),
    "inventory_not_negative": ("fact_inventory_daily", "quantity_on_hand", inventory_not_negative),
    "funnel_consistency": ("fact_page_views", "session_id", funnel_consistency),
    "rfm_score_range": ("dim_customer", "rfm_recency_score", rfm_score_range),
    "rfm_segment_values": ("dim_customer", "rfm_segment", rfm_segment_values),
}


def accepted_values(tables: Tables) -> DataFrame:
    """Both vocabulary checks in one list of offending keys."""
    return _union([
        abc_rank_values(tables).select(
            F.lit("dim_product").alias("table_name"), F.col("product_key").alias("key"), F.col("abc_rank").alias("value")
        ),
        rfm_segment_values(tables).select(
            F.lit("dim_customer").alias("table_name"), F.col("customer_key").alias("key"),
            F.col("rfm_segment").alias("value"),
        ),
    ])


def _key_health(tables: Tables, table: str, key: str) -> DataFrame:
    """Repeated and missing values of one key from a single grouping."""
    present = F.col(key).isNotNull()
    grouped = tables.model(table).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    found = grouped.agg(
        F.count_if(present & (F.col("n") > 1)).alias("unique"),
        F.coalesce(F.sum(F.when(~present, F.col("n"))), F.lit(0).cast("bigint")).alias("not_null"),
    )
    checks = found.unpivot([], ["unique", "not_null"], "check_name", "failing_rows")
    return checks.select(
        "check_name", F.lit(table).alias("table_name"), F.lit(key).alias("column_name"), "failing_rows"
    )


def summary(tables: Tables) -> DataFrame:
    """(check_name, table_name, column_name, failing_rows): one row per check, zeros included.

    Each key is grouped once for both of its checks, and the other required columns of a table
    are counted in one pass.
    """
    keys = [_key_health(tables, table, key) for table, key in KEYS.items()]
    others = {
        table: [column for column in columns if column != KEYS.get(table)]
        for table, columns in not_null_columns().items()
    }
    presence = [
        _labelled(null_counts(tables.model(table), columns), check_name="not_null", table_name=table)
        .withColumnRenamed("null_rows", "failing_rows")
        for table, columns in others.items() if columns
    ]
    references = [
        _labelled(
            dangling(tables.model(fact), key, tables.model(dimension), key).agg(
                F.coalesce(F.sum("occurrences"), F.lit(0).cast("bigint")).alias("failing_rows")
            ),
            check_name="relationships", table_name=fact, column_name=key,
        )
        for fact, key, dimension in REFERENCES
    ]
    business = [
        _labelled(
            check(tables).agg(F.count(F.lit(1)).alias("failing_rows")),
            check_name=name, table_name=table, column_name=column,
        )
        for name, (table, column, check) in BUSINESS_CHECKS.items()
    ]
    return _union([*keys, *presence, *references, *business])


# operational tables ------------------------------------------------------------------------


def source_constraints(raw: RawTables) -> DataFrame:
    """(constraint, table_name, column_name, value, occurrences): what the source would reject."""
    repeated = [
        _labelled(
            duplicates(raw.table(table, columns), columns).select(
                F.concat_ws("|", *[F.col(c).cast("string") for c in columns]).alias("value"), "occurrences"
            ),
            constraint="unique", table_name=table, column_name=",".join(columns),
        )
        for table, columns in UNIQUE_KEYS
    ]
    lost = [
        _labelled(
            dangling(raw.table(child, [column]), column, raw.table(parent, [key]), key).withColumn(
                "value", F.col("value").cast("string")
            ),
            constraint="foreign key", table_name=child, column_name=column,
        )
        for child, column, parent, key in FOREIGN_KEYS
    ]
    return _union([*repeated, *lost])


def schema_conformance(raw: RawTables) -> DataFrame:
    """(table_name, column_name, required, null_rows): one pass per table over all its columns."""
    frames = []
    for table, schema in TABLES.items():
        required = [F.lit(name) for name in required_columns(table)]
        frames.append(
            _labelled(null_counts(raw.table(table), schema.names), table_name=table).withColumn(
                "required", F.col("column_name").isin(required)
            )
        )
    return _union(frames).select("table_name", "column_name", "required", "null_rows")
