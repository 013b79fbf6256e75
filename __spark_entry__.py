"""Entry points: the flagship query, every registered query, and its expected result as SQL."""

from __future__ import annotations

import sys
from collections.abc import Callable
from datetime import date
from functools import reduce
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from starloom.functions.scoring import RfmBands  # noqa: E402
from starloom.operators.allocation import wide_groups  # noqa: E402
from starloom.operators.as_of import as_of  # noqa: E402
from starloom.operators.paging import page_after  # noqa: E402
from starloom.plans import bridge, profiles, quality, roles, warehouse  # noqa: E402
from starloom.plans.history import History, previous_value  # noqa: E402
from starloom.plans.monthly import MonthlySales, by_month, delta  # noqa: E402
from starloom.plans.reports import catalog, customers, inventory, products, sales, traffic  # noqa: E402
from starloom.plans.star import MODELS, Star  # noqa: E402
from starloom.schemas import TABLES  # noqa: E402
from starloom.session import scratch_path, tune  # noqa: E402
from starloom.sources.export import export, read_export  # noqa: E402
from starloom.sources.load import audit, load_all  # noqa: E402
from starloom.sources.raw import FileTables  # noqa: E402
from starloom.sources.retail import LOAD_DAYS, RetailTables  # noqa: E402

try:  # the text operators stand apart: without them everything else still works
    import corpus_pipeline  # noqa: E402
    from starloom.llm import queries as text_queries  # noqa: E402
except ImportError:
    corpus_pipeline = text_queries = None

Query = Callable[[SparkSession, str], DataFrame]

# The day after the last order, so that recency spreads over its bands; spending bands likewise.
AS_OF = date(2001, 8, 2)
BANDS = RfmBands(monetary=(2_400_000, 1_900_000, 1_500_000, 1_000_000))


def star_of(spark: SparkSession, sf_dir: str) -> Star:
    return Star(RetailTables(tune(spark), sf_dir), AS_OF, BANDS)


def plain(df: DataFrame) -> DataFrame:
    """Result types every engine has: decimals as doubles, whole numbers as 64-bit integers."""

    def cast(field: T.StructField):
        if isinstance(field.dataType, T.DecimalType):
            return F.col(field.name).cast("double").alias(field.name)
        if isinstance(field.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            return F.col(field.name).cast("bigint").alias(field.name)
        return F.col(field.name)

    return df.select(*[cast(field) for field in df.schema])


def _on_star(report: Callable[[Star], DataFrame]) -> Query:
    return lambda spark, sf_dir: plain(report(star_of(spark, sf_dir)))


def _model(name: str) -> Callable[[Star], DataFrame]:
    return lambda star: star.model(name)


def _preview(table: str) -> Callable[[Star], DataFrame]:
    return lambda star: catalog.preview(star, table)


def _paged(star: Star) -> DataFrame:
    wanted = star.staged("products", ["product_id", "product_name", "unit_price"])
    order, last = ["product_name", "product_id"], None
    third = wanted.limit(0)
    for number in range(1, 4):  # from the last row of each page to the next
        third = page_after(wanted, order, last, 25)
        rows = third.select(*order).collect() if number < 3 else []
        if number < 3 and len(rows) < 25:
            third = wanted.limit(0)
            break
        last = list(rows[-1]) if rows else None
    return third.withColumns({"page": F.lit(3), "total_rows": F.lit(wanted.count()).cast("bigint")})


def _load_audit(star: Star) -> DataFrame:
    return audit(star.spark, load_all(star.raw, scratch_path(star.spark, "raw")))


def _json_round_trip(star: Star) -> DataFrame:
    """All tables delivered as compressed JSON lines, loaded with the declared types: rows and a check sum of the keys."""
    delivered, loaded = scratch_path(star.spark, "delivered-json"), scratch_path(star.spark, "loaded")
    for table in TABLES:
        export(star.raw.table(table), f"{delivered}/{table}", "json", "gzip")
    load_all(FileTables(star.spark, delivered, "json"), loaded)
    frames = []
    for table, schema in TABLES.items():
        key = F.col(schema[0].name)
        frames.append(
            FileTables(star.spark, loaded).table(table, [schema[0].name]).agg(
                F.lit(table).alias("table_name"),
                F.count(F.lit(1)).alias("row_count"),
                F.coalesce(F.sum(key % 1_000_003), F.lit(0).cast("bigint")).alias("key_sum"),
            )
        )
    return reduce(DataFrame.unionByName, frames)


def _exported(star: Star) -> DataFrame:
    """A report exported in two formats and read back."""
    result = sales.monthly_sales(star)
    copies = []
    for fmt in ("csv", "json"):
        path = scratch_path(star.spark, f"export-{fmt}")
        export(result, path, fmt)
        copies.append(read_export(result, path, fmt).select(F.lit(fmt).alias("format"), "*"))
    return copies[0].unionByName(copies[1])


_warehouses: dict[tuple[str, str], warehouse.Warehouse] = {}


def _built(star: Star) -> warehouse.Warehouse:
    """The warehouse of the folder, built once per session."""
    key = (star.spark.sparkContext.applicationId, star.raw.folder)
    if key not in _warehouses:
        _warehouses[key] = warehouse.build(star, scratch_path(star.spark, "warehouse"))[0]
    return _warehouses[key]


def _warehouse_counts(star: Star) -> DataFrame:
    _, counts = warehouse.build(star, scratch_path(star.spark, "warehouse"))
    return star.spark.createDataFrame(list(counts.items()), "table_name string, row_count bigint")


TRACKED = {
    "customers": ("customer_id", ("city", "prefecture", "registration_channel")),
    "products": ("product_id", ("unit_price", "is_active")),
}


def _history(star: Star, table: str) -> History:
    """Three loads of the dimension, the first one taken to describe the past as well."""
    key, tracked = TRACKED[table]
    history = History(star.spark, scratch_path(star.spark, f"history-{table}"), key, tracked)
    for number, day in enumerate(LOAD_DAYS):
        history.apply(star.raw.load(table, number), day, first_day=None if number else date(1900, 1, 1))
    return history


def _at_order_time(star: Star) -> DataFrame:
    """Orders of the sales fact with the version of their customer that was valid on the day."""
    orders = star.order_totals.select("order_id", "customer_id", "order_date", "net_amount")
    starts = _history(star, "customers").starts()
    return as_of(orders, starts, "customer_id", "order_date", "valid_from", ["version_key"])


def _city_sales_at_order_time(star: Star) -> DataFrame:
    history = _history(star, "customers")
    orders = star.order_totals.select("order_id", "customer_id", "order_date", "net_amount")
    placed = as_of(orders, history.starts(), "customer_id", "order_date", "valid_from", ["version_key"])
    cities = history.dimension().select("version_key", "city")
    per_version = placed.groupBy("version_key").agg(F.count(F.lit(1)).alias("orders"), F.sum("net_amount").alias("net"))
    return (
        per_version.join(cities, "version_key", "left")
        .groupBy("city")
        .agg(F.sum("orders").alias("order_count"), F.sum("net").alias("total_sales"))
    )


def _monthly(star: Star) -> MonthlySales:
    """The aggregate after a first load without late lines and with some wrong ones, and two later batches."""
    star.write_lines()
    lines = star.sales.select("order_id", "product_id", "order_date", "quantity", "net_amount", "discount_rate")
    late, wrong = F.col("order_id") % 10 == 3, F.col("order_id") % 10 == 7
    first = lines.where(~late).withColumn("quantity", F.when(wrong, F.col("quantity") + 1).otherwise(F.col("quantity")))
    monthly = MonthlySales(star.spark, scratch_path(star.spark, "monthly"))
    monthly.apply("first", by_month(first))
    monthly.apply("late", delta(lines.where(late)))
    monthly.apply("corrections", delta(lines.where(wrong), first.where(wrong)))
    return monthly


def _on_monthly(report: Callable[[Star], DataFrame]) -> Callable[[Star], DataFrame]:
    """A report whose product totals come from the monthly aggregate."""

    def run(star: Star) -> DataFrame:
        star.rebind_product_totals(_monthly(star).product_totals())
        return report(star)

    return run


def _wide_orders(star: Star) -> DataFrame:
    """Orders of very many lines; an order has no more promotions than lines."""
    return wide_groups(star.staged("order_items", ["order_id"]), "order_id")


def _bridge(star: Star, wide: DataFrame | None = None) -> DataFrame:
    coupons = star.staged("coupons", ["coupon_id"]).withColumnRenamed("coupon_id", "promotion_key")
    wide = _wide_orders(star) if wide is None else wide
    return bridge.order_promotions(star.raw.order_promotions(), coupons, wide=wide)


def _promotion_sales(star: Star) -> DataFrame:
    wide = _wide_orders(star)
    return bridge.promotion_sales(_bridge(star, wide), star.order_totals, wide)


def _order_flag_usage(star: Star) -> DataFrame:
    flags = profiles.order_flags(star)
    return profiles.usage(profiles.flagged_sales(star, flags), flags, "flag_key")


def _payment_mix_from_flags(star: Star) -> DataFrame:
    flags = profiles.order_flags(star)
    return profiles.flag_sales(profiles.flagged_sales(star, flags), flags, "payment_method")


def _profile_sales(star: Star) -> DataFrame:
    bands = profiles.profiles(star)
    return profiles.usage(profiles.profiled_orders(star, bands), bands, "profile_key")


REPORTS: dict[str, Callable[[Star], DataFrame]] = {
    # history of dimensions
    "customer_history": lambda star: _history(star, "customers").dimension(),
    "product_history": lambda star: _history(star, "products").dimension(),
    "customer_previous_city": lambda star: previous_value(_history(star, "customers"), "city"),
    "order_customer_versions": lambda star: _at_order_time(star).select("order_id", "version_key"),
    "city_sales_at_order_time": _city_sales_at_order_time,
    # monthly aggregate
    "monthly_product_sales": lambda star: _monthly(star).table(),
    "top_products_from_months": _on_monthly(products.top_products),
    "category_sales_from_months": _on_monthly(products.category_sales),
    # bridge, junk dimension, mini-dimension, calendar in roles
    "order_promotion_bridge": _bridge,
    "promotion_sales": _promotion_sales,
    "order_flag_usage": _order_flag_usage,
    "payment_mix_from_flags": _payment_mix_from_flags,
    "order_profiles": lambda star: profiles.profiled_orders(star, profiles.profiles(star)).select("order_id", "profile_key"),
    "profile_sales": _profile_sales,
    "delivery_lags": lambda star: roles.delivery_lags(star, star.raw.shipments()),
    # sources and sinks
    "scan_raw": lambda star: star.raw.table("orders"),
    "raw_load_roundtrip": _json_round_trip,
    "load_audit": _load_audit,
    "schema_conformance": lambda star: quality.schema_conformance(star.raw),
    "export_csv_json": _exported,
    "warehouse_build": _warehouse_counts,
    # sales
    "monthly_sales": sales.monthly_sales,
    "monthly_sales_profit": sales.monthly_sales_profit,
    "monthly_sales_yoy": sales.monthly_sales_yoy,
    "moving_average_7d": sales.moving_average,
    "seasonal_trend": sales.seasonal_trend,
    "hourly_sales": sales.hourly_sales,
    "hourly_order_pattern": sales.hourly_order_pattern,
    "weekday_pattern": sales.weekday_pattern,
    "order_status_analysis": sales.order_status_analysis,
    "order_status_distribution": sales.order_status_distribution,
    "payment_distribution": sales.payment_distribution,
    "device_distribution": sales.device_distribution,
    "payment_mix": sales.payment_mix,
    "order_line_rollup": sales.order_line_rollup,
    "coupon_usage": sales.coupon_usage,
    # customers
    "rfm_segment_sales": customers.rfm_segment_sales,
    "rfm_segment_distribution": customers.rfm_segment_distribution,
    "cohort_retention": customers.cohort_retention,
    "ltv_distribution": customers.ltv_distribution,
    "top_ltv_customers": customers.top_ltv_customers,
    "region_customer_analysis": customers.region_customer_analysis,
    "region_sales": customers.region_sales,
    "segment_distribution": customers.segment_distribution,
    "gender_distribution": customers.gender_distribution,
    "age_distribution": customers.age_distribution,
    # products
    "category_ranking": products.category_ranking,
    "category_sales": products.category_sales,
    "category_line_counts": products.category_line_counts,
    "abc_analysis": products.abc_analysis,
    "abc_product_summary": products.abc_product_summary,
    "abc_sales_lines": products.abc_sales_lines,
    "top_products": products.top_products,
    "cross_sell": products.cross_sell,
    "view_to_purchase": products.view_to_purchase,
    # traffic
    "conversion_funnel": traffic.conversion_funnel,
    "page_type_traffic": traffic.page_type_traffic,
    "funnel_page_views": traffic.funnel_page_views,
    "session_conversion": traffic.session_conversion,
    "sales_vs_views_monthly": traffic.sales_vs_views_monthly,
    # inventory
    "inventory_turnover": inventory.inventory_turnover,
    "stockout_analysis": inventory.stockout_analysis,
    "stockout_check": inventory.stockout_check,
    "latest_inventory_status": inventory.latest_inventory_status,
    "sales_vs_stock": inventory.sales_vs_stock,
    "product_stock_history": lambda star: inventory.product_stock_history(star, product_id=20),
    # catalog
    "raw_row_counts": catalog.raw_row_counts,
    "table_row_counts": catalog.table_row_counts,
    "preview_fact_sales": _preview("fact_sales"),
    "preview_fact_label": catalog.fact_label_preview,
    "preview_dim_product": _preview("dim_product"),
    "preview_dim_customer": _preview("dim_customer"),
    "preview_dim_date": _preview("dim_date"),
    "paged_query": _paged,
    # data quality
    "dq_unique": lambda star: quality.unique(_built(star)),
    "dq_not_null": lambda star: quality.not_null(_built(star)),
    "dq_relationships": lambda star: quality.relationships(_built(star)),
    "dq_accepted_values": quality.accepted_values,
    "dq_net_amount": quality.net_amount_not_negative,
    "dq_inventory_available": quality.inventory_available,
    "dq_inventory_non_negative": quality.inventory_not_negative,
    "dq_funnel_consistency": quality.funnel_consistency,
    "dq_rfm_score_range": quality.rfm_score_range,
    "dq_source_constraints": lambda star: quality.source_constraints(star.raw),
    "dq_summary": lambda star: quality.summary(_built(star)),
}


def entry(spark: SparkSession) -> DataFrame:
    """Monthly sales over the smallest test data."""
    return queries()["monthly_sales"](spark, "/root/testdata/sf0.001")


def retail_queries() -> dict[str, Query]:
    # dim_time reads no table, so it has no query of its own; the hourly reports use it.
    models = [*(f"stg_{table}" for table in TABLES), *(name for name in MODELS if name != "dim_time")]
    return {
        **{name: _on_star(_model(name)) for name in models},
        **{name: _on_star(report) for name, report in REPORTS.items()},
    }


def queries() -> dict[str, Query]:
    return {
        **retail_queries(),
        **(text_queries.queries() if text_queries else {}),
        **({"pipeline": corpus_pipeline.run} if corpus_pipeline else {}),
    }


def oracle_sql() -> dict[str, str]:
    from oracle.reports import statements

    return {
        **statements(),
        **(text_queries.oracle_sql() if text_queries else {}),
        **({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline and corpus_pipeline.ORACLE_SQL else {}),
    }
