"""Stock: turnover, stock-outs, latest levels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.amounts import percentage, rounded_ratio
from starloom.functions.calendar import day_of
from starloom.plans.star import Star


def _stock(star: Star) -> DataFrame:
    """The inventory fact by product id."""
    return star.fact_inventory_daily.withColumnRenamed("product_key", "product_id")


def inventory_turnover(star: Star, by: tuple[str, ...] = ("product_name", "parent_category_name"),
                       per_product_once: bool = False) -> DataFrame:
    """Sold pieces over average stock.

    By default a product's sales count once per snapshot row, which multiplies them by the days
    on record; ``per_product_once`` counts them once. Both facts are summed per product first.
    """
    stock = _stock(star).groupBy("product_id").agg(
        F.sum("quantity_on_hand").alias("on_hand"), F.count(F.lit(1)).alias("days")
    )
    sold = star.product_totals.select("product_id", "quantity")
    weight = F.lit(1) if per_product_once else F.col("days")
    on_hand, days = F.sum("on_hand"), F.sum("days")
    total = F.sum(F.col("quantity") * weight)
    return (
        stock.join(star.products.select("product_id", *by), "product_id")
        .join(sold, "product_id", "left")
        .groupBy(*by)
        .agg(
            rounded_ratio(on_hand, days, 0).alias("avg_inventory"),
            total.alias("total_sold"),
            rounded_ratio(total * days, on_hand, 2).alias("turnover_rate"),
        )
        .orderBy(F.desc_nulls_last("turnover_rate"), *by)
    )


def _stock_days(star: Star) -> DataFrame:
    """Days on record and out of stock per product, before names come in."""
    out = F.col("is_out_of_stock")
    day = F.when(out, F.col("date_key"))
    per_product = _stock(star).groupBy("product_id").agg(
        F.count(F.lit(1)).alias("days"),
        F.count_if(out).alias("out"),
        F.min(day).alias("first"),
        F.max(day).alias("last"),
    )
    return per_product.withColumns({"first": day_of("first"), "last": day_of("last")}).join(
        star.staged("products", ["product_id", "product_name"]), "product_id"
    )


def _stockout_share() -> Column:
    return percentage(F.sum("out"), F.sum("days"))


def stockout_analysis(star: Star) -> DataFrame:
    return (
        _stock_days(star)
        .groupBy("product_name")
        .agg(F.sum("out").alias("stockout_days"), _stockout_share().alias("stockout_pct"))
        .where("stockout_days > 0")
        .orderBy(F.desc("stockout_days"), "product_name")
    )


def stockout_check(star: Star) -> DataFrame:
    return (
        _stock_days(star)
        .groupBy("product_name")
        .agg(
            F.sum("days").alias("total_days"),
            F.sum("out").alias("stockout_days"),
            _stockout_share().alias("stockout_pct"),
            F.min("first").alias("first_stockout_date"),
            F.max("last").alias("last_stockout_date"),
        )
        .where("stockout_days > 0")
        .orderBy(F.desc("stockout_days"), "product_name")
    )


def _on_latest_day(star: Star) -> DataFrame:
    """Stock of the last day of the fact. The day is a scalar subquery, found before the fact is
    read again and then compared with its row-group statistics."""
    stock = _stock(star)
    return stock.where(F.col("date_key") == star.fact_inventory_daily.select(F.max("date_key")).scalar())


def latest_inventory_status(star: Star, top: int = 20) -> DataFrame:
    """The latest day's stock, scarcest first; products that never sold have no days of supply
    and lead the list."""
    return (
        _on_latest_day(star)
        .join(star.products.select("product_id", "product_name", "category_name"), "product_id")
        .orderBy(F.asc_nulls_first("days_of_supply"), "product_id")
        .limit(top)
        .select(
            "product_name", "category_name", "quantity_on_hand", "quantity_available", "reorder_point",
            "days_of_supply", "is_out_of_stock", "is_below_reorder_point",
        )
    )


def sales_vs_stock(star: Star, top: int = 15) -> DataFrame:
    """Best sellers next to their latest stock."""
    stock = _on_latest_day(star).select("product_id", F.col("quantity_on_hand").alias("latest_stock"))
    sold = star.product_totals.select(
        "product_id", F.col("net_amount").alias("total_sales"), F.col("quantity").alias("total_qty_sold")
    )
    return (
        star.products.select("product_id", "product_name", "category_name")
        .join(sold, "product_id", "left")
        .join(stock, "product_id", "left")
        .orderBy(F.desc_nulls_last("total_sales"), "product_id")
        .limit(top)
        .select("product_name", "category_name", "total_sales", "total_qty_sold", "latest_stock")
    )


def product_stock_history(star: Star, product_id: int, top: int = 15) -> DataFrame:
    """The first days of one product's stock."""
    return (
        _stock(star).where(F.col("product_id") == product_id)
        .join(star.staged("products", ["product_id", "product_name"]), "product_id")
        .orderBy("date_key")
        .limit(top)
        .select(
            day_of("date_key").alias("full_date"), "product_name", "quantity_on_hand", "quantity_available",
            "days_of_supply",
        )
    )
