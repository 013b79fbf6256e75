"""Products: categories, ABC ranks, best sellers, cross-selling.

Sums over products start from one row per product, so neither a best seller nor a wide product
dimension meets the individual order lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.amounts import rounded_ratio
from starloom.operators.pairs import co_occurrence
from starloom.operators.shares import share_of_total
from starloom.plans.star import Star


def _cost() -> Column:
    """Cost of all pieces of a product: linear in the quantity, so computed after summing."""
    return F.col("quantity").cast("decimal(20,0)") * F.col("cost_price")


def _with_profit(totals: DataFrame) -> DataFrame:
    return totals.withColumn("gross_profit", F.col("net_amount") - _cost())


def _ranked_products(star: Star) -> DataFrame:
    """Sold products with totals, profit and rank."""
    return _with_profit(star.ranked_totals.join(star.products, "product_id"))


def category_ranking(star: Star) -> DataFrame:
    return (
        star.product_totals.join(star.products.select("product_id", "parent_category_name"), "product_id")
        .groupBy("parent_category_name")
        .agg(
            F.sum("net_amount").alias("total_net_amount"),
            F.sum("quantity").alias("total_quantity"),
            F.count(F.lit(1)).alias("product_count"),
        )
        .orderBy(F.desc("total_net_amount"), "parent_category_name")
    )


def category_sales(star: Star) -> DataFrame:
    """Sales, profit and average discount per category, with its distinct orders.

    The sums start from one row per product. Only (category, order) pairs are exchanged for the
    distinct count; in one aggregate the sums would travel with each of them.
    """
    keys = ("parent_category_name", "category_name")
    sums = (
        _with_profit(star.product_totals.join(star.products, "product_id"))
        .groupBy(*keys)
        .agg(
            F.lit(0).cast("bigint").alias("orders"),
            F.sum("net_amount").alias("net"),
            F.sum("gross_profit").alias("profit"),
            F.sum("discount_rates").alias("rates"),
            F.sum("discounted_lines").alias("rated"),
        )
    )
    orders = (
        star.sales.select("order_id", "product_id")
        .join(star.products.select("product_id", *keys), "product_id")
        .select(*keys, "order_id")
        .distinct()
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("orders"))
    )
    return (
        sums.unionByName(orders, allowMissingColumns=True)
        .groupBy(*keys)
        .agg(
            F.sum("orders").alias("order_count"),
            F.sum("net").alias("total_sales"),
            F.sum("profit").alias("total_profit"),
            rounded_ratio(F.sum("rates"), F.sum("rated"), 1).alias("avg_discount_rate"),
        )
        .orderBy(F.desc("total_sales"), *keys)
    )


def category_line_counts(star: Star) -> DataFrame:
    """Lines and sales per category, parents alphabetically and best category first."""
    return (
        star.product_totals.join(
            star.products.select("product_id", "parent_category_name", "category_name"), "product_id"
        )
        .groupBy("parent_category_name", "category_name")
        .agg(F.sum("line_count").alias("sales_count"), F.sum("net_amount").alias("total_sales"))
        .orderBy("parent_category_name", F.desc("total_sales"), "category_name")
    )


def abc_analysis(star: Star) -> DataFrame:
    """Every sold product has a rank, so the ranks' revenues add up to the grand total."""
    return (
        _ranked_products(star)
        .groupBy("abc_rank")
        .agg(
            F.count(F.lit(1)).alias("product_count"),
            F.sum("net_amount").alias("total_revenue"),
            F.sum("gross_profit").alias("total_profit"),
        )
        .withColumn("revenue_share_pct", share_of_total("total_revenue"))
        .orderBy("abc_rank")
    )


def abc_product_summary(star: Star) -> DataFrame:
    margin = F.col("gross_margin_pct").cast("decimal(12,2)")
    return (
        _ranked_products(star)
        .groupBy("abc_rank")
        .agg(
            F.count(F.lit(1)).alias("product_count"),
            F.sum("net_amount").alias("total_revenue"),
            rounded_ratio(F.sum(margin), F.count(margin), 1).alias("avg_margin_pct"),
        )
        .orderBy("abc_rank")
    )


def abc_sales_lines(star: Star) -> DataFrame:
    """Order lines and revenue by rank; ``products`` counts lines, as the dashboard shows it."""
    return (
        star.ranked_totals.groupBy("abc_rank")
        .agg(F.sum("line_count").alias("products"), F.sum("net_amount").alias("revenue"))
        .orderBy("abc_rank")
    )


def top_products(star: Star, top: int = 20) -> DataFrame:
    return (
        _ranked_products(star)
        .groupBy("product_name", "category_name", "abc_rank")
        .agg(
            F.sum("quantity").alias("total_qty"),
            F.sum("net_amount").alias("total_sales"),
            F.sum("gross_profit").alias("total_profit"),
        )
        .orderBy(F.desc("total_sales"), "product_name", "category_name", "abc_rank")
        .limit(top)
    )


def cross_sell(star: Star, min_support: int = 10, top: int = 20, by: str = "product_name") -> DataFrame:
    """Products bought together in the same order most often."""
    names = star.staged("products", sorted({"product_id", by}))
    baskets = star.sales.select("order_id", "product_id")
    if by != "product_id":
        baskets = baskets.join(names, "product_id").select("order_id", by)
    pairs = co_occurrence(baskets.where(F.col(by).isNotNull()).distinct(), "order_id", by, min_support)
    return (
        pairs.select(
            F.col("item_a").alias("product_a"), F.col("item_b").alias("product_b"),
            F.col("pairs").alias("co_purchase_count"),
        )
        .orderBy(F.desc("co_purchase_count"), "product_a", "product_b")
        .limit(top)
    )


def view_to_purchase(star: Star) -> DataFrame:
    """For each product whether its page was viewed and whether it was bought."""
    viewed = (
        star.views.where((F.col("page_type") == "product") & F.col("product_id").isNotNull())
        .where(F.col("view_timestamp").isNotNull())
        .select("product_id").distinct().withColumn("_viewed", F.lit(True))
    )
    bought = star.sales.select("product_id").distinct().withColumn("_bought", F.lit(True))
    return (
        star.staged("products", ["product_id", "product_name"])
        .join(viewed, "product_id", "left")
        .join(bought, "product_id", "left")
        .select(
            "product_name",
            F.col("_viewed").isNotNull().alias("was_viewed"),
            F.col("_bought").isNotNull().alias("was_purchased"),
        )
    )
