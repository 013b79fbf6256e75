"""Business logic between the staged tables and the star schema."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions import labels, scoring
from starloom.functions.amounts import as_decimal, gross, percent_of, ratio
from starloom.operators.joins import known_or_null
from starloom.operators.ranking import running_total


def active(status: str = "status") -> Column:
    return F.col(status) != labels.CANCELLED


def customers_with_region(customers: DataFrame, as_of: date, regions=labels.REGIONS) -> DataFrame:
    return customers.select(
        "customer_id",
        F.concat("last_name", F.lit(" "), "first_name").alias("full_name"),
        "email", "phone", "city", "prefecture",
        labels.region_of(F.col("prefecture"), regions).alias("region"),
        "gender",
        labels.age_band(F.col("birth_date"), F.lit(as_of)).alias("age_group"),
        "registration_channel", "created_at",
    )


def category_paths(categories: DataFrame) -> DataFrame:
    """Each category with its parent's name: the two-level hierarchy flattened."""
    parents = categories.select(
        F.col("category_id").alias("parent_id"), F.col("category_name").alias("parent_category_name")
    )
    return categories.join(parents, "parent_id", "left").select(
        "category_id", "category_name", "parent_category_name"
    )


def products_with_categories(products: DataFrame, paths: DataFrame) -> DataFrame:
    price = F.col("unit_price")
    margin = (price - F.col("cost_price")).cast("double") / F.nullif(price, F.lit(0).cast("decimal(12,2)")).cast("double")
    return products.join(paths, "category_id", "left").select(
        "product_id", "product_name", "category_name", "parent_category_name", "unit_price", "cost_price",
        F.round(margin * 100, 2).alias("gross_margin_pct"),
        "is_active",
    )


def with_amounts(items: DataFrame) -> DataFrame:
    """Gross, discount and net amount of each order line, exact to six decimals."""
    full = gross(F.col("unit_price"), F.col("quantity"))
    off = percent_of(full, F.col("discount_rate"))
    return items.withColumns({"gross_amount": full, "discount_amount": off, "net_amount": full - off})


def order_lines(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Order lines with their order's attributes. The amounts follow from a line and are not moved to its order."""
    return with_amounts(items.join(orders, "order_id"))


def flagged_orders(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders with their hour, and ``is_sale``: whether their lines belong into the sales fact.

    That takes a known customer, a date and a status.
    """
    known = customers.select(F.col("customer_id").alias("_known"))
    has_keys = F.col("_known").isNotNull() & F.col("order_date").isNotNull() & F.col("status").isNotNull()
    return (
        orders.join(known, F.col("customer_id") == F.col("_known"), "left")
        .withColumns({"is_sale": has_keys, "time_key": F.hour("order_timestamp").cast("bigint")})
        .drop("_known")
    )


def order_rollup(items: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """One row per order that has lines: order attributes and summed measures.

    ``line_count``, ``quantity``, ``net_amount`` and ``gross_profit`` are those of the sales fact,
    so they leave out lines of unknown products; ``all_net`` and ``all_line_count`` are over all lines.
    Lines are summed before they meet the orders, so an order with very many lines reaches the
    join as one row per map task.
    """
    costs = products.select(F.col("product_id").alias("_known"), "cost_price")
    lines = with_amounts(items).join(costs, F.col("product_id") == F.col("_known"), "left")
    sold = F.col("_known").isNotNull()
    cost = as_decimal(F.col("quantity")) * F.col("cost_price")
    totals = lines.groupBy("order_id").agg(
        F.count_if(sold).alias("line_count"),
        F.sum(F.when(sold, F.col("quantity"))).alias("quantity"),
        F.sum(F.when(sold, F.col("net_amount"))).alias("net_amount"),
        F.sum(F.col("net_amount") - cost).alias("gross_profit"),
        F.count(F.lit(1)).alias("all_line_count"),
        F.sum("net_amount").alias("all_net"),
    )
    return totals.join(orders, "order_id")


def written_order_totals(lines: DataFrame, customers: DataFrame, products: DataFrame, orders: DataFrame) -> DataFrame:
    """What :func:`customer_activity` reads of :func:`order_rollup`, from written lines that hold their order.

    Customers and products are looked up by the values they lack. ``customers`` and ``products`` need their ids;
    ``orders`` is a narrow table of all customers of the lines.
    """
    buyer, product = customers.select(F.col("customer_id").alias("_buyer")), products.select(F.col("product_id").alias("_sold"))
    lines = known_or_null(lines, buyer, "customer_id", "_buyer", "order_item_id", orders)
    lines = known_or_null(lines, product, "product_id", "_sold", "order_item_id")
    has_keys = F.col("_buyer").isNotNull() & F.col("order_date").isNotNull() & F.col("status").isNotNull()
    sold = F.col("_sold").isNotNull()
    return lines.groupBy("order_id", "customer_id", "order_date", "status", has_keys.alias("is_sale")).agg(
        F.count_if(sold).alias("line_count"),
        F.sum(F.when(sold, F.col("net_amount"))).alias("net_amount"),
        F.sum("net_amount").alias("all_net"),
    )


def customer_activity(order_totals: DataFrame) -> DataFrame:
    """Per customer: the orders of the sales fact, and separately all that were not cancelled.

    ``order_totals`` has one row per order, so counting rows counts distinct orders.
    """
    kept, sale = active(), F.col("is_sale") & (F.col("line_count") > 0)
    return order_totals.groupBy("customer_id").agg(
        F.count_if(sale).alias("all_orders"),
        F.sum(F.when(sale, F.col("line_count"))).alias("all_lines"),
        F.sum(F.when(sale, F.col("net_amount"))).alias("all_net"),
        F.count_if(kept).alias("total_orders"),
        F.sum(F.when(kept, F.col("all_net"))).alias("total_spent"),
        F.min(F.when(kept, F.col("order_date"))).alias("first_order_date"),
        F.max(F.when(kept, F.col("order_date"))).alias("last_order_date"),
    )


def with_customer_metrics(activity: DataFrame, as_of: date, bands: scoring.RfmBands) -> DataFrame:
    """Scores, segment and lifetime value next to the activity they follow from.

    Customers with nothing but cancelled orders carry no meaningful scores; see
    :func:`buyers`.
    """
    orders, spent = F.col("total_orders"), F.col("total_spent")
    recency = F.datediff(F.lit(as_of), F.col("last_order_date")).cast("bigint")
    scores = scoring.rfm_scores(recency, orders, spent, bands)
    yearly = scoring.annual_frequency(orders, F.col("first_order_date"), F.col("last_order_date"))
    average = ratio(spent, orders)
    segment = scoring.rfm_segment(*scores.values())
    return activity.withColumns({
        "recency_days": recency,
        **scores,
        "rfm_segment": F.when(orders > 0, segment).otherwise(labels.NEVER_BOUGHT),
        "avg_order_amount": average,
        "annual_frequency": yearly,
        "ltv_estimated": scoring.lifetime_value(average, yearly),
    })


def buyers(metrics: DataFrame) -> DataFrame:
    return metrics.where("total_orders > 0")


def customer_rfm(metrics: DataFrame) -> DataFrame:
    return buyers(metrics).select(
        "customer_id", "recency_days",
        F.col("total_orders").alias("frequency"), F.col("total_spent").alias("monetary"),
        "rfm_recency_score", "rfm_frequency_score", "rfm_monetary_score", "rfm_segment",
    )


def customer_ltv(metrics: DataFrame) -> DataFrame:
    return buyers(metrics).select(
        "customer_id", "first_order_date", "last_order_date", "total_orders", "total_spent",
        "avg_order_amount", "annual_frequency", "ltv_estimated",
    )


def product_totals(lines: DataFrame) -> DataFrame:
    """Per product, over all its lines."""
    return lines.groupBy("product_id").agg(
        F.count(F.lit(1)).alias("line_count"),
        F.sum("quantity").alias("quantity"),
        F.sum("net_amount").alias("net_amount"),
        F.sum("discount_rate").alias("discount_rates"),
        F.count("discount_rate").alias("discounted_lines"),
    )


def product_ranking(lines: DataFrame) -> DataFrame:
    """Per product: its lines in the sales fact, the revenue of those not cancelled, its place by that revenue.

    Products without revenue come last and add nothing, so one written table serves both the
    ranks and the totals.
    """
    kept, sale = active(), F.col("is_sale")
    activity = lines.groupBy("product_id").agg(
        F.count_if(sale).alias("line_count"),
        F.sum(F.when(sale, F.col("quantity"))).alias("quantity"),
        F.sum(F.when(sale, F.col("net_amount"))).alias("net_amount"),
        F.count_if(kept).alias("active_lines"),
        F.sum(F.when(kept, F.col("net_amount"))).alias("total_revenue"),
    )
    ranked = running_total(
        activity, [F.desc_nulls_last("total_revenue"), F.asc("product_id")], "total_revenue",
        rank="revenue_rank", running="cumulative_revenue", total="_grand_total",
    )
    share = ratio(F.col("cumulative_revenue"), F.col("_grand_total"))
    rank = F.when(F.col("active_lines") > 0, labels.abc_rank(F.col("cumulative_revenue"), F.col("_grand_total"))).otherwise(labels.LOWEST_RANK)
    return ranked.withColumns({"cumulative_pct": share, "abc_rank": rank}).drop("_grand_total")


def product_abc(ranking: DataFrame) -> DataFrame:
    return ranking.where("active_lines > 0").select(
        "product_id", "total_revenue", "revenue_rank", "cumulative_revenue", "cumulative_pct", "abc_rank"
    )


def page_view_sessions(views: DataFrame) -> DataFrame:
    page = F.col("page_type")
    return views.groupBy("session_id").agg(
        F.max("customer_id").alias("customer_id"),
        F.min("referrer_type").alias("referrer_type"),
        F.min("view_timestamp").alias("session_start"),
        F.max("view_timestamp").alias("session_end"),
        F.count(F.lit(1)).alias("page_view_count"),
        F.sum("duration_seconds").alias("total_duration_seconds"),
        F.bool_or(F.coalesce(page == "cart", F.lit(False))).alias("has_cart"),
        F.bool_or(F.coalesce(page == "complete", F.lit(False))).alias("has_purchase"),
    )


def daily_sales_average(lines: DataFrame) -> DataFrame:
    """Average pieces sold per product over the days it sold at all."""
    per_day = lines.where(active()).groupBy("product_id", "order_date").agg(F.sum("quantity").alias("sold"))
    return per_day.groupBy("product_id").agg(F.avg(F.col("sold").cast("double")).alias("daily_avg_sales"))


def inventory_with_sales(snapshots: DataFrame, daily_average: DataFrame) -> DataFrame:
    available = F.col("quantity_on_hand") - F.col("quantity_reserved")
    return snapshots.join(daily_average, "product_id", "left").select(
        "snapshot_id", "product_id", "snapshot_date", "quantity_on_hand", "quantity_reserved",
        available.alias("quantity_available"),
        "reorder_point", "lead_time_days",
        F.coalesce(F.col("daily_avg_sales"), F.lit(0.0)).alias("daily_avg_sales"),
        ratio(available, F.col("daily_avg_sales")).alias("days_of_supply"),
    )
