"""The star schema over one set of raw tables, built lazily."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions import labels
from starloom.functions.calendar import day_of
from starloom.functions.scoring import RfmBands
from starloom.operators.joins import known_or_null, left_key_lookup, small_or_plain
from starloom.plans import dimensions, facts
from starloom.plans import intermediate as logic
from starloom.plans.staging import stage
from starloom.session import delete_scratch, materialise, scratch_paths, tune
from starloom.sources.raw import RawTables

# What reports read of an order line: everything but its id.
LINE_COLUMNS = ("order_id", "product_id", "quantity", "unit_price", "discount_rate")
AMOUNTS = ("gross_amount", "discount_amount", "net_amount")
KEYED_COLUMNS = (
    "order_id", "customer_id", "order_date", "status", "order_item_id", "product_id", "quantity",
    "unit_price", "discount_rate", *AMOUNTS, "order_timestamp", "payment_method", "device_type", "coupon_code",
)
HEADER_COLUMNS = ("time_key", "payment_method", "device_type", "coupon_code")


class Star:
    """Staged tables, business logic, dimensions and facts as lazy DataFrames.

    Reports start from the narrowest frame that answers them (order or product roll-ups rather
    than the wide fact) and agree with the facts: lines of unknown customers or products and
    orders without a date are left out as the facts leave them out. On a written warehouse the
    same frames are taken from the written facts.
    """

    def __init__(
        self,
        raw: RawTables,
        as_of: date | None = None,
        bands: RfmBands = RfmBands(),
        regions: Mapping[str, Sequence[str]] = labels.REGIONS,
    ):
        self.spark = tune(raw.spark)
        self.raw, self.as_of, self.bands = raw, as_of or date.today(), bands
        self.regions = regions
        self.lines_written = self.totals_rebound = False
        self._staged: dict[str, DataFrame] = {}
        self._before = frozenset(scratch_paths(self.spark))

    def __enter__(self) -> Star:
        return self

    def __exit__(self, *_) -> None:
        self.close()

    def close(self) -> None:
        """Delete the scratch tables written in this application since the star was made.

        Its lazy reports, and those of stars made later, cannot be read afterwards.
        """
        delete_scratch(self.spark, [p for p in scratch_paths(self.spark) if p not in self._before])

    # staged tables -------------------------------------------------------------------------

    def staged(self, table: str, columns: Sequence[str] | None = None) -> DataFrame:
        if table in self._staged:
            known = self._staged[table]
            return known if columns is None else known.select(*columns)
        if columns is None:
            self._staged[table] = stage(self.raw, table)
            return self._staged[table]
        return stage(self.raw, table, columns)

    def rebind_staged(self, table: str, df: DataFrame) -> None:
        """Continue from a written copy of a staged table."""
        self._staged[table] = df

    def rebind(self, **frames: DataFrame) -> None:
        """Continue from written copies of derived tables instead of computing them again."""
        self.__dict__.update(frames)

    def rebind_sales(self, fact: DataFrame, statuses: DataFrame) -> None:
        """Take the frames of all sales reports from the written fact."""
        codes = statuses.select("order_status_key", F.col("status_code").alias("status"))
        sales = fact.join(codes, "order_status_key").select(
            "order_id",
            F.col("customer_key").alias("customer_id"),
            F.col("product_key").alias("product_id"),
            day_of("date_key").alias("order_date"),
            "status", "time_key", "payment_method", "device_type", "coupon_code",
            "quantity", "discount_rate", "net_amount", "gross_profit",
        )
        per_order = ("order_id", "customer_id", "order_date", "status", *HEADER_COLUMNS)
        orders = sales.groupBy(*per_order).agg(
            F.count(F.lit(1)).alias("line_count"),
            F.sum("quantity").alias("quantity"),
            F.sum("net_amount").alias("net_amount"),
            F.sum("gross_profit").alias("gross_profit"),
        )
        segments = self.dim_customer.select("customer_id", "rfm_segment")
        customers = orders.groupBy("customer_id").agg(
            F.count(F.lit(1)).alias("all_orders"),
            F.sum("line_count").alias("all_lines"),
            F.sum("net_amount").alias("all_net"),
        )
        products = logic.product_totals(sales)
        ranks = self.dim_product.select("product_id", "abc_rank")
        self.rebind(
            sales=sales,
            order_totals=orders,
            customer_sales=customers.join(segments, "customer_id"),
            product_totals=products,
            ranked_totals=products.join(ranks, "product_id"),
        )

    def rebind_product_totals(self, totals: DataFrame) -> None:
        """Take totals by product from a coarser table than the fact, such as the monthly aggregate."""
        self.rebind(product_totals=totals)
        self.totals_rebound = True

    def write_lines(self) -> None:
        """Write the joined lines with what reports on products read of them, and continue from the files."""
        headers = self.orders.select("order_id", "order_date", "status", "is_sale")
        self.rebind(lines=logic.with_amounts(materialise(self.items.join(headers, "order_id"), "lines")))

    @cached_property
    def orders(self) -> DataFrame:
        return logic.flagged_orders(self.staged("orders"), self.staged("customers", ["customer_id"]))

    @cached_property
    def items(self) -> DataFrame:
        """Order lines without their id."""
        return self.staged("order_items", LINE_COLUMNS)

    @cached_property
    def keyed_items(self) -> DataFrame:
        return self.staged("order_items")

    @cached_property
    def views(self) -> DataFrame:
        return self.staged("page_views")

    # business logic ------------------------------------------------------------------------

    @cached_property
    def lines(self) -> DataFrame:
        return logic.order_lines(self.items, self.orders)

    @cached_property
    def keyed_lines(self) -> DataFrame:
        return logic.order_lines(self.keyed_items, self.staged("orders"))

    @cached_property
    def keyed_lines_table(self) -> DataFrame:
        return self.keyed_lines.select(*KEYED_COLUMNS)

    @cached_property
    def sales(self) -> DataFrame:
        """The lines of the sales fact with what reports read of them."""
        known = self.staged("products", ["product_id"])
        return self.lines.where("is_sale").join(known, "product_id", "left_semi")

    @cached_property
    def all_order_totals(self) -> DataFrame:
        """One row per order that has lines, whether or not they are in the sales fact."""
        return logic.order_rollup(self.items, self.orders, self.staged("products", ["product_id", "cost_price"]))

    @cached_property
    def order_totals(self) -> DataFrame:
        """One row per order of the sales fact."""
        return self.all_order_totals.where("is_sale AND line_count > 0")

    @cached_property
    def customers(self) -> DataFrame:
        return logic.customers_with_region(self.staged("customers"), self.as_of, self.regions)

    @cached_property
    def category_paths(self) -> DataFrame:
        return small_or_plain(logic.category_paths(self.staged("categories")))

    @cached_property
    def products(self) -> DataFrame:
        return logic.products_with_categories(self.staged("products"), self.category_paths)

    @cached_property
    def customer_metrics(self) -> DataFrame:
        if self.lines_written:
            totals = logic.written_order_totals(
                self.keyed_lines_table, self.staged("customers", ["customer_id"]),
                self.staged("products", ["product_id"]), self.staged("orders", ["customer_id"]),
            )
        else:
            totals = self.all_order_totals
        return logic.with_customer_metrics(logic.customer_activity(totals), self.as_of, self.bands)

    @cached_property
    def customer_sales(self) -> DataFrame:
        """One row per customer of the sales fact: orders, lines, revenue and segment."""
        return self.customer_metrics.where("all_orders > 0")

    @cached_property
    def customer_rfm(self) -> DataFrame:
        return logic.customer_rfm(self.customer_metrics)

    @cached_property
    def customer_ltv(self) -> DataFrame:
        return logic.customer_ltv(self.customer_metrics)

    @cached_property
    def product_totals(self) -> DataFrame:
        """One row per product of the sales fact."""
        known = self.staged("products", ["product_id"])
        return logic.product_totals(self.lines.where("is_sale")).join(known, "product_id", "left_semi")

    @cached_property
    def ranked_totals(self) -> DataFrame:
        """``product_totals`` with the product's rank, which holds the totals already."""
        if self.totals_rebound:
            return self.product_totals.join(self.product_ranking.select("product_id", "abc_rank"), "product_id")
        known = self.staged("products", ["product_id"])
        sold = self.product_ranking.where("line_count > 0").join(known, "product_id", "left_semi")
        return sold.select("product_id", "line_count", "quantity", "net_amount", "abc_rank")

    @cached_property
    def product_ranking(self) -> DataFrame:
        return logic.product_ranking(self.lines)

    @cached_property
    def product_abc(self) -> DataFrame:
        return logic.product_abc(self.product_ranking)

    @cached_property
    def sessions(self) -> DataFrame:
        return logic.page_view_sessions(self.views)

    @cached_property
    def daily_sales_average(self) -> DataFrame:
        return logic.daily_sales_average(self.lines)

    @cached_property
    def inventory(self) -> DataFrame:
        return logic.inventory_with_sales(self.staged("inventory_snapshots"), self.daily_sales_average)

    # dimensions ----------------------------------------------------------------------------

    @cached_property
    def dim_date(self) -> DataFrame:
        return dimensions.dim_date([
            self.staged("orders", ["order_date"]),
            self.staged("page_views", ["view_timestamp"]).select(F.col("view_timestamp").cast("date").alias("day")),
            self.staged("inventory_snapshots", ["snapshot_date"]),
        ])

    @cached_property
    def dim_time(self) -> DataFrame:
        return dimensions.dim_time(self.spark)

    @cached_property
    def dim_customer(self) -> DataFrame:
        return dimensions.dim_customer(
            self.customers, logic.buyers(self.customer_metrics), self.as_of
        )

    @cached_property
    def dim_product(self) -> DataFrame:
        return dimensions.dim_product(self.products, self.product_ranking)

    @cached_property
    def dim_order_status(self) -> DataFrame:
        return small_or_plain(dimensions.dim_order_status(self.staged("orders", ["status"])))

    @cached_property
    def dim_coupon(self) -> DataFrame:
        return dimensions.dim_coupon(self.staged("coupons"))

    # facts ---------------------------------------------------------------------------------

    @cached_property
    def fact_sales(self) -> DataFrame:
        return facts.sale_amounts(self._priced_sales())

    def _priced_sales(self) -> DataFrame:
        customers = self.staged("customers", ["customer_id"])
        if "keyed_lines_table" in self.__dict__ and self.lines_written:  # lines and orders are joined already
            lines = facts.sale_headers(
                self.keyed_lines_table.drop(*AMOUNTS), customers, self.dim_order_status, self.staged("orders", ["customer_id"])
            )
        else:  # customer and status are looked up once per order
            headers = facts.sale_headers(self.staged("orders"), customers, self.dim_order_status)
            lines = self.keyed_items.join(headers, "order_id")
        return facts.priced_sales(lines, self.staged("products", ["product_id", "cost_price"]))

    @cached_property
    def fact_page_views(self) -> DataFrame:
        return facts.fact_page_views(
            self.views, self.staged("customers", ["customer_id"]), self.staged("products", ["product_id"]),
            known_or_null if self.lines_written else left_key_lookup,
        )

    @cached_property
    def fact_inventory_daily(self) -> DataFrame:
        used = self.staged("inventory_snapshots", ["product_id"]) if self.lines_written else None
        return facts.fact_inventory_daily(self.inventory, self.staged("products", ["product_id"]), used)

    def model(self, name: str) -> DataFrame:
        """Any table of the warehouse by its name."""
        if name.startswith("stg_"):
            return self.staged(name.removeprefix("stg_"))
        return getattr(self, MODELS[name])

    def narrow(self, name: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
        """A table to be laid out: its rows without the amounts that follow from them, and how to add those."""
        if MODELS.get(name) not in self.__dict__:  # else it is given, or read from a written copy
            if name == "fact_sales":
                return self._priced_sales(), facts.sale_amounts
            if name == "int_orders_with_items" and "keyed_lines" not in self.__dict__:
                lines = self.keyed_items.join(self.staged("orders"), "order_id")
                return lines.select(*[c for c in KEYED_COLUMNS if c not in AMOUNTS]), lambda rows: logic.with_amounts(rows).select(*KEYED_COLUMNS)
        return self.model(name), lambda rows: rows


# Warehouse table -> attribute of Star, for all tables above the staged ones.
MODELS = {
    "int_customers_with_region": "customers",
    "int_products_with_categories": "products",
    "int_orders_with_items": "keyed_lines_table",
    "int_customer_rfm": "customer_rfm",
    "int_customer_ltv": "customer_ltv",
    "int_product_abc": "product_abc",
    "int_page_view_sessions": "sessions",
    "int_inventory_with_sales": "inventory",
    **{name: name for name in (
        "dim_date", "dim_time", "dim_customer", "dim_product", "dim_order_status", "dim_coupon",
        "fact_sales", "fact_page_views", "fact_inventory_daily",
    )},
}
DIMENSIONS = tuple(name for name in MODELS if name.startswith("dim_"))
FACTS = tuple(name for name in MODELS if name.startswith("fact_"))
