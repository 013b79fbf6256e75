"""The eight operational tables derived from the wholesale test tables.

The rules are deterministic functions of each row; only the order line id needs more, because
wholesale lines of one order may share a number.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from starloom.functions.labels import REGIONS
from starloom.sources.raw import conform

# Lines of one order may share a number: these tell them apart.
LINE_ORDER = (
    "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
)

# An order line id is order, line number and copy in fields of 41, 10 and 12 bits.
ORDER_IDS, LINES, COPIES = 1 << 41, 1 << 10, 1 << 12


def _text_id(text: str) -> str:
    """A 60-bit id for a member of a small vocabulary."""
    return f"CAST(conv(substr(md5({text}), 1, 15), 16, 10) AS BIGINT)"


def _choice(index: str, values: Sequence[str]) -> str:
    """The value at a zero-based index; NULL one past the last."""
    items = ", ".join(f"'{value}'" for value in values)
    return f"try_element_at(array({items}), CAST({index} AS INT) + 1)"


CHILD_CATEGORY = _text_id("p_type || '/' || p_brand")

CUSTOMERS = {
    "customer_id": "c_custkey",
    "first_name": "c_name",
    "last_name": "c_mktsegment",
    "email": "'u' || c_custkey || '@example.com'",
    "phone": "IF(c_custkey % 5 = 0, NULL, '090-' || c_custkey)",
    "city": "'city-' || c_nationkey",
    "prefecture": _choice("c_custkey % 48", [name for names in REGIONS.values() for name in names]),
    "postal_code": "CAST(1000000 + c_nationkey * 1000 + c_custkey % 1000 AS STRING)",
    "created_at": "CAST(date_add(DATE '1995-01-01', CAST(c_custkey % 2000 AS INT)) AS TIMESTAMP)",
    "gender": "CASE WHEN c_custkey % 50 < 24 THEN '男性' WHEN c_custkey % 50 < 49 THEN '女性' ELSE 'その他' END",
    "birth_date": "IF(c_custkey % 97 = 0, NULL, "
                  "date_add(DATE '1940-01-01', CAST(c_custkey * 7919 % 22000 AS INT)))",
    "registration_channel": _choice(
        "c_custkey % 5", ["organic", "ad_search", "ad_social", "referral", "affiliate"]
    ),
}

PRODUCTS = {
    "product_id": "p_partkey",
    "product_name": "p_name",
    "category_id": CHILD_CATEGORY,
    "unit_price": "CAST(p_retailprice AS DECIMAL(12,2))",
    "description": "p_type || ' ' || p_brand",
    "created_at": "CAST(date_add(DATE '1994-01-01', CAST(p_partkey % 365 AS INT)) AS TIMESTAMP)",
    "cost_price": "IF(p_partkey % 50 = 0, NULL, CAST(CAST(p_retailprice AS DECIMAL(12,2)) * 0.6 AS DECIMAL(12,2)))",
    "weight_gram": "p_size * 100",
    "is_active": "p_size <= 40",
}

_STATUS = (
    "CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW' THEN 'cancelled' "
    "WHEN o_orderstatus = 'P' AND o_orderpriority = '4-NOT SPECIFIED' THEN 'confirmed' "
    "WHEN o_orderstatus = 'P' THEN 'pending' WHEN o_orderstatus = 'O' THEN 'shipped' ELSE 'delivered' END"
)
ORDERS = {
    "order_id": "o_orderkey",
    "customer_id": "o_custkey",
    "order_date": "CAST(o_orderdate AS DATE)",
    "shipping_address": "'address of ' || o_custkey",
    # every third status arrives padded and in capitals, as operational text does
    "status": f"IF(o_orderkey % 3 = 0, '  ' || upper({_STATUS}) || ' ', {_STATUS})",
    "created_at": "CAST(o_orderdate AS TIMESTAMP)",
    "updated_at": "CAST(NULL AS TIMESTAMP)",
    "order_timestamp": "CAST(o_orderdate AS TIMESTAMP) + make_dt_interval(0, CAST(o_orderkey % 24 AS INT))",
    "payment_method": "CASE o_orderpriority WHEN '1-URGENT' THEN 'credit_card' WHEN '2-HIGH' THEN 'bank_transfer' "
                      "WHEN '3-MEDIUM' THEN 'convenience_store' WHEN '4-NOT SPECIFIED' THEN 'carrier' ELSE 'cod' END",
    "device_type": "CASE WHEN o_orderkey % 10 < 6 THEN 'mobile' WHEN o_orderkey % 10 < 9 THEN 'desktop' ELSE 'tablet' END",
    "coupon_code": "IF(o_orderkey % 7 = 0, 'C' || (o_custkey div 15), NULL)",
}

ORDER_ITEMS = {
    "order_id": "l_orderkey",
    "product_id": "l_partkey",
    "quantity": "CAST(l_quantity AS BIGINT)",
    # whole cents per piece, so that the price is a two-decimal number
    "unit_price": "CAST(floor(l_extendedprice * 100 + 0.5D) div nullif(CAST(l_quantity AS BIGINT), 0) "
                  "AS DECIMAL(12,0)) * 0.01",
    "discount": "floor(l_discount * 100 + 0.5D)",
}

PAGE_VIEWS = {
    "page_view_id": "event_id",
    "customer_id": "IF(event_id % 10 = 0, NULL, user_id)",
    "session_id": "user_id || '-' || CAST(ts AS DATE)",
    "page_type": "CASE event_type WHEN 'signup' THEN 'top' WHEN 'view' THEN 'product' WHEN 'error' THEN 'checkout' "
                 "WHEN 'purchase' THEN 'complete' ELSE IF(event_id % 3 = 0, 'cart', 'category') END",
    "product_id": "IF(event_type = 'view', user_id * 10 + event_id % 10, NULL)",
    "category_id": "CAST(NULL AS BIGINT)",
    "referrer_type": _choice(
        "event_id % 7", ["direct", "search_organic", "search_paid", "social", "email", "referral"]
    ),
    "view_timestamp": "CAST(ts AS TIMESTAMP)",
    "duration_seconds": "IF(event_id % 13 = 0, NULL, CAST(floor(value) AS BIGINT))",
}

_DAY = "dayofyear(snapshot_date)"
_DAY_NUMBER = "datediff(snapshot_date, DATE '1970-01-01')"
_ON_HAND = f"(p_partkey * 37 + {_DAY} * 13) % 200"
INVENTORY = {
    "snapshot_id": f"p_partkey * 100000 + {_DAY_NUMBER}",
    "product_id": "p_partkey",
    "snapshot_date": "snapshot_date",
    "quantity_on_hand": _ON_HAND,
    "quantity_reserved": f"least({_ON_HAND}, (p_partkey + {_DAY}) % 40)",
    "reorder_point": "20 + p_partkey % 30",
    "lead_time_days": "3 + p_partkey % 12",
}

COUPONS = {
    "coupon_id": "s_suppkey",
    "coupon_code": "'C' || s_suppkey",
    "coupon_type": "IF(s_suppkey % 2 = 0, 'percentage', 'fixed_amount')",
    "discount_value": "IF(s_suppkey % 2 = 0, 5 * (1 + s_suppkey % 4), 100 * (1 + s_suppkey % 10))",
    "min_order_amount": "IF(s_suppkey % 5 = 0, NULL, 1000)",
    "valid_from": "date_add(DATE '1995-01-01', CAST(s_suppkey % 1000 AS INT))",
    "valid_to": "date_add(DATE '1999-01-01', CAST(s_suppkey % 1000 AS INT))",
    "campaign_name": "'campaign of ' || s_name",
}

# Table -> (file, column rules); categories and order_items need more than a projection.
PROJECTIONS = {
    "customers": ("customer", CUSTOMERS),
    "products": ("part", PRODUCTS),
    "orders": ("orders", ORDERS),
    "page_views": ("events", PAGE_VIEWS),
    "coupons": ("supplier", COUPONS),
}


# The state of customers and products on the day of each load: some move or are priced anew, some of the
# customers come or go between loads.
LOAD_DAYS = (date(1994, 12, 31), date(1997, 6, 30), date(1999, 6, 30))
CUSTOMER_LOAD = {
    "customer_id": "c_custkey",
    "city": "'city-' || ((c_nationkey + IF((c_custkey + {load}) % 5 = 0, {load}, 0)) % 25)",
    "prefecture": CUSTOMERS["prefecture"],
    "registration_channel": CUSTOMERS["registration_channel"],
}
CUSTOMER_PRESENT = "NOT (c_custkey % 11 = 5 AND {load} = 0) AND NOT (c_custkey % 13 = 6 AND {load} = 2)"
PRODUCT_LOAD = {
    "product_id": "p_partkey",
    "unit_price": "CAST(CAST(p_retailprice AS DECIMAL(12,2)) + IF((p_partkey + {load}) % 4 = 0, 10 * {load}, 0) AS DECIMAL(12,2))",
    "is_active": "p_size <= 40",
}


class RetailTables:
    """The operational tables over one folder of wholesale parquet files."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._files: dict[str, DataFrame] = {}

    def _file(self, name: str) -> DataFrame:
        if name not in self._files:
            self._files[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._files[name]

    def table(self, name: str, columns: Sequence[str] | None = None) -> DataFrame:
        if name in PROJECTIONS:
            file, rules = PROJECTIONS[name]
            df = self._project(self._file(file), rules, columns)
        else:
            df = getattr(self, f"_{name}")(columns)
        return conform(df, name, columns)

    @staticmethod
    def _project(df: DataFrame, rules: dict[str, str], columns: Sequence[str] | None) -> DataFrame:
        wanted = [name for name in rules if columns is None or name in columns]
        return df.selectExpr(*[f"{rules[name]} AS {name}" for name in wanted])

    def load(self, table: str, number: int) -> DataFrame:
        """Customers or products as they stood on ``LOAD_DAYS[number]``."""
        file, rules, present = {
            "customers": ("customer", CUSTOMER_LOAD, CUSTOMER_PRESENT), "products": ("part", PRODUCT_LOAD, "true")
        }[table]
        own = {name: rule.format(load=number) for name, rule in rules.items()}
        return self._project(self._file(file).where(present.format(load=number)), own, None)

    def order_promotions(self) -> DataFrame:
        """Promotions applied to an order, one per supplier of its lines, with their price in cents as ``basis``."""
        cents = F.expr("coalesce(CAST(floor(l_extendedprice * 100 + 0.5D) AS BIGINT), 0)")
        applied = self._file("lineitem").groupBy(F.col("l_orderkey").alias("order_id"), F.col("l_suppkey").alias("promotion_key"))
        return applied.agg(F.sum(cents).alias("basis"))

    def shipments(self) -> DataFrame:
        """Lines per order and day of shipment."""
        days = F.col("l_shipdate").cast("date").alias("ship_date")
        return self._file("lineitem").groupBy(F.col("l_orderkey").alias("order_id"), days).agg(F.count(F.lit(1)).alias("lines"))

    def _categories(self, columns: Sequence[str] | None) -> DataFrame:
        parts = self._file("part")
        top = parts.select("p_type").distinct().selectExpr(
            f"{_text_id('p_type')} AS category_id", "p_type AS name", "CAST(NULL AS BIGINT) AS parent_id"
        )
        below = parts.select("p_type", "p_brand").distinct().selectExpr(
            f"{CHILD_CATEGORY} AS category_id", "p_brand AS name", f"{_text_id('p_type')} AS parent_id"
        )
        return top.unionByName(below)

    def _order_items(self, columns: Sequence[str] | None) -> DataFrame:
        lines, rules = self._file("lineitem"), ORDER_ITEMS
        if columns is None or "order_item_id" in columns:
            same_number = Window.partitionBy("l_orderkey", "l_linenumber").orderBy(*LINE_ORDER)
            line, copy = F.col("l_linenumber"), F.row_number().over(same_number)
            fits = line.between(0, LINES - 1) & (copy < COPIES) & (F.col("l_orderkey") < ORDER_IDS)
            number = (F.col("l_orderkey") * LINES + line) * COPIES + copy
            lines = lines.withColumn(
                "order_item_id", F.when(fits, number).otherwise(F.raise_error("an order line number does not fit its id"))
            )
            rules = {"order_item_id": "order_item_id", **rules}
        return self._project(lines, rules, columns)

    def _inventory_snapshots(self, columns: Sequence[str] | None) -> DataFrame:
        """A snapshot of each part on every day that some of it was shipped."""
        stocked = self._file("lineitem").selectExpr("l_partkey AS p_partkey", "CAST(l_shipdate AS DATE) AS snapshot_date")
        stocked = stocked.distinct()
        return self._project(stocked, INVENTORY, columns)
