"""Every check fires on a planted defect and is silent without it."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from tables import raw_tables

from starloom.functions import labels
from starloom.plans import quality
from starloom.plans.star import MODELS

CLEAN = {
    "dim_date": ("date_key bigint", [(20250101,), (20250102,)]),
    "dim_time": ("time_key bigint", [(9,), (10,)]),
    "dim_customer": (
        "customer_key bigint, region string, rfm_segment string, total_orders bigint, "
        "rfm_recency_score bigint, rfm_frequency_score bigint, rfm_monetary_score bigint",
        [(1, "関東", "その他", 3, 1, 5, 3), (2, "不明", "未購入", 0, None, None, None)],
    ),
    "dim_product": ("product_key bigint, product_name string, abc_rank string", [(1, "p", "A"), (2, "q", "C")]),
    "dim_order_status": ("order_status_key bigint", [(1,)]),
    "dim_coupon": ("coupon_key bigint", [(1,)]),
    "fact_sales": (
        "order_item_id bigint, customer_key bigint, product_key bigint, date_key bigint, order_status_key bigint, "
        "time_key bigint, net_amount bigint",
        [(1, 1, 1, 20250101, 1, 9, 0), (2, 2, 2, 20250102, 1, 10, 5)],
    ),
    "fact_page_views": (
        "page_view_id bigint, date_key bigint, time_key bigint, session_id string, page_type string",
        [(1, 20250101, 9, "s", "checkout"), (2, 20250101, 9, "s", "complete"), (3, 20250102, 10, "t", "checkout")],
    ),
    "fact_inventory_daily": (
        "product_key bigint, date_key bigint, quantity_on_hand bigint, quantity_reserved bigint, quantity_available bigint",
        [(1, 20250101, 5, 2, 3), (2, 20250101, 0, 1, -1)],
    ),
}


class Planted:
    """Clean tables, with some rows added or replaced."""

    def __init__(self, spark, **extra):
        self.spark, self.extra = spark, extra

    def model(self, name):
        if name in CLEAN:
            schema, rows = CLEAN[name]
        else:
            schema, rows = f"{quality.KEYS[name]} bigint", [(1,), (2,)]
        return self.spark.createDataFrame([*rows, *self.extra.get(name, [])], schema).coalesce(1)


def test_clean_tables_pass(spark):
    failing = quality.summary(Planted(spark)).where("failing_rows > 0").collect()
    assert failing == []


def test_summary_has_every_check(spark):
    names = [(r["check_name"], r["table_name"], r["column_name"]) for r in quality.summary(Planted(spark)).collect()]
    kinds = [name for name, _, _ in names]
    assert (kinds.count("unique"), kinds.count("not_null"), kinds.count("relationships")) == (23, 34, 9)
    assert len(names) == len(set(names)) == 73
    assert set(quality.KEYS) - {"fact_page_views"} <= {*MODELS, *(f"stg_{t}" for t in quality.TABLES)}


DEFECTS = [
    ("unique", "dim_date", (20250101,), "value", "20250101"),
    ("unique", "int_customer_rfm", (2,), "value", "2"),
    ("unique", "stg_coupons", (1,), "value", "1"),
    ("not_null", "dim_time", (None,), "column_name", "time_key"),
    ("not_null", "dim_customer", (3, None, "その他", 1, 1, 1, 1), "column_name", "region"),
    ("not_null", "fact_sales", (3, None, 1, 20250101, 1, 9, 1), "column_name", "customer_key"),
    ("relationships", "fact_sales", (3, 99, 1, 20250101, 1, 9, 1), "value", "99"),
    ("relationships", "fact_sales", (3, 1, 1, 20250101, 1, 23, 1), "value", "23"),
    ("relationships", "fact_page_views", (4, 20991231, 9, "u", "top"), "value", "20991231"),
    ("relationships", "fact_inventory_daily", (7, 20250101, 1, 0, 1), "value", "7"),
    ("abc_rank_values", "dim_product", (3, "r", "D"), "abc_rank", "D"),
    ("rfm_segment_values", "dim_customer", (3, "x", "VIP", 1, 1, 1, 1), "rfm_segment", "VIP"),
    ("net_amount_not_negative", "fact_sales", (3, 1, 1, 20250101, 1, 9, -1), "order_item_id", 3),
    ("inventory_available", "fact_inventory_daily", (1, 20250102, 5, 2, 4), "expected_available", 3),
    ("inventory_not_negative", "fact_inventory_daily", (1, 20250102, -1, 0, -1), "quantity_on_hand", -1),
    ("funnel_consistency", "fact_page_views", (4, 20250101, 9, "u", "complete"), "session_id", "u"),
    ("rfm_score_range", "dim_customer", (3, "x", "その他", 1, 6, 1, 1), "customer_key", 3),
    ("rfm_score_range", "dim_customer", (3, "x", "その他", 1, 1, 0, None), "customer_key", 3),
    ("rfm_score_range", "dim_customer", (3, "x", "その他", 0, None, None, 2), "customer_key", 3),
]


@pytest.mark.parametrize("check, table, row, column, value", DEFECTS)
def test_planted_defect_is_found(spark, check, table, row, column, value):
    rows = getattr(quality, check)(Planted(spark, **{table: [row]}))
    if check == "not_null":
        rows = rows.where("null_rows > 0")
    found = rows.collect()
    assert [r[column] for r in found] == [value]
    if "table_name" in rows.columns:
        assert found[0]["table_name"] == table


def test_missing_values_pass_vocabulary_checks(spark):
    tables = Planted(spark, dim_product=[(3, "r", None)], dim_customer=[(3, "x", None, 1, 1, 1, 1)])
    assert quality.accepted_values(tables).collect() == []
    tables = Planted(spark, dim_product=[(3, "r", "Z")], dim_customer=[(3, "x", "Z", 1, 1, 1, 1)])
    assert {r["table_name"] for r in quality.accepted_values(tables).collect()} == {"dim_product", "dim_customer"}
    assert set(labels.SEGMENTS) >= {"その他", "未購入"}


def test_source_constraints(spark):
    raw = raw_tables(
        spark,
        customers=[{"customer_id": 1, "email": "a"}, {"customer_id": 2, "email": "a"}],
        categories=[{"category_id": 1, "parent_id": 9}],
        products=[{"product_id": 1, "category_id": 1}],
        orders=[{"order_id": 1, "customer_id": 1}, {"order_id": 1, "customer_id": 5}],
        order_items=[{"order_item_id": 1, "order_id": 1, "product_id": 1}],
        page_views=[{"page_view_id": 1}, {"page_view_id": 2, "product_id": 8}],
        inventory_snapshots=[
            {"snapshot_id": n, "product_id": 1, "snapshot_date": date(2025, 1, 1)} for n in (1, 2)
        ],
    )
    got = {tuple(r) for r in quality.source_constraints(raw).collect()}
    assert got == {
        ("unique", "customers", "email", "a", 2),
        ("unique", "orders", "order_id", "1", 2),
        ("unique", "inventory_snapshots", "product_id,snapshot_date", "1|2025-01-01", 2),
        ("foreign key", "categories", "parent_id", "9", 1),
        ("foreign key", "orders", "customer_id", "5", 1),
        ("foreign key", "page_views", "product_id", "8", 1),
    }


def test_schema_conformance(spark):
    raw = raw_tables(spark, page_views=[{"page_view_id": 1, "view_timestamp": datetime(2025, 1, 1)}])
    got = {(r["table_name"], r["column_name"]): (r["required"], r["null_rows"]) for r in quality.schema_conformance(raw).collect()}
    assert got["page_views", "page_view_id"] == (True, 0)
    assert got["page_views", "customer_id"] == (False, 1)
    assert len(got) == 65
