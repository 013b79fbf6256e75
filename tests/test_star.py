from __future__ import annotations

from datetime import date, datetime, timedelta
from decimal import Decimal
from pathlib import Path

import pytest
from tables import AS_OF, dicts, raw_tables

from starloom.plans import warehouse
from starloom.plans.reports import catalog, customers, inventory, products, sales, traffic
from starloom.plans.star import Star
from starloom.session import scratch_paths

D = Decimal


def day(back: int) -> date:
    return AS_OF - timedelta(days=back)


def shop(spark, **tables) -> Star:
    """A star over the given rows; if no customers (products) are listed, all that are referred to are known."""
    for parent, key in (("customers", "customer_id"), ("products", "product_id")):
        children = [row for name in ("orders", "order_items", "inventory_snapshots") for row in tables.get(name, [])]
        if parent not in tables:
            ids = {row.get(key, 0) for row in children if key in row or parent == "customers"}
            tables[parent] = [{key: value} for value in sorted(ids)]
    return Star(raw_tables(spark, **tables), AS_OF)


def order(order_id, customer_id=1, back=0, status="delivered", **more):
    when = day(back)
    return {"order_id": order_id, "customer_id": customer_id, "order_date": when, "status": status,
            "order_timestamp": datetime(when.year, when.month, when.day, 10), **more}


def item(item_id, order_id, product_id=1, quantity=1, price="100.00", discount="0"):
    return {"order_item_id": item_id, "order_id": order_id, "product_id": product_id, "quantity": quantity,
            "unit_price": price, "discount": discount}


def test_status_is_cleaned_and_unmapped_status_labelled(spark):
    star = shop(spark, orders=[order(1, status=" Delivered\t"), order(2, status="SHIPPED"), order(3, status="odd")])
    got = {r["status_code"]: (r["order_status_key"], r["status_label"]) for r in star.dim_order_status.collect()}
    assert got == {"delivered": (1, "配達完了"), "odd": (2, "不明"), "shipped": (3, "発送済")}


def test_product_margin(spark):
    star = shop(
        spark,
        categories=[{"category_id": 1, "name": "top"}, {"category_id": 2, "name": "leaf", "parent_id": 1}],
        products=[
            {"product_id": 1, "category_id": 2, "unit_price": "300", "cost_price": "200"},
            {"product_id": 2, "category_id": 1, "unit_price": "300"},
            {"product_id": 3, "category_id": 9, "unit_price": "0", "cost_price": "5"},
        ],
    )
    got = {r["product_id"]: (r["category_name"], r["parent_category_name"], r["gross_margin_pct"])
           for r in star.products.collect()}
    assert got == {1: ("leaf", "top", 33.33), 2: ("top", None, None), 3: (None, None, None)}


def test_line_amounts_are_exact(spark):
    star = shop(spark, orders=[order(1)], order_items=[item(1, 1, quantity=3, price="333.33", discount="12.5")])
    (row,) = dicts(star.model("int_orders_with_items"))
    assert (row["gross_amount"], row["discount_amount"], row["net_amount"]) == (
        D("999.99"), D("124.998750"), D("874.991250"))


def test_customer_metrics(spark):
    star = shop(
        spark,
        customers=[{"customer_id": n, "created_at": datetime(2025, 6, 20, 23)} for n in range(1, 6)],
        orders=[
            order(1, 1, back=30), order(2, 1, back=395),   # two orders a year apart
            order(3, 2, back=31, status="cancelled"),      # nothing but cancelled
            order(4, 3, back=100), order(5, 3, back=100),  # two on one day
            order(6, 4, back=366),                         # a single one
        ],
        order_items=[item(n, n, price="600000.00") for n in (1, 2, 3, 4, 5, 6)],
    )
    got = {r["customer_id"]: r for r in dicts(star.dim_customer)}
    assert [got[n]["rfm_segment"] for n in range(1, 6)] == ["有望", "未購入", "その他", "休眠", "未購入"]
    assert [got[n]["total_orders"] for n in range(1, 6)] == [2, 0, 2, 1, 0]
    assert got[2]["rfm_recency_score"] is None and got[2]["total_spent"] == 0
    assert got[1]["ltv_estimated"] == pytest.approx(600000 * (2 / (365 / 365.0)) * 3)
    assert got[3]["ltv_estimated"] is None
    assert got[4]["ltv_estimated"] == 600000 * 3
    assert {r["customer_tenure_days"] for r in got.values()} == {10}
    assert {r["customer_id"] for r in star.customer_rfm.collect()} == {1, 3, 4}


def test_sales_by_segment_include_cancelled_lines(spark):
    star = shop(
        spark,
        customers=[{"customer_id": 1}, {"customer_id": 2}],
        orders=[order(1, 1, back=1), order(2, 2, back=1, status="cancelled")],
        order_items=[item(1, 1, price="10"), item(2, 1, price="20"), item(3, 2, price="70")],
    )
    got = {r["rfm_segment"]: (r["customer_count"], r["total_revenue"], r["avg_order_amount"])
           for r in customers.rfm_segment_sales(star).collect()}
    assert got == {"未購入": (1, D(70), 70.0), "有望": (1, D(30), 15.0)}


def test_abc_cuts_ties_and_unsold_products(spark):
    star = shop(
        spark,
        products=[{"product_id": n, "category_id": 1} for n in range(1, 8)],
        orders=[order(1), order(2, status="cancelled")],
        order_items=[
            item(1, 1, 1, price="60"), item(2, 1, 2, price="25"),
            item(3, 1, 4, price="5"), item(4, 1, 3, price="5"), item(5, 1, 5, price="5"),
            item(6, 2, 6, price="500"),  # only cancelled
        ],
    )
    abc = {r["product_id"]: (r["revenue_rank"], r["cumulative_pct"], r["abc_rank"]) for r in star.product_abc.collect()}
    assert abc == {1: (1, 0.6, "A"), 2: (2, 0.85, "B"), 3: (3, 0.9, "C"), 4: (4, 0.95, "C"), 5: (5, 1.0, "C")}
    ranks = {r["product_id"]: r["abc_rank"] for r in star.dim_product.collect()}
    assert ranks[6] == ranks[7] == "C"
    summary = {r["abc_rank"]: r["revenue"] for r in products.abc_sales_lines(star).collect()}
    assert summary == {"A": D(60), "B": D(25), "C": D(515)}


def test_one_dominant_product_ranks_lowest(spark):
    star = shop(spark, orders=[order(1)], order_items=[item(1, 1, 1, price="95"), item(2, 1, 2, price="5")])
    assert {r["product_id"]: r["abc_rank"] for r in star.product_abc.collect()} == {1: "C", 2: "C"}


def view(view_id, session="s", page="top", **more):
    return {"page_view_id": view_id, "session_id": session, "page_type": page,
            "view_timestamp": datetime(2025, 6, 1, 9, view_id % 60), **more}


def test_sessions(spark):
    star = shop(spark, page_views=[
        view(1, "a", "top", referrer_type="social", duration_seconds=5),
        view(2, "a", "cart", referrer_type="email", customer_id=7),
        view(3, "b", "complete"),
    ])
    got = {r["session_id"]: r for r in dicts(star.sessions)}
    a, b = got["a"], got["b"]
    assert (a["customer_id"], a["referrer_type"], a["page_view_count"], a["total_duration_seconds"]) == (7, "email", 2, 5)
    assert (a["has_cart"], a["has_purchase"], b["has_cart"], b["has_purchase"]) == (True, False, False, True)
    assert (b["customer_id"], b["total_duration_seconds"]) == (None, None)
    assert a["session_end"] - a["session_start"] == timedelta(minutes=1)


def test_funnel_counts_sessions_and_needs_a_first_stage(spark):
    rows = [view(1, "a", "top"), view(2, "a", "top"), view(3, "b", "top"), view(4, "a", "cart"), view(5, "a", "search")]
    got = {r["page_type"]: (r["sessions"], r["pct_of_top"]) for r in traffic.conversion_funnel(shop(spark, page_views=rows)).collect()}
    assert got == {"top": (2, 100.0), "cart": (1, 50.0)}
    alone = traffic.conversion_funnel(shop(spark, page_views=rows[3:])).collect()
    assert [tuple(r) for r in alone] == [("cart", 1, None)]


def test_funnel_views_follow_the_stages(spark):
    star = shop(spark, page_views=[view(1, page="zzz"), view(2, page="cart"), view(3, page="home"), view(4, page="product")])
    assert [r["page_type"] for r in traffic.funnel_page_views(star).collect()] == ["home", "product", "cart", "zzz"]


def stock(snapshot_id, product_id, back, on_hand, reserved=0, reorder=5):
    return {"snapshot_id": snapshot_id, "product_id": product_id, "snapshot_date": day(back),
            "quantity_on_hand": on_hand, "quantity_reserved": reserved, "reorder_point": reorder}


def stocked_shop(spark) -> Star:
    return shop(
        spark,
        products=[{"product_id": 1, "product_name": "p", "category_id": 1}, {"product_id": 2, "product_name": "q", "category_id": 1}],
        orders=[order(1, back=2), order(2, back=1), order(3, back=0, status="cancelled")],
        order_items=[item(1, 1, 1, 4), item(2, 1, 1, 2), item(3, 2, 1, 2), item(4, 3, 1, 100)],
        inventory_snapshots=[stock(1, 1, 1, 10, 2), stock(2, 1, 0, 5), stock(3, 2, 0, 3, 3), stock(4, 2, 1, 2, 4)],
    )


def test_inventory_average_ignores_days_without_sales(spark):
    got = {r["snapshot_id"]: (r["quantity_available"], r["daily_avg_sales"], r["days_of_supply"])
           for r in stocked_shop(spark).inventory.collect()}
    assert got == {1: (8, 4.0, 2.0), 2: (5, 4.0, 1.25), 3: (0, 0.0, None), 4: (-2, 0.0, None)}


def test_inventory_fact_flags(spark):
    got = {(r["product_key"], r["date_key"] % 100): (r["is_below_reorder_point"], r["is_out_of_stock"])
           for r in stocked_shop(spark).fact_inventory_daily.collect()}
    assert got == {(1, 29): (False, False), (1, 30): (False, False), (2, 30): (True, True), (2, 29): (True, True)}


def test_inventory_reports(spark):
    star = stocked_shop(spark)
    turnover = {r["product_name"]: (r["avg_inventory"], r["total_sold"], r["turnover_rate"])
                for r in inventory.inventory_turnover(star).collect()}
    # 108 pieces, cancelled ones included, counted once per snapshot row
    assert turnover == {"p": (8.0, 216, 28.8), "q": (3.0, None, None)}
    once = {r["product_name"]: r["total_sold"] for r in inventory.inventory_turnover(star, per_product_once=True).collect()}
    assert once == {"p": 108, "q": None}
    (row,) = dicts(inventory.stockout_check(star))
    assert (row["product_name"], row["total_days"], row["stockout_days"], row["stockout_pct"]) == ("q", 2, 2, 100.0)
    assert (row["first_stockout_date"], row["last_stockout_date"]) == (day(1), day(0))
    assert [r["product_name"] for r in inventory.latest_inventory_status(star).collect()] == ["q", "p"]
    assert [r["latest_stock"] for r in inventory.sales_vs_stock(star).collect()] == [5, 3]
    assert [r["quantity_on_hand"] for r in inventory.product_stock_history(star, 1).collect()] == [10, 5]


def test_calendar_spans_all_sources_without_a_cap(spark):
    star = shop(spark, orders=[order(1, back=2000)], page_views=[view(1)], inventory_snapshots=[stock(1, 1, 0, 1)])
    days = star.dim_date.count()
    assert days == 2001
    months = traffic.sales_vs_views_monthly(star).collect()
    assert len(months) == 66 and sum(r["page_view_count"] for r in months) == 1


def test_page_view_fact_keeps_anonymous_and_unknown(spark):
    star = shop(
        spark,
        customers=[{"customer_id": 1}], products=[{"product_id": 5}],
        page_views=[view(1, customer_id=1, product_id=5), view(2), view(3, customer_id=9, product_id=9)],
    )
    got = {r["page_view_id"]: (r["customer_key"], r["product_key"], r["date_key"], r["time_key"])
           for r in star.fact_page_views.collect()}
    assert got == {1: (1, 5, 20250601, 9), 2: (None, None, 20250601, 9), 3: (None, None, 20250601, 9)}


def test_sales_fact(spark):
    star = shop(
        spark,
        customers=[{"customer_id": 1}],
        products=[{"product_id": 1, "cost_price": "40"}, {"product_id": 2}],
        orders=[order(1), order(2, customer_id=99)],
        order_items=[item(1, 1, 1, 2), item(2, 1, 2), item(3, 2, 1), item(4, 1, 77)],
    )
    got = {r["order_item_id"]: (r["cost_amount"], r["gross_profit"], r["time_key"]) for r in star.fact_sales.collect()}
    assert got == {1: (D(80), D(120), 10), 2: (None, None, 10)}  # unknown customer and product drop out


DANGLING = dict(
    customers=[{"customer_id": 1, "prefecture": "北海道"}, {"customer_id": 2}],
    categories=[{"category_id": 1, "name": "top"}],
    products=[{"product_id": 1, "category_id": 1, "cost_price": "40"}, {"product_id": 2, "category_id": 1}],
    orders=[
        order(1, coupon_code="C1"), order(2, customer_id=99), order(3, customer_id=2, status="cancelled"),
        {**order(4), "order_date": None}, order(5, back=400),
    ],
    order_items=[item(1, 1, 1, 2), item(2, 2, 1), item(3, 1, 77), item(4, 3, 2), item(5, 4, 1), item(6, 5, 88), item(7, 5, 2)],
    inventory_snapshots=[
        {"snapshot_id": 1, "product_id": 1, "snapshot_date": day(3), "quantity_on_hand": 5, "quantity_reserved": 5},
        {"snapshot_id": 2, "product_id": 77, "snapshot_date": day(1), "quantity_on_hand": 9},
    ],
    coupons=[{"coupon_id": 1, "coupon_code": "C1"}],
)


def of_fact(star, report: str):
    """The same numbers by SQL over the facts and dimensions."""
    for name in ("fact_sales", "dim_date", "dim_customer", "dim_product", "dim_order_status", "fact_inventory_daily"):
        star.model(name).createOrReplaceTempView(name)
    return star.spark.sql(report).collect()


FACT_SQL = {
    "monthly_sales": (sales.monthly_sales, ["order_count", "line_item_count", "total_net_amount"], """
        SELECT count(DISTINCT order_id), count(*), sum(net_amount) FROM fact_sales JOIN dim_date USING (date_key)
        GROUP BY year, month ORDER BY year, month"""),
    "payment_mix": (sales.payment_mix, ["orders", "sales"],
                    "SELECT count(DISTINCT order_id), sum(net_amount) FROM fact_sales GROUP BY payment_method"),
    "monthly_profit": (sales.monthly_sales_profit, ["total_profit"], """
        SELECT sum(gross_profit) FROM fact_sales JOIN dim_date USING (date_key) GROUP BY year, month ORDER BY year, month"""),
    "hours": (sales.hourly_sales, ["order_count", "total_revenue"],
              "SELECT count(DISTINCT order_id), sum(net_amount) FROM fact_sales GROUP BY time_key"),
    "rfm": (customers.rfm_segment_sales, ["rfm_segment", "customer_count", "total_revenue"], """
        SELECT rfm_segment, count(DISTINCT customer_key), sum(net_amount) r FROM fact_sales JOIN dim_customer
        USING (customer_key) GROUP BY 1 ORDER BY r DESC, 1"""),
    "regions": (customers.region_sales, ["region", "orders", "total_sales"], """
        SELECT region, count(DISTINCT order_id), sum(net_amount) r FROM fact_sales JOIN dim_customer
        USING (customer_key) GROUP BY 1 ORDER BY r DESC, 1"""),
    "abc": (products.abc_analysis, ["abc_rank", "product_count", "total_revenue"], """
        SELECT abc_rank, count(DISTINCT product_key), sum(net_amount) FROM fact_sales JOIN dim_product
        USING (product_key) GROUP BY 1 ORDER BY 1"""),
    "categories": (products.category_sales, ["order_count", "total_sales"],
                   "SELECT count(DISTINCT order_id), sum(net_amount) FROM fact_sales"),
    "top": (products.top_products, ["total_qty", "total_sales"], """
        SELECT sum(quantity), sum(net_amount) r FROM fact_sales JOIN dim_product USING (product_key)
        GROUP BY product_name, category_name, abc_rank ORDER BY r DESC"""),
    "coupons": (sales.coupon_usage, ["order_id", "net_amount"],
                "SELECT order_id, net_amount FROM fact_sales WHERE coupon_code IS NOT NULL"),
    "stock": (inventory.latest_inventory_status, ["quantity_on_hand", "is_out_of_stock"], """
        SELECT quantity_on_hand, is_out_of_stock FROM fact_inventory_daily
        WHERE date_key = (SELECT max(date_key) FROM fact_inventory_daily)"""),
    "stockouts": (inventory.stockout_check, ["total_days", "stockout_days"],
                  "SELECT count(*), count_if(is_out_of_stock) FROM fact_inventory_daily"),
}


@pytest.mark.parametrize("name", list(FACT_SQL))
@pytest.mark.parametrize("written", [False, True])
def test_reports_agree_with_the_facts_when_keys_dangle(spark, name, written, tmp_path_factory):
    report, columns, sql = FACT_SQL[name]
    star = shop(spark, **DANGLING)
    if written:
        tables, _ = warehouse.build(star, str(tmp_path_factory.mktemp("dangling")))
        star = tables.star(AS_OF)
    got = [tuple(r) for r in report(star).select(*columns).collect()]
    assert got == [tuple(r) for r in of_fact(star, sql)]


def test_row_counts_are_those_of_the_facts(spark):
    star = shop(spark, **DANGLING)
    counts = {r["table_name"]: r["row_count"] for r in catalog.table_row_counts(star).collect()}
    assert (counts["fact_sales"], counts["fact_inventory_daily"]) == (3, 1)


def test_year_over_year_and_moving_average(spark):
    star = shop(
        spark,
        orders=[
            {"order_id": n, "order_date": d} for n, d in enumerate(
                [date(2024, 1, 5), date(2025, 1, 6), date(2025, 1, 7), date(2025, 2, 7), date(2026, 2, 7)], 1)
        ],
        order_items=[item(n, n, price=str(n * 10)) for n in range(1, 6)],
    )
    got = {r["year_month"]: (r["prev_year_revenue"], r["yoy_growth_pct"]) for r in sales.monthly_sales_yoy(star).collect()}
    assert got == {"2024-01": (None, None), "2025-01": (D(10), 400.0), "2025-02": (None, None), "2026-02": (D(40), 25.0)}
    # the average runs over rows, not calendar days
    assert [r["moving_avg_2d"] for r in sales.moving_average(star, 2).collect()] == [10.0, 15.0, 25.0, 35.0, 45.0]


def test_cohorts(spark):
    star = shop(
        spark,
        orders=[{"order_id": 1, "customer_id": 1, "order_date": date(2025, 1, 1)},
                {"order_id": 2, "customer_id": 1, "order_date": date(2025, 3, 1)},
                {"order_id": 3, "customer_id": 2, "order_date": date(2025, 3, 9)},
                {"order_id": 4, "customer_id": 3, "order_date": date(2024, 1, 1)}],  # without lines
        order_items=[item(n, n) for n in (1, 2, 3)],
    )
    assert [tuple(r) for r in customers.cohort_retention(star).collect()] == [
        ("2025-01", "2025-01", 1), ("2025-01", "2025-03", 1), ("2025-03", "2025-03", 1)]


def test_cross_sell_by_name_and_by_id(spark):
    star = shop(
        spark,
        products=[{"product_id": 1, "product_name": "a"}, {"product_id": 2, "product_name": "b"}, {"product_id": 3, "product_name": "b"}],
        orders=[order(n) for n in (1, 2)],
        order_items=[item(1, 1, 1), item(2, 1, 2), item(3, 2, 1), item(4, 2, 3), item(5, 2, 2)],
    )
    assert [tuple(r) for r in products.cross_sell(star, min_support=2).collect()] == [("a", "b", 2)]
    assert [tuple(r) for r in products.cross_sell(star, min_support=2, by="product_id").collect()] == [(1, 2, 2)]


def test_coupon_usage_and_view_to_purchase(spark):
    star = shop(
        spark,
        products=[{"product_id": 1, "product_name": "a"}, {"product_id": 2, "product_name": "b"}],
        coupons=[{"coupon_id": 4, "coupon_code": "C", "discount_value": "5"}],
        orders=[order(1, coupon_code="C"), order(2, coupon_code="unknown"), order(3)],
        order_items=[item(n, n) for n in (1, 2, 3)],
        page_views=[view(1, page="product", product_id=2), view(2, page="category", product_id=1)],
    )
    assert [r["order_id"] for r in sales.coupon_usage(star).collect()] == [1]
    assert [r["coupon_key"] for r in star.dim_coupon.collect()] == [1]
    got = {r["product_name"]: (r["was_viewed"], r["was_purchased"]) for r in products.view_to_purchase(star).collect()}
    assert got == {"a": (False, True), "b": (True, False)}


def test_closing_a_star_deletes_its_scratch_tables(spark):
    before = scratch_paths(spark)
    with shop(spark, **DANGLING) as star:
        assert products.abc_analysis(star).count() == 2
        written = [p for p in scratch_paths(spark) if p not in before]
        assert written and all(Path(p.removeprefix("file:")).exists() for p in written)
    assert scratch_paths(spark) == before
    assert not any(Path(p.removeprefix("file:")).exists() for p in written)
