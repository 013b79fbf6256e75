"""Named subqueries: wholesale tables -> operational tables -> star schema, in DuckDB's dialect."""

from __future__ import annotations

import re

from oracle.fixed import HOLIDAYS, REGIONS

AS_OF = "DATE '2001-08-02'"
RECENCY, FREQUENCY, MONETARY = (30, 90, 180, 365), (20, 10, 5, 2), (2_400_000, 1_900_000, 1_500_000, 1_000_000)


def _list(values) -> str:
    return ", ".join(f"'{value}'" for value in values)


def _pick(index: str, values) -> str:
    return f"([{_list(values)}])[{index} + 1]"


def _id(text: str) -> str:
    return f"('0x' || substr(md5({text}), 1, 15))::BIGINT"


def _score(value: str, sign: str, cuts) -> str:
    steps = " ".join(f"WHEN {value} {sign} {cut} THEN {5 - place}" for place, cut in enumerate(cuts))
    return f"(CASE {steps} ELSE 1 END)::BIGINT"


PREFECTURES = [name for names in REGIONS.values() for name in names]
REGION_ROWS = ", ".join(f"('{name}', '{region}')" for region, names in REGIONS.items() for name in names)

DIRTY_STATUS = """CASE o_orderstatus WHEN 'O' THEN 'shipped' WHEN 'F' THEN 'delivered'
    ELSE CASE o_orderpriority WHEN '5-LOW' THEN 'cancelled' WHEN '4-NOT SPECIFIED' THEN 'confirmed' ELSE 'pending' END END"""

LOADS = "(VALUES (0, DATE '1900-01-01'), (1, DATE '1997-06-30'), (2, DATE '1999-06-30')) AS loads (load, day)"


def _versions(loads: str, key: str, tracked: str) -> str:
    """Loads in which a member is new, has changed or has gone, with the days until the next of them."""
    return f"""
        SELECT version_key, {key}, {tracked}, present, day AS valid_from,
               coalesce(lead(day) OVER (PARTITION BY {key} ORDER BY load), DATE '9999-12-31') AS valid_to
        FROM (SELECT *, row_number() OVER (ORDER BY load, {key}) AS version_key
              FROM (SELECT *, CASE WHEN present THEN ({tracked})::VARCHAR END AS state,
                           lag(CASE WHEN present THEN ({tracked})::VARCHAR END) OVER (PARTITION BY {key} ORDER BY load) AS before
                    FROM {loads})
              WHERE state IS DISTINCT FROM before)"""


LAYERS: dict[str, str] = {
    # operational tables ---------------------------------------------------------------------
    "raw_customers": f"""
        SELECT c_custkey AS customer_id, c_name AS first_name, c_mktsegment AS last_name,
               'u' || c_custkey || '@example.com' AS email,
               CASE WHEN c_custkey % 5 <> 0 THEN '090-' || c_custkey END AS phone,
               'city-' || c_nationkey AS city,
               {_pick('c_custkey % 48', PREFECTURES)} AS prefecture,
               (1000000 + c_nationkey * 1000 + c_custkey % 1000)::VARCHAR AS postal_code,
               (DATE '1995-01-01' + (c_custkey % 2000)::INT)::TIMESTAMP AS created_at,
               CASE WHEN c_custkey % 50 < 24 THEN '男性' WHEN c_custkey % 50 < 49 THEN '女性' ELSE 'その他' END AS gender,
               CASE WHEN c_custkey % 97 <> 0 THEN DATE '1940-01-01' + (c_custkey * 7919 % 22000)::INT END AS birth_date,
               {_pick('c_custkey % 5', ['organic', 'ad_search', 'ad_social', 'referral', 'affiliate'])} AS registration_channel
        FROM customer""",
    "raw_categories": f"""
        SELECT DISTINCT {_id('p_type')} AS category_id, p_type AS name, NULL::BIGINT AS parent_id FROM part
        UNION ALL
        SELECT DISTINCT {_id("p_type || '/' || p_brand")}, p_brand, {_id('p_type')} FROM part""",
    "raw_products": f"""
        SELECT p_partkey AS product_id, p_name AS product_name, {_id("p_type || '/' || p_brand")} AS category_id,
               p_retailprice::DECIMAL(12,2) AS unit_price, p_type || ' ' || p_brand AS description,
               (DATE '1994-01-01' + (p_partkey % 365)::INT)::TIMESTAMP AS created_at,
               CASE WHEN p_partkey % 50 <> 0 THEN (p_retailprice::DECIMAL(12,2) * 0.6)::DECIMAL(12,2) END AS cost_price,
               (p_size * 100)::BIGINT AS weight_gram, p_size <= 40 AS is_active
        FROM part""",
    "raw_orders": f"""
        SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate::DATE AS order_date,
               'address of ' || o_custkey AS shipping_address,
               CASE WHEN o_orderkey % 3 = 0 THEN '  ' || upper({DIRTY_STATUS}) || ' ' ELSE {DIRTY_STATUS} END AS status,
               o_orderdate::TIMESTAMP AS created_at, NULL::TIMESTAMP AS updated_at,
               o_orderdate::TIMESTAMP + to_hours(o_orderkey % 24) AS order_timestamp,
               {_pick("substr(o_orderpriority, 1, 1)::INT - 1",
                      ['credit_card', 'bank_transfer', 'convenience_store', 'carrier', 'cod'])} AS payment_method,
               {_pick("o_orderkey % 10", ['mobile'] * 6 + ['desktop'] * 3 + ['tablet'])} AS device_type,
               CASE WHEN o_orderkey % 7 = 0 THEN 'C' || (o_custkey // 15) END AS coupon_code
        FROM orders""",
    "raw_order_items": """
        SELECT (l_orderkey * 1024 + l_linenumber) * 4096
                   + row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity,
                       l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS order_item_id,
               l_orderkey AS order_id, l_partkey AS product_id, l_quantity::BIGINT AS quantity,
               ((floor(l_extendedprice * 100 + 0.5)::BIGINT // l_quantity::BIGINT)::DECIMAL(12,0) * 0.01)::DECIMAL(12,2) AS unit_price,
               floor(l_discount * 100 + 0.5)::DECIMAL(5,2) AS discount
        FROM lineitem""",
    "raw_page_views": f"""
        SELECT event_id AS page_view_id, CASE WHEN event_id % 10 <> 0 THEN user_id END AS customer_id,
               user_id || '-' || ts::DATE AS session_id,
               CASE event_type WHEN 'signup' THEN 'top' WHEN 'view' THEN 'product' WHEN 'error' THEN 'checkout'
                    WHEN 'purchase' THEN 'complete' ELSE CASE event_id % 3 WHEN 0 THEN 'cart' ELSE 'category' END
               END AS page_type,
               CASE WHEN event_type = 'view' THEN user_id * 10 + event_id % 10 END AS product_id,
               NULL::BIGINT AS category_id,
               {_pick('event_id % 7', ['direct', 'search_organic', 'search_paid', 'social', 'email', 'referral'])} AS referrer_type,
               ts AS view_timestamp,
               CASE WHEN event_id % 13 <> 0 THEN floor(value)::BIGINT END AS duration_seconds
        FROM events""",
    "stock_days": """
        SELECT l_partkey AS p, l_shipdate::DATE AS day, dayofyear(l_shipdate::DATE)::BIGINT AS n
        FROM lineitem GROUP BY ALL""",
    "raw_inventory_snapshots": """
        SELECT p * 100000 + date_diff('day', DATE '1970-01-01', day) AS snapshot_id, p AS product_id, day AS snapshot_date,
               (p * 37 + n * 13) % 200 AS quantity_on_hand,
               least((p * 37 + n * 13) % 200, (p + n) % 40) AS quantity_reserved,
               20 + p % 30 AS reorder_point, 3 + p % 12 AS lead_time_days
        FROM stock_days""",
    "raw_coupons": """
        SELECT s_suppkey AS coupon_id, 'C' || s_suppkey AS coupon_code,
               CASE s_suppkey % 2 WHEN 0 THEN 'percentage' ELSE 'fixed_amount' END AS coupon_type,
               (CASE s_suppkey % 2 WHEN 0 THEN 5 + 5 * (s_suppkey % 4) ELSE 100 + 100 * (s_suppkey % 10) END)::DECIMAL(12,2)
                   AS discount_value,
               CASE WHEN s_suppkey % 5 <> 0 THEN 1000.00::DECIMAL(12,2) END AS min_order_amount,
               DATE '1995-01-01' + (s_suppkey % 1000)::INT AS valid_from,
               DATE '1999-01-01' + (s_suppkey % 1000)::INT AS valid_to,
               'campaign of ' || s_name AS campaign_name
        FROM supplier""",
    # staged tables that differ from the operational ones -------------------------------------
    "stg_categories": "SELECT category_id, name AS category_name, parent_id FROM raw_categories",
    "stg_orders": "SELECT * REPLACE (lower(trim(status)) AS status) FROM raw_orders",
    "stg_order_items": "SELECT * RENAME (discount AS discount_rate) FROM raw_order_items",
    # business logic --------------------------------------------------------------------------
    "region_map": f"SELECT * FROM (VALUES {REGION_ROWS}) AS m(prefecture, region)",
    "int_customers_with_region": f"""
        SELECT customer_id, last_name || ' ' || first_name AS full_name, email, phone, city, prefecture,
               coalesce(region, '不明') AS region, gender,
               CASE WHEN birth_date IS NULL THEN '不明' ELSE
                   CASE least(greatest((year({AS_OF}) - year(birth_date)) // 10, 2), 6)
                        WHEN 2 THEN '20代' WHEN 3 THEN '30代' WHEN 4 THEN '40代' WHEN 5 THEN '50代' ELSE '60代以上' END
               END AS age_group,
               registration_channel, created_at
        FROM raw_customers LEFT JOIN region_map USING (prefecture)""",
    "int_products_with_categories": """
        SELECT product_id, product_name, leaf.category_name, root.category_name AS parent_category_name,
               unit_price, cost_price,
               round((unit_price - cost_price)::DOUBLE / nullif(unit_price, 0)::DOUBLE * 100, 2) AS gross_margin_pct,
               is_active
        FROM raw_products AS item
        LEFT JOIN stg_categories AS leaf ON leaf.category_id = item.category_id
        LEFT JOIN stg_categories AS root ON root.category_id = leaf.parent_id""",
    "int_orders_with_items": """
        SELECT order_id, customer_id, order_date, status, order_item_id, product_id, quantity, unit_price, discount_rate,
               (unit_price * quantity::DECIMAL(10,0)) AS gross_amount,
               (unit_price * quantity::DECIMAL(10,0) * discount_rate * 0.01) AS discount_amount,
               (unit_price * quantity::DECIMAL(10,0) * (100 - discount_rate)::DECIMAL(5,2) * 0.01) AS net_amount,
               order_timestamp, payment_method, device_type, coupon_code
        FROM stg_order_items JOIN stg_orders USING (order_id)""",
    "bought": "SELECT * FROM int_orders_with_items WHERE status <> 'cancelled'",
    "customer_history": """
        SELECT customer_id, min(order_date) AS first_order_date, max(order_date) AS last_order_date,
               count(DISTINCT order_id) AS total_orders, sum(net_amount) AS total_spent
        FROM bought GROUP BY customer_id""",
    "rfm_scored": f"""
        SELECT customer_id, date_diff('day', last_order_date, {AS_OF}) AS recency_days,
               total_orders AS frequency, total_spent AS monetary,
               {_score(f"date_diff('day', last_order_date, {AS_OF})", '<=', RECENCY)} AS r,
               {_score('total_orders', '>=', FREQUENCY)} AS f,
               {_score('total_spent', '>=', MONETARY)} AS m
        FROM customer_history""",
    "int_customer_rfm": """
        SELECT customer_id, recency_days, frequency, monetary,
               r AS rfm_recency_score, f AS rfm_frequency_score, m AS rfm_monetary_score,
               CASE WHEN least(r, f, m) >= 4 THEN 'チャンピオン' WHEN least(r, f, m) >= 3 THEN 'ロイヤル'
                    WHEN r >= 4 AND f <= 2 THEN '有望' WHEN r <= 2 AND least(f, m) >= 3 THEN 'リスクあり'
                    WHEN greatest(r, f) <= 2 THEN '休眠' ELSE 'その他' END AS rfm_segment
        FROM rfm_scored""",
    "ltv_parts": """
        SELECT *, total_spent::DOUBLE / total_orders::DOUBLE AS avg_order_amount,
               CASE WHEN total_orders = 1 THEN 1.0::DOUBLE ELSE
                   total_orders::DOUBLE / nullif(date_diff('day', first_order_date, last_order_date)::DOUBLE / 365.0::DOUBLE, 0)
               END AS annual_frequency
        FROM customer_history""",
    "int_customer_ltv": "SELECT *, avg_order_amount * annual_frequency * 3.0::DOUBLE AS ltv_estimated FROM ltv_parts",
    "revenue_order": """
        SELECT product_id, total_revenue, row_number() OVER best AS revenue_rank,
               sum(total_revenue) OVER (best ROWS UNBOUNDED PRECEDING) AS cumulative_revenue,
               sum(total_revenue) OVER () AS everything
        FROM (SELECT product_id, sum(net_amount) AS total_revenue FROM bought GROUP BY product_id)
        WINDOW best AS (ORDER BY total_revenue DESC, product_id)""",
    "int_product_abc": """
        SELECT product_id, total_revenue, revenue_rank, cumulative_revenue,
               cumulative_revenue::DOUBLE / nullif(everything::DOUBLE, 0) AS cumulative_pct,
               CASE WHEN cumulative_revenue * 100 <= everything * 60 THEN 'A'
                    WHEN cumulative_revenue * 100 <= everything * 85 THEN 'B' ELSE 'C' END AS abc_rank
        FROM revenue_order""",
    "int_page_view_sessions": """
        SELECT session_id, max(customer_id) AS customer_id, min(referrer_type) AS referrer_type,
               min(view_timestamp) AS session_start, max(view_timestamp) AS session_end,
               count(*) AS page_view_count, sum(duration_seconds)::BIGINT AS total_duration_seconds,
               count(*) FILTER (page_type = 'cart') > 0 AS has_cart,
               count(*) FILTER (page_type = 'complete') > 0 AS has_purchase
        FROM raw_page_views GROUP BY session_id""",
    "daily_average": """
        SELECT product_id, avg(sold::DOUBLE) AS daily_avg_sales
        FROM (SELECT product_id, order_date, sum(quantity) AS sold FROM bought GROUP BY ALL) GROUP BY product_id""",
    "int_inventory_with_sales": """
        SELECT snapshot_id, product_id, snapshot_date, quantity_on_hand, quantity_reserved,
               quantity_on_hand - quantity_reserved AS quantity_available, reorder_point, lead_time_days,
               coalesce(daily_avg_sales, 0) AS daily_avg_sales,
               (quantity_on_hand - quantity_reserved)::DOUBLE / nullif(daily_avg_sales, 0) AS days_of_supply
        FROM raw_inventory_snapshots LEFT JOIN daily_average USING (product_id)""",
    # dimensions and facts ----------------------------------------------------------------------
    "all_days": """
        SELECT min(d) AS lo, max(d) AS hi FROM (
            SELECT order_date AS d FROM raw_orders UNION ALL SELECT view_timestamp::DATE FROM raw_page_views
            UNION ALL SELECT snapshot_date FROM raw_inventory_snapshots)""",
    "dim_date": f"""
        SELECT strftime(d, '%Y%m%d')::BIGINT AS date_key, d AS full_date, year(d) AS year, quarter(d) AS quarter,
               month(d) AS month, monthname(d) AS month_name, isodow(d) - 1 AS day_of_week, dayname(d) AS day_name,
               isodow(d) > 5 AS is_weekend, week(d) AS week_of_year, strftime(d, '%Y-%m') AS year_month,
               year(d) || '-Q' || quarter(d) AS year_quarter,
               d::VARCHAR IN ({_list(HOLIDAYS)}) AS is_holiday,
               year(d) - (month(d) < 4)::INT AS fiscal_year, (quarter(d) + 2) % 4 + 1 AS fiscal_quarter
        FROM (SELECT unnest(generate_series(lo, hi, INTERVAL 1 DAY))::DATE AS d FROM all_days)""",
    "dim_time": """
        SELECT h AS time_key, h AS hour_of_day,
               CASE WHEN h < 5 THEN '深夜' WHEN h < 7 THEN '早朝' WHEN h < 10 THEN '朝' WHEN h < 12 THEN '昼前'
                    WHEN h < 15 THEN '昼' WHEN h < 18 THEN '午後' WHEN h < 21 THEN '夕方' ELSE '夜' END AS time_period,
               h >= 9 AND h < 18 AS is_business_hours
        FROM range(24) AS hours(h)""",
    "dim_customer": f"""
        SELECT customer_id AS customer_key, customer_id, full_name, email, phone, city, prefecture, region, gender,
               age_group, registration_channel,
               date_diff('day', created_at::DATE, {AS_OF}) AS customer_tenure_days,
               rfm_recency_score, rfm_frequency_score, rfm_monetary_score,
               coalesce(rfm_segment, '未購入') AS rfm_segment, first_order_date,
               coalesce(total_orders, 0) AS total_orders, coalesce(total_spent, 0) AS total_spent, ltv_estimated
        FROM int_customers_with_region
        LEFT JOIN int_customer_rfm USING (customer_id) LEFT JOIN int_customer_ltv USING (customer_id)""",
    "dim_product": """
        SELECT product_id AS product_key, product_id, product_name, category_name, parent_category_name, unit_price,
               cost_price, gross_margin_pct, is_active, coalesce(abc_rank, 'C') AS abc_rank
        FROM int_products_with_categories LEFT JOIN int_product_abc USING (product_id)""",
    "dim_order_status": """
        SELECT dense_rank() OVER (ORDER BY status) AS order_status_key, status AS status_code,
               coalesce(map {'pending': '保留中', 'confirmed': '確認済', 'shipped': '発送済', 'delivered': '配達完了',
                             'cancelled': 'キャンセル'}[status], '不明') AS status_label
        FROM (SELECT DISTINCT status FROM stg_orders)""",
    "dim_coupon": """
        SELECT row_number() OVER (ORDER BY coupon_id) AS coupon_key, coupon_code, coupon_type, discount_value, campaign_name
        FROM raw_coupons""",
    "fact_sales": """
        SELECT customer_key, product_key, date_key, order_status_key, order_id, order_item_id, quantity,
               line.unit_price, discount_rate, gross_amount, discount_amount, net_amount, time_key, payment_method,
               device_type, coupon_code, quantity::DECIMAL(10,0) * cost_price AS cost_amount,
               net_amount - quantity::DECIMAL(10,0) * cost_price AS gross_profit
        FROM int_orders_with_items AS line
        JOIN dim_customer USING (customer_id)
        JOIN dim_product USING (product_id)
        JOIN dim_date ON full_date = order_date
        JOIN dim_order_status ON status_code = status
        LEFT JOIN dim_time ON time_key = hour(order_timestamp)""",
    "fact_page_views": """
        SELECT page_view_id, customer_key, product_key, date_key, time_key, session_id, page_type, referrer_type,
               duration_seconds
        FROM raw_page_views AS view
        LEFT JOIN dim_customer ON dim_customer.customer_id = view.customer_id
        LEFT JOIN dim_product ON dim_product.product_id = view.product_id
        JOIN dim_date ON full_date = view_timestamp::DATE
        JOIN dim_time ON time_key = hour(view_timestamp)""",
    "fact_inventory_daily": """
        SELECT product_key, date_key, quantity_on_hand, quantity_reserved, quantity_available, reorder_point,
               quantity_available < reorder_point AS is_below_reorder_point,
               quantity_available <= 0 AS is_out_of_stock, days_of_supply
        FROM int_inventory_with_sales JOIN dim_product USING (product_id) JOIN dim_date ON full_date = snapshot_date""",
    # history --------------------------------------------------------------------------------
    "customer_loads": f"""
        SELECT load, day, c_custkey AS customer_id,
               'city-' || ((c_nationkey + CASE WHEN (c_custkey + load) % 5 = 0 THEN load ELSE 0 END) % 25) AS city,
               {_pick('c_custkey % 48', PREFECTURES)} AS prefecture,
               {_pick('c_custkey % 5', ['organic', 'ad_search', 'ad_social', 'referral', 'affiliate'])} AS registration_channel,
               NOT (c_custkey % 11 = 5 AND load = 0) AND NOT (c_custkey % 13 = 6 AND load = 2) AS present
        FROM customer, {LOADS}""",
    "customer_versions": _versions("customer_loads", "customer_id", "city, prefecture, registration_channel"),
    "product_loads": f"""
        SELECT load, day, p_partkey AS product_id,
               (p_retailprice::DECIMAL(12,2) + CASE WHEN (p_partkey + load) % 4 = 0 THEN 10 * load ELSE 0 END)::DECIMAL(12,2) AS unit_price,
               p_size <= 40 AS is_active, true AS present
        FROM part, {LOADS}""",
    "product_versions": _versions("product_loads", "product_id", "unit_price, is_active"),
    # wide rows for the reports -----------------------------------------------------------------
    "sale": """
        SELECT f.* EXCLUDE (unit_price), d.* EXCLUDE (date_key), t.time_period, t.hour_of_day, s.status_code,
               s.status_label
        FROM fact_sales AS f JOIN dim_date AS d USING (date_key) JOIN dim_order_status AS s USING (order_status_key)
        LEFT JOIN dim_time AS t USING (time_key)""",
    "product_sale": "SELECT * FROM fact_sales JOIN dim_product USING (product_key)",
    "customer_sale": "SELECT * FROM fact_sales JOIN dim_customer USING (customer_key)",
    "stock": """
        SELECT i.*, d.full_date, p.product_name, p.category_name, p.parent_category_name
        FROM fact_inventory_daily AS i JOIN dim_date AS d USING (date_key) JOIN dim_product AS p USING (product_key)""",
}
for _table in ("customers", "products", "page_views", "inventory_snapshots", "coupons"):
    LAYERS[f"stg_{_table}"] = f"SELECT * FROM raw_{_table}"


def statement(body: str) -> str:
    """``body`` with exactly the layers it needs in front."""
    needed: set[str] = set()
    waiting = [body]
    while waiting:
        for word in set(re.findall(r"\w+", waiting.pop())):
            if word in LAYERS and word not in needed:
                needed.add(word)
                waiting.append(LAYERS[word])
    ordered = _by_dependency(needed)
    if not ordered:
        return body.strip()
    return "WITH " + ",\n".join(f"{name} AS ({LAYERS[name].strip()})" for name in ordered) + "\n" + body.strip()


def _by_dependency(names: set[str]) -> list[str]:
    done: list[str] = []

    def visit(name: str) -> None:
        if name in done:
            return
        for word in re.findall(r"\w+", LAYERS[name]):
            if word in LAYERS and word != name:
                visit(word)
        done.append(name)

    for name in sorted(names):
        visit(name)
    return [name for name in done if name in names]
