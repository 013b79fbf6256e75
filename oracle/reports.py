"""One DuckDB statement per registered query."""

from __future__ import annotations

from oracle.fixed import COLUMNS, FOREIGN_KEYS, KEYS, NOT_NULL, REFERENCES, REGIONS, REQUIRED, UNIQUE_KEYS
from oracle.layers import LAYERS, statement

MODELS = [name for name in LAYERS if name.startswith(("stg_", "int_", "dim_", "fact_")) and name != "dim_time"]
MONEY = {
    "stg_products": ("unit_price", "cost_price"),
    "stg_order_items": ("unit_price", "discount_rate"),
    "stg_coupons": ("discount_value", "min_order_amount"),
    "int_products_with_categories": ("unit_price", "cost_price"),
    "int_orders_with_items": ("unit_price", "discount_rate", "gross_amount", "discount_amount", "net_amount"),
    "int_customer_rfm": ("monetary",),
    "int_customer_ltv": ("total_spent",),
    "int_product_abc": ("total_revenue", "cumulative_revenue"),
    "dim_customer": ("total_spent",),
    "dim_product": ("unit_price", "cost_price"),
    "dim_coupon": ("discount_value",),
    "fact_sales": ("unit_price", "discount_rate", "gross_amount", "discount_amount", "net_amount", "cost_amount",
                   "gross_profit"),
}


def _as_double(columns) -> str:
    return f"REPLACE ({', '.join(f'{c}::DOUBLE AS {c}' for c in columns)})" if columns else ""


def _model(name: str) -> str:
    return f"SELECT * {_as_double(MONEY.get(name, ()))} FROM {name}"


def _count(table: str, **literals: str) -> str:
    labels = "".join(f"'{value}' AS {name}, " for name, value in literals.items())
    return f"SELECT {labels}count(*) AS row_count FROM {table}"


SUM_NET = "sum(net_amount)"
NET, PROFIT = f"{SUM_NET}::DOUBLE", "sum(gross_profit)::DOUBLE"
PER_LINE = ("sum(net_amount)", "count(net_amount)")
ORDERS = "count(DISTINCT order_id)"
OUT_DAYS = "count(*) FILTER (is_out_of_stock)"


def rounded(numerator: str, denominator: str, digits: int, times: int = 1) -> str:
    """``times * numerator / denominator`` rounded half up once, by whole numbers; NULL for a zero denominator."""
    top, bottom = (f"(({part})::DECIMAL(25,6) * 1000000)::HUGEINT" for part in (numerator, denominator))
    whole = f"(abs({top}) * {2 * times * 10**digits} + abs({bottom})) // nullif(2 * abs({bottom}), 0)"
    return f"(sign({top}) * sign({bottom}) * ({whole})::DOUBLE / {10**digits})"


MONTHLY = f"SELECT year, month, month_name, {ORDERS} AS order_count, "

REPORTS: dict[str, str] = {
    "monthly_sales": MONTHLY + f"""count(*) AS line_item_count, {NET} AS total_net_amount,
        sum(quantity)::BIGINT AS total_quantity FROM sale GROUP BY ALL""",
    "monthly_sales_profit": MONTHLY + f"{NET} AS total_sales, {PROFIT} AS total_profit FROM sale GROUP BY ALL",
    "seasonal_trend": f"SELECT month, year, {NET} AS monthly_revenue, {ORDERS} AS order_count FROM sale GROUP BY ALL",
    "monthly_sales_yoy": f"""
        SELECT now.year_month, now.revenue::DOUBLE AS monthly_revenue, now.orders AS order_count,
               ago.revenue::DOUBLE AS prev_year_revenue,
               {rounded('(now.revenue - ago.revenue)', 'ago.revenue', 1, 100)} AS yoy_growth_pct
        FROM months AS now LEFT JOIN months AS ago ON ago.month = now.month AND ago.fiscal_year = now.fiscal_year - 1""",
    "moving_average_7d": f"""
        SELECT full_date, revenue::DOUBLE AS daily_revenue,
               (sum(revenue) OVER w)::DOUBLE / (count(*) OVER w) AS moving_avg_7d
        FROM (SELECT full_date, sum(net_amount) AS revenue FROM sale GROUP BY full_date)
        WINDOW w AS (ORDER BY full_date ROWS 6 PRECEDING)""",
    "hourly_sales": f"""
        SELECT time_period, hour_of_day, {ORDERS} AS order_count, {NET} AS total_revenue
        FROM sale WHERE hour_of_day IS NOT NULL GROUP BY ALL""",
    "hourly_order_pattern": f"""
        SELECT hour_of_day, time_period, {ORDERS} AS order_count, {NET} AS total_sales
        FROM sale WHERE hour_of_day IS NOT NULL GROUP BY ALL""",
    "weekday_pattern": f"""
        SELECT day_of_week, day_name, {ORDERS} AS order_count, {NET} AS total_net_amount,
               {rounded(*PER_LINE, 2)} AS avg_net_amount FROM sale GROUP BY ALL""",
    "order_status_analysis": f"""
        SELECT status_label, status_code, count(*) AS item_count, {NET} AS total_net_amount,
               {rounded(*PER_LINE, 2)} AS avg_net_amount FROM sale GROUP BY ALL""",
    "order_status_distribution": f"""
        SELECT status_code, {ORDERS} AS order_count,
               {rounded(ORDERS, f'(SELECT {ORDERS} FROM sale)', 1, 100)} AS pct FROM sale GROUP BY ALL""",
    "payment_distribution": f"""
        SELECT '決済方法分布' AS analysis_type, payment_method, {ORDERS} AS order_count,
               {rounded(ORDERS, f'(SELECT {ORDERS} FROM sale)', 1, 100)} AS pct FROM sale GROUP BY ALL""",
    "device_distribution": f"""
        SELECT 'デバイス分布' AS analysis_type, device_type, {ORDERS} AS order_count,
               {rounded(ORDERS, f'(SELECT {ORDERS} FROM sale)', 1, 100)} AS pct FROM sale GROUP BY ALL""",
    "payment_mix": f"SELECT payment_method, {ORDERS} AS orders, {NET} AS sales FROM sale GROUP BY ALL",
    "order_line_rollup": f"""
        SELECT order_id, count(*) AS line_items, sum(quantity)::BIGINT AS total_qty, {NET} AS order_total
        FROM fact_sales GROUP BY order_id ORDER BY line_items DESC, order_id LIMIT 10""",
    "coupon_usage": """
        SELECT order_id, coupon_code, coupon_type, discount_value::DOUBLE AS discount_value,
               discount_rate::DOUBLE AS discount_rate, net_amount::DOUBLE AS net_amount
        FROM fact_sales JOIN dim_coupon USING (coupon_code)""",
    # customers
    "rfm_segment_sales": f"""
        SELECT rfm_segment, count(DISTINCT customer_key) AS customer_count, {NET} AS total_revenue,
               {rounded(*PER_LINE, 0)} AS avg_order_amount FROM customer_sale GROUP BY ALL""",
    "cohort_retention": """
        SELECT cohort_month, year_month AS activity_month, count(DISTINCT customer_key) AS active_customers
        FROM sale JOIN (SELECT customer_key, min(year_month) AS cohort_month FROM sale GROUP BY ALL) USING (customer_key)
        GROUP BY ALL""",
    "ltv_distribution": f"""
        SELECT rfm_segment, age_group, count(*) AS customer_count, round(avg(ltv_estimated), 0) AS avg_ltv,
               {rounded('sum(total_spent)', 'count(*)', 0)} AS avg_total_spent,
               {rounded('sum(total_orders)', 'count(*)', 1)} AS avg_orders
        FROM dim_customer WHERE total_orders > 0 GROUP BY ALL""",
    "rfm_segment_distribution": f"""
        SELECT rfm_segment, count(*) AS customer_count, {rounded('sum(total_spent)', 'count(*)', 0)} AS avg_spent,
               round(avg(ltv_estimated), 0) AS avg_ltv FROM dim_customer WHERE total_orders > 0 GROUP BY ALL""",
    "top_ltv_customers": """
        SELECT full_name, prefecture, region, rfm_segment, total_orders, total_spent::DOUBLE AS total_spent,
               round(ltv_estimated, 0) AS ltv_estimated
        FROM (FROM dim_customer WHERE ltv_estimated IS NOT NULL ORDER BY ltv_estimated DESC, customer_id LIMIT 20)""",
    "region_customer_analysis": f"""
        SELECT region, count(DISTINCT customer_key) AS customer_count, {ORDERS} AS order_count,
               {rounded(*PER_LINE, 2)} AS avg_order_amount,
               {rounded(ORDERS, 'count(DISTINCT customer_key)', 2)} AS orders_per_customer
        FROM customer_sale GROUP BY ALL""",
    "region_sales": f"""
        SELECT region, count(DISTINCT customer_key) AS customers, {ORDERS} AS orders, {NET} AS total_sales
        FROM customer_sale GROUP BY ALL""",
    "segment_distribution": f"""
        SELECT 'RFMセグメント分布' AS analysis_type, rfm_segment, count(*) AS customer_count,
               {rounded('count(*)', '(SELECT count(*) FROM dim_customer)', 1, 100)} AS pct
        FROM dim_customer GROUP BY ALL""",
    "gender_distribution": f"""
        SELECT '性別分布' AS analysis_type, gender, count(*) AS customer_count,
               {rounded('count(*)', '(SELECT count(*) FROM dim_customer)', 1, 100)} AS pct
        FROM dim_customer GROUP BY ALL""",
    "age_distribution": f"""
        SELECT '年代分布' AS analysis_type, age_group, count(*) AS customer_count,
               {rounded('count(*)', '(SELECT count(*) FROM dim_customer)', 1, 100)} AS pct
        FROM dim_customer GROUP BY ALL""",
    # products
    "category_ranking": f"""
        SELECT parent_category_name, {NET} AS total_net_amount, sum(quantity)::BIGINT AS total_quantity,
               count(DISTINCT product_id) AS product_count FROM product_sale GROUP BY ALL""",
    "category_sales": f"""
        SELECT parent_category_name, category_name, {ORDERS} AS order_count, {NET} AS total_sales,
               {PROFIT} AS total_profit,
               {rounded('sum(discount_rate)', 'count(discount_rate)', 1)} AS avg_discount_rate
        FROM product_sale GROUP BY ALL""",
    "category_line_counts": f"""
        SELECT parent_category_name, category_name, count(*) AS sales_count, {NET} AS total_sales
        FROM product_sale GROUP BY ALL""",
    "abc_analysis": f"""
        SELECT abc_rank, count(DISTINCT product_key) AS product_count, {NET} AS total_revenue, {PROFIT} AS total_profit,
               {rounded(SUM_NET, f'(SELECT {SUM_NET} FROM fact_sales)', 1, 100)} AS revenue_share_pct
        FROM product_sale GROUP BY ALL""",
    "abc_product_summary": f"""
        SELECT abc_rank, count(*) AS product_count, sum(sold)::DOUBLE AS total_revenue,
               {rounded('sum(gross_margin_pct::DECIMAL(12,2))', 'count(gross_margin_pct)', 1)} AS avg_margin_pct
        FROM dim_product JOIN (SELECT product_key, sum(net_amount) AS sold FROM fact_sales GROUP BY ALL) USING (product_key)
        GROUP BY ALL""",
    "abc_sales_lines": f"SELECT abc_rank, count(*) AS products, {NET} AS revenue FROM product_sale GROUP BY ALL",
    "top_products": f"""
        SELECT product_name, category_name, abc_rank, sum(quantity)::BIGINT AS total_qty, {NET} AS total_sales,
               {PROFIT} AS total_profit
        FROM product_sale GROUP BY ALL
        ORDER BY sum(net_amount) DESC, product_name, category_name, abc_rank LIMIT 20""",
    "cross_sell": """
        SELECT x.product_name AS product_a, y.product_name AS product_b, count(*) AS co_purchase_count
        FROM basket AS x JOIN basket AS y ON x.order_id = y.order_id AND x.product_name < y.product_name
        GROUP BY ALL HAVING count(*) >= 10 ORDER BY co_purchase_count DESC, product_a, product_b LIMIT 20""",
    "view_to_purchase": """
        SELECT product_name,
               product_key IN (SELECT product_key FROM fact_page_views
                               WHERE page_type = 'product' AND product_key IS NOT NULL) AS was_viewed,
               product_key IN (SELECT product_key FROM fact_sales) AS was_purchased
        FROM dim_product""",
    # traffic
    "conversion_funnel": f"""
        SELECT page_type, sessions,
               {rounded('sessions', "max(sessions) FILTER (page_type = 'top') OVER ()", 1, 100)} AS pct_of_top
        FROM (SELECT page_type, count(DISTINCT session_id) AS sessions FROM fact_page_views
              WHERE page_type IN ('top', 'category', 'product', 'cart', 'checkout', 'complete') GROUP BY ALL)""",
    "page_type_traffic": f"""
        SELECT page_type, count(*) AS page_views, count(DISTINCT session_id) AS sessions,
               {rounded('sum(duration_seconds)', 'count(duration_seconds)', 1)} AS avg_duration_sec
        FROM fact_page_views GROUP BY ALL""",
    "funnel_page_views": "SELECT page_type, count(*) AS views FROM fact_page_views GROUP BY ALL",
    "session_conversion": f"""
        SELECT referrer_type, count(*) AS sessions, count(*) FILTER (has_cart) AS cart_sessions,
               count(*) FILTER (has_purchase) AS purchase_sessions,
               {rounded('count(*) FILTER (has_purchase)', 'count(*)', 1, 100)} AS cvr_pct
        FROM int_page_view_sessions GROUP BY ALL""",
    "sales_vs_views_monthly": """
        SELECT year, month, month_name, sum(coalesce(lines, 0))::BIGINT AS sales_count,
               sum(coalesce(views, 0))::BIGINT AS page_view_count
        FROM dim_date
        LEFT JOIN (SELECT date_key, count(*) AS lines FROM fact_sales GROUP BY ALL) USING (date_key)
        LEFT JOIN (SELECT date_key, count(*) AS views FROM fact_page_views GROUP BY ALL) USING (date_key)
        GROUP BY ALL""",
    # inventory
    "inventory_turnover": f"""
        SELECT product_name, parent_category_name, {rounded('sum(quantity_on_hand)', 'count(*)', 0)} AS avg_inventory,
               sum(sold)::BIGINT AS total_sold,
               {rounded('sum(sold) * count(*)', 'sum(quantity_on_hand)', 2)} AS turnover_rate
        FROM stock LEFT JOIN (SELECT product_key, sum(quantity) AS sold FROM fact_sales GROUP BY ALL) USING (product_key)
        GROUP BY ALL""",
    "stockout_analysis": f"""
        SELECT product_name, {OUT_DAYS} AS stockout_days, {rounded(OUT_DAYS, 'count(*)', 1, 100)} AS stockout_pct
        FROM stock GROUP BY ALL HAVING {OUT_DAYS} > 0""",
    "stockout_check": f"""
        SELECT product_name, count(*) AS total_days, {OUT_DAYS} AS stockout_days,
               {rounded(OUT_DAYS, 'count(*)', 1, 100)} AS stockout_pct,
               min(full_date) FILTER (is_out_of_stock) AS first_stockout_date,
               max(full_date) FILTER (is_out_of_stock) AS last_stockout_date
        FROM stock GROUP BY ALL HAVING {OUT_DAYS} > 0""",
    "latest_inventory_status": """
        SELECT product_name, category_name, quantity_on_hand, quantity_available, reorder_point, days_of_supply,
               is_out_of_stock, is_below_reorder_point
        FROM stock WHERE full_date = (SELECT max(full_date) FROM stock)
        ORDER BY days_of_supply NULLS FIRST, product_key LIMIT 20""",
    "sales_vs_stock": """
        SELECT product_name, category_name, net::DOUBLE AS total_sales, pieces::BIGINT AS total_qty_sold, latest_stock
        FROM dim_product
        LEFT JOIN (SELECT product_key, sum(net_amount) AS net, sum(quantity) AS pieces FROM fact_sales GROUP BY ALL)
            USING (product_key)
        LEFT JOIN (SELECT product_key, quantity_on_hand AS latest_stock FROM stock
                   WHERE full_date = (SELECT max(full_date) FROM stock)) USING (product_key)
        ORDER BY net DESC NULLS LAST, product_key LIMIT 15""",
    "product_stock_history": """
        SELECT full_date, product_name, quantity_on_hand, quantity_available, days_of_supply
        FROM stock WHERE product_key = 20 ORDER BY full_date LIMIT 15""",
    # catalog, load, export
    "raw_row_counts": " UNION ALL ".join(_count(f"raw_{name}", table_name=name) for name in COLUMNS),
    "load_audit": " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS extracted, count(*) AS loaded, true AS succeeded FROM raw_{name}"
        for name in COLUMNS
    ),
    "table_row_counts": " UNION ALL ".join(
        _count(name, table_name=name, type="fact" if name.startswith("fact_") else "dimension")
        for name in LAYERS if name.startswith(("fact_", "dim_"))
    ),
    "warehouse_build": " UNION ALL ".join(
        _count(name, table_name=name) for name in LAYERS if name.startswith(("stg_", "int_", "dim_", "fact_"))
    ),
    "preview_fact_sales": """
        SELECT date_key, time_key, customer_key, product_key, order_id, order_item_id, quantity,
               unit_price::DOUBLE AS unit_price, discount_rate::DOUBLE AS discount_rate,
               net_amount::DOUBLE AS net_amount, gross_profit::DOUBLE AS gross_profit
        FROM fact_sales ORDER BY order_item_id LIMIT 10""",
    "preview_fact_label": """
        SELECT 'fact_sales' AS fact_table, order_id, order_item_id, quantity, net_amount::DOUBLE AS net_amount
        FROM fact_sales ORDER BY order_item_id LIMIT 3""",
    "preview_dim_product": _model("dim_product") + " ORDER BY product_key LIMIT 10",
    "preview_dim_customer": """
        SELECT customer_key, customer_id, full_name, prefecture, region, rfm_segment
        FROM dim_customer ORDER BY customer_key LIMIT 10""",
    "preview_dim_date": "SELECT * FROM dim_date ORDER BY date_key LIMIT 5",
    "paged_query": """
        SELECT product_id, product_name, unit_price::DOUBLE AS unit_price, 3 AS page,
               (SELECT count(*) FROM raw_products) AS total_rows
        FROM raw_products ORDER BY product_name, product_id LIMIT 25 OFFSET 50""",
    "scan_raw": "SELECT * FROM raw_orders",
    "raw_load_roundtrip": " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, count(*) AS row_count, sum({columns[0]} % 1000003)::BIGINT AS key_sum FROM raw_{table}"
        for table, columns in COLUMNS.items()
    ),
    "export_csv_json": f"""
        SELECT format, year, month, month_name, {ORDERS} AS order_count, count(*) AS line_item_count,
               {NET} AS total_net_amount, sum(quantity)::BIGINT AS total_quantity
        FROM sale, (VALUES ('csv'), ('json')) AS formats(format) GROUP BY ALL""",
    # data quality
    "dq_unique": " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{key}' AS column_name, {key}::VARCHAR AS value, count(*) AS occurrences "
        f"FROM {table} WHERE {key} IS NOT NULL GROUP BY {key} HAVING count(*) > 1" for table, key in KEYS.items()
    ),
    "dq_not_null": " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{column}' AS column_name, count(*) - count({column}) AS null_rows FROM {table}"
        for table, columns in NOT_NULL.items() for column in columns
    ),
    "dq_relationships": " UNION ALL ".join(
        f"SELECT '{fact}' AS table_name, '{key}' AS column_name, {key}::VARCHAR AS value, count(*) AS occurrences "
        f"FROM {fact} WHERE {key} NOT IN (SELECT {key} FROM {dimension}) GROUP BY {key}"
        for fact, key, dimension in REFERENCES
    ),
    "dq_accepted_values": """
        SELECT 'dim_product' AS table_name, product_key AS key, abc_rank AS value FROM dim_product
        WHERE abc_rank NOT IN ('A', 'B', 'C')
        UNION ALL
        SELECT 'dim_customer', customer_key, rfm_segment FROM dim_customer
        WHERE rfm_segment NOT IN ('チャンピオン', 'ロイヤル', '有望', 'リスクあり', '休眠', 'その他', '未購入')""",
    "dq_net_amount": "SELECT order_item_id, net_amount::DOUBLE AS net_amount FROM fact_sales WHERE net_amount < 0",
    "dq_inventory_available": """
        SELECT product_key, date_key, quantity_on_hand, quantity_reserved, quantity_available,
               quantity_on_hand - quantity_reserved AS expected_available
        FROM fact_inventory_daily WHERE quantity_available + quantity_reserved <> quantity_on_hand""",
    "dq_inventory_non_negative":
        "SELECT product_key, date_key, quantity_on_hand FROM fact_inventory_daily WHERE quantity_on_hand < 0",
    "dq_funnel_consistency": """
        SELECT session_id FROM fact_page_views WHERE page_type = 'complete'
        EXCEPT SELECT session_id FROM fact_page_views WHERE page_type = 'checkout'""",
    "dq_rfm_score_range": """
        SELECT customer_key, total_orders, rfm_recency_score, rfm_frequency_score, rfm_monetary_score
        FROM dim_customer
        WHERE least(rfm_recency_score, rfm_frequency_score, rfm_monetary_score) < 1
           OR greatest(rfm_recency_score, rfm_frequency_score, rfm_monetary_score) > 5
           OR (total_orders = 0 AND coalesce(rfm_recency_score, rfm_frequency_score, rfm_monetary_score) IS NOT NULL)""",
    "dq_source_constraints": " UNION ALL ".join(
        [
            f"SELECT 'unique' AS \"constraint\", '{table}' AS table_name, '{','.join(columns)}' AS column_name, "
            f"concat_ws('|', {', '.join(columns)}) AS value, count(*) AS occurrences "
            f"FROM raw_{table} GROUP BY {', '.join(columns)} HAVING count(*) > 1"
            for table, columns in UNIQUE_KEYS
        ]
        + [
            f"SELECT 'foreign key', '{child}', '{column}', {column}::VARCHAR, count(*) FROM raw_{child} "
            f"WHERE {column} NOT IN (SELECT {key} FROM raw_{parent}) GROUP BY {column}"
            for child, column, parent, key in FOREIGN_KEYS
        ]
    ),
    "schema_conformance": " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{column}' AS column_name, {column in REQUIRED[table]} AS required, "
        f"count(*) - count({column}) AS null_rows FROM raw_{table}"
        for table, columns in COLUMNS.items() for column in columns
    ),
}

LAYERS["months"] = """
    SELECT year_month, month, fiscal_year, sum(net_amount) AS revenue, count(DISTINCT order_id) AS orders
    FROM sale GROUP BY ALL"""
LAYERS["basket"] = "SELECT DISTINCT order_id, product_name FROM product_sale"


def _summary() -> str:
    """Failing rows per check, from the statements above."""
    parts = [
        f"SELECT 'unique' AS check_name, '{table}' AS table_name, '{key}' AS column_name, count(*) AS failing_rows "
        f"FROM (SELECT {key} FROM {table} WHERE {key} IS NOT NULL GROUP BY {key} HAVING count(*) > 1)"
        for table, key in KEYS.items()
    ]
    parts += [
        f"SELECT 'not_null', '{table}', '{column}', count(*) - count({column}) FROM {table}"
        for table, columns in NOT_NULL.items() for column in columns
    ]
    parts += [
        f"SELECT 'relationships', '{fact}', '{key}', count(*) FROM {fact} WHERE {key} NOT IN (SELECT {key} FROM {dimension})"
        for fact, key, dimension in REFERENCES
    ]
    accepted = REPORTS["dq_accepted_values"].split("UNION ALL")
    business = {
        ("abc_rank_values", "dim_product", "abc_rank"): accepted[0],
        ("rfm_segment_values", "dim_customer", "rfm_segment"): accepted[1],
        ("net_amount_not_negative", "fact_sales", "net_amount"): REPORTS["dq_net_amount"],
        ("inventory_available", "fact_inventory_daily", "quantity_available"): REPORTS["dq_inventory_available"],
        ("inventory_not_negative", "fact_inventory_daily", "quantity_on_hand"): REPORTS["dq_inventory_non_negative"],
        ("funnel_consistency", "fact_page_views", "session_id"): REPORTS["dq_funnel_consistency"],
        ("rfm_score_range", "dim_customer", "rfm_recency_score"): REPORTS["dq_rfm_score_range"],
    }
    parts += [
        f"SELECT '{check}', '{table}', '{column}', count(*) FROM ({body})"
        for (check, table, column), body in business.items()
    ]
    return " UNION ALL ".join(parts)


REPORTS["dq_summary"] = _summary()

# history of dimensions
for _name, _key, _columns in (
    ("customer", "customer_id", "city, prefecture, registration_channel"),
    ("product", "product_id", "unit_price::DOUBLE AS unit_price, is_active"),
):
    REPORTS[f"{_name}_history"] = f"""
        SELECT version_key, {_key}, {_columns}, valid_from, valid_to, valid_to = DATE '9999-12-31' AS is_current
        FROM {_name}_versions WHERE present"""
REPORTS["customer_previous_city"] = """
    SELECT now.customer_id, now.city AS current_city, before.city AS previous_city, before.city IS NOT NULL AS has_previous
    FROM customer_versions AS now
    LEFT JOIN (SELECT old.customer_id, arg_max(old.city, old.valid_from) AS city
               FROM customer_versions AS old JOIN customer_versions AS new USING (customer_id)
               WHERE old.present AND new.present AND new.valid_to = DATE '9999-12-31' AND old.city <> new.city
               GROUP BY old.customer_id) AS before USING (customer_id)
    WHERE now.present AND now.valid_to = DATE '9999-12-31'"""
ORDER_VERSIONS = """(SELECT f.order_id, f.net, v.version_key, v.city
    FROM (SELECT order_id, customer_key, full_date, sum(net_amount) AS net FROM sale GROUP BY ALL) AS f
    LEFT JOIN customer_versions AS v ON v.customer_id = f.customer_key AND v.present
        AND f.full_date BETWEEN v.valid_from AND v.valid_to - 1)"""
REPORTS["order_customer_versions"] = f"SELECT order_id, version_key FROM {ORDER_VERSIONS}"
REPORTS["city_sales_at_order_time"] = f"""
    SELECT city, count(*) AS order_count, sum(net)::DOUBLE AS total_sales FROM {ORDER_VERSIONS} GROUP BY city"""
REPORTS["monthly_product_sales"] = f"""
    SELECT year * 100 + month AS month, product_key AS product_id, count(*) AS line_count, sum(quantity)::BIGINT AS quantity,
           {NET} AS net_amount, sum(discount_rate)::DOUBLE AS discount_rates, count(discount_rate) AS discounted_lines
    FROM sale GROUP BY ALL"""
for _name in ("top_products", "category_sales"):
    REPORTS[f"{_name}_from_months"] = REPORTS[_name]

# bridge, junk dimension, mini-dimension, calendar in roles
LAYERS["applied_promotion"] = """
    SELECT l_orderkey AS order_id, l_suppkey AS promotion_key,
           sum(coalesce(floor(l_extendedprice * 100 + 0.5)::BIGINT, 0))::HUGEINT AS basis
    FROM lineitem WHERE l_suppkey IN (SELECT coupon_id FROM raw_coupons) GROUP BY ALL"""


def _split(source: str, share: str, units: str) -> str:
    """Whole units of an order by largest remainder, ties to the higher promotion."""
    return f"""
        SELECT * EXCLUDE (whole, rest, open),
               whole + CASE WHEN row_number() OVER (PARTITION BY order_id ORDER BY rest DESC, promotion_key DESC) <= open
                            THEN 1 ELSE 0 END AS units
        FROM (SELECT *, {units} - sum(whole) OVER (PARTITION BY order_id) AS open
              FROM (SELECT *, {units} * {share} // sum({share}) OVER same AS whole, {units} * {share} % sum({share}) OVER same AS rest
                    FROM {source} WINDOW same AS (PARTITION BY order_id)))"""


LAYERS["weighted_promotion"] = _split("applied_promotion", "basis", "1000000::HUGEINT")
LAYERS["order_sale"] = """
    SELECT order_id, customer_key, full_date, is_weekend, is_holiday, time_key BETWEEN 9 AND 17 AS is_business_hours,
           coupon_code IS NOT NULL AS has_coupon, payment_method, device_type, sum(net_amount) AS net
    FROM sale GROUP BY ALL"""
LAYERS["promotion_amount"] = """
    SELECT order_id, promotion_key, units AS weight, (net * 1000000)::HUGEINT AS amount
    FROM weighted_promotion JOIN order_sale USING (order_id)"""
REPORTS["order_promotion_bridge"] = """
    SELECT order_id, promotion_key, units::DOUBLE / 1000000 AS weight_factor FROM weighted_promotion"""
REPORTS["promotion_sales"] = f"""
    SELECT promotion_key, count(*) AS order_count, sum(units)::DOUBLE / 1000000 AS allocated_sales
    FROM ({_split("promotion_amount", "weight", "amount")}) GROUP BY promotion_key"""

_TRUTH = "(VALUES (NULL::BOOLEAN, 0), (false, 1), (true, 2))"


def _slots(column: str) -> str:
    return f"""(SELECT {column}, row_number() OVER (ORDER BY {column}) AS slot
                FROM (SELECT DISTINCT {column} FROM order_sale WHERE {column} IS NOT NULL) UNION ALL SELECT NULL, 0)"""


LAYERS["flag_combination"] = f"""
    SELECT ((((w.s * 3 + h.s) * 3 + b.s) * 3 + c.s) * (SELECT count(DISTINCT payment_method) + 1 FROM order_sale) + p.slot)
               * (SELECT count(DISTINCT device_type) + 1 FROM order_sale) + d.slot AS flag_key,
           is_weekend, is_holiday, is_business_hours, has_coupon, payment_method, device_type
    FROM {_TRUTH} AS w(is_weekend, s), {_TRUTH} AS h(is_holiday, s), {_TRUTH} AS b(is_business_hours, s),
         {_TRUTH} AS c(has_coupon, s), {_slots("payment_method")} AS p, {_slots("device_type")} AS d"""
_FLAGS = ("is_weekend", "is_holiday", "is_business_hours", "has_coupon", "payment_method", "device_type")
REPORTS["order_flag_usage"] = f"""
    SELECT c.*, count(o.order_id) AS order_count, coalesce(sum(o.net), 0)::DOUBLE AS total_sales
    FROM flag_combination AS c LEFT JOIN order_sale AS o
      ON {" AND ".join(f"o.{flag} IS NOT DISTINCT FROM c.{flag}" for flag in _FLAGS)} GROUP BY ALL"""
REPORTS["payment_mix_from_flags"] = REPORTS["payment_mix"]

_BANDS = {
    "age_band": ("不明", "20代", "30代", "40代", "50代", "60代以上"),
    "activity_level": ("new", "low", "medium", "high"),
    "region": (*REGIONS, "不明"),
}
LAYERS["profile_combination"] = f"""
    SELECT (a.slot * {len(_BANDS["activity_level"]) + 1} + l.slot) * {len(_BANDS["region"]) + 1} + r.slot AS profile_key,
           age_band, activity_level, region
    FROM {", ".join(
        "(VALUES (NULL::VARCHAR, 0), " + ", ".join(f"('{v}', {n})" for n, v in enumerate(values, 1)) + f") AS {name[0] if name != 'activity_level' else 'l'}({name}, slot)"
        for name, values in _BANDS.items())}"""
LAYERS["order_profile"] = """
    SELECT order_id, net,
           CASE WHEN birth_date IS NULL THEN '不明' ELSE
               ['20代', '30代', '40代', '50代', '60代以上'][least(greatest((year(full_date) - year(birth_date)) // 10, 2), 6) - 1]
           END AS age_band,
           CASE WHEN place = 1 THEN 'new' WHEN place <= 3 THEN 'low' WHEN place <= 10 THEN 'medium' ELSE 'high' END AS activity_level,
           coalesce(m.region, '不明') AS region
    FROM (SELECT *, row_number() OVER (PARTITION BY customer_key ORDER BY full_date, order_id) AS place FROM order_sale) AS o
    JOIN raw_customers AS c ON c.customer_id = o.customer_key LEFT JOIN region_map AS m USING (prefecture)"""
REPORTS["order_profiles"] = "SELECT order_id, profile_key FROM order_profile JOIN profile_combination USING (age_band, activity_level, region)"
REPORTS["profile_sales"] = """
    SELECT c.*, count(order_id) AS order_count, coalesce(sum(net), 0)::DOUBLE AS total_sales
    FROM profile_combination AS c LEFT JOIN order_profile USING (age_band, activity_level, region) GROUP BY ALL"""
_LAG, _AGE = "date_diff('day', order_date, shipped)", "date_diff('day', p.created_at::DATE, order_date)"
REPORTS["delivery_lags"] = f"""
    SELECT strftime(order_date, '%Y-%m') AS order_year_month, isodow(shipped) >= 6 AS ship_is_weekend, count(*) AS line_count,
           count(*) FILTER (strftime(order_date, '%Y-%m') = strftime(shipped, '%Y-%m')) AS same_month_lines,
           {rounded(f"sum({_LAG})", "count(*)", 2)} AS avg_days_to_ship,
           min({_LAG}) AS fewest_days_to_ship, max({_LAG}) AS most_days_to_ship,
           {rounded(f"sum({_AGE})", f"count({_AGE})", 2)} AS avg_days_since_registration
    FROM (SELECT l_orderkey AS order_id, l_shipdate::DATE AS shipped FROM lineitem)
    JOIN raw_orders AS o USING (order_id) JOIN raw_customers AS p USING (customer_id)
    WHERE order_date IS NOT NULL AND shipped IS NOT NULL GROUP BY ALL"""


def statements() -> dict[str, str]:
    bodies = {name: _model(name) for name in MODELS} | REPORTS
    return {name: statement(body) for name, body in bodies.items()}
