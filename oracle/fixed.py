"""Fixed values that expected results rest on, written out so that they do not follow the package."""

# Columns of the operational tables.
COLUMNS = {
    "customers": ["customer_id", "first_name", "last_name", "email", "phone", "city", "prefecture", "postal_code", "created_at", "gender", "birth_date", "registration_channel"],
    "categories": ["category_id", "name", "parent_id"],
    "products": ["product_id", "product_name", "category_id", "unit_price", "description", "created_at", "cost_price", "weight_gram", "is_active"],
    "orders": ["order_id", "customer_id", "order_date", "shipping_address", "status", "created_at", "updated_at", "order_timestamp", "payment_method", "device_type", "coupon_code"],
    "order_items": ["order_item_id", "order_id", "product_id", "quantity", "unit_price", "discount"],
    "page_views": ["page_view_id", "customer_id", "session_id", "page_type", "product_id", "category_id", "referrer_type", "view_timestamp", "duration_seconds"],
    "inventory_snapshots": ["snapshot_id", "product_id", "snapshot_date", "quantity_on_hand", "quantity_reserved", "reorder_point", "lead_time_days"],
    "coupons": ["coupon_id", "coupon_code", "coupon_type", "discount_value", "min_order_amount", "valid_from", "valid_to", "campaign_name"],
}

# Columns that must not be null.
REQUIRED = {
    "customers": ["customer_id", "first_name", "last_name", "email"],
    "categories": ["category_id", "name"],
    "products": ["product_id", "product_name", "category_id", "unit_price"],
    "orders": ["order_id", "customer_id", "order_date", "status", "order_timestamp"],
    "order_items": ["order_item_id", "order_id", "product_id", "quantity", "unit_price"],
    "page_views": ["page_view_id", "session_id", "page_type", "view_timestamp"],
    "inventory_snapshots": ["snapshot_id", "product_id", "snapshot_date", "quantity_on_hand", "quantity_reserved", "reorder_point", "lead_time_days"],
    "coupons": ["coupon_id", "coupon_code", "coupon_type", "discount_value", "valid_from", "valid_to"],
}

# Keys of the operational tables.
UNIQUE_KEYS = [
    ("customers", ("customer_id",)),
    ("customers", ("email",)),
    ("categories", ("category_id",)),
    ("products", ("product_id",)),
    ("orders", ("order_id",)),
    ("order_items", ("order_item_id",)),
    ("page_views", ("page_view_id",)),
    ("inventory_snapshots", ("snapshot_id",)),
    ("inventory_snapshots", ("product_id", "snapshot_date")),
    ("coupons", ("coupon_id",)),
    ("coupons", ("coupon_code",)),
]

# Child table, column, parent table, key.
FOREIGN_KEYS = [
    ("categories", "parent_id", "categories", "category_id"),
    ("products", "category_id", "categories", "category_id"),
    ("orders", "customer_id", "customers", "customer_id"),
    ("order_items", "order_id", "orders", "order_id"),
    ("order_items", "product_id", "products", "product_id"),
    ("page_views", "customer_id", "customers", "customer_id"),
    ("page_views", "product_id", "products", "product_id"),
    ("page_views", "category_id", "categories", "category_id"),
    ("inventory_snapshots", "product_id", "products", "product_id"),
]

# Warehouse table -> key.
KEYS = {
    "stg_customers": "customer_id",
    "stg_categories": "category_id",
    "stg_products": "product_id",
    "stg_orders": "order_id",
    "stg_order_items": "order_item_id",
    "stg_page_views": "page_view_id",
    "stg_inventory_snapshots": "snapshot_id",
    "stg_coupons": "coupon_id",
    "int_customers_with_region": "customer_id",
    "int_products_with_categories": "product_id",
    "int_orders_with_items": "order_item_id",
    "int_customer_rfm": "customer_id",
    "int_customer_ltv": "customer_id",
    "int_product_abc": "product_id",
    "int_page_view_sessions": "session_id",
    "int_inventory_with_sales": "snapshot_id",
    "dim_date": "date_key",
    "dim_customer": "customer_key",
    "dim_product": "product_key",
    "dim_order_status": "order_status_key",
    "dim_time": "time_key",
    "dim_coupon": "coupon_key",
    "fact_page_views": "page_view_id",
}

# Fact, key, dimension.
REFERENCES = [
    ("fact_sales", "customer_key", "dim_customer"),
    ("fact_sales", "product_key", "dim_product"),
    ("fact_sales", "date_key", "dim_date"),
    ("fact_sales", "order_status_key", "dim_order_status"),
    ("fact_sales", "time_key", "dim_time"),
    ("fact_page_views", "date_key", "dim_date"),
    ("fact_page_views", "time_key", "dim_time"),
    ("fact_inventory_daily", "product_key", "dim_product"),
    ("fact_inventory_daily", "date_key", "dim_date"),
]

# Warehouse table -> columns that must not be null.
NOT_NULL = {
    "stg_customers": ["customer_id"],
    "stg_categories": ["category_id"],
    "stg_products": ["product_id"],
    "stg_orders": ["order_id"],
    "stg_order_items": ["order_item_id"],
    "stg_page_views": ["page_view_id"],
    "stg_inventory_snapshots": ["snapshot_id"],
    "stg_coupons": ["coupon_id"],
    "int_customers_with_region": ["customer_id"],
    "int_products_with_categories": ["product_id"],
    "int_orders_with_items": ["order_item_id"],
    "int_customer_rfm": ["customer_id"],
    "int_customer_ltv": ["customer_id"],
    "int_product_abc": ["product_id"],
    "int_page_view_sessions": ["session_id"],
    "int_inventory_with_sales": ["snapshot_id"],
    "dim_date": ["date_key"],
    "dim_customer": ["customer_key", "region"],
    "dim_product": ["product_key", "abc_rank"],
    "dim_order_status": ["order_status_key"],
    "dim_time": ["time_key"],
    "dim_coupon": ["coupon_key"],
    "fact_page_views": ["page_view_id", "date_key", "time_key"],
    "fact_sales": ["customer_key", "product_key", "date_key", "order_status_key", "time_key"],
    "fact_inventory_daily": ["product_key", "date_key"],
}

# Region -> prefectures.
REGIONS = {
    "北海道": ["北海道"],
    "東北": ["青森県", "岩手県", "宮城県", "秋田県", "山形県", "福島県"],
    "関東": ["茨城県", "栃木県", "群馬県", "埼玉県", "千葉県", "東京都", "神奈川県"],
    "中部": ["新潟県", "富山県", "石川県", "福井県", "山梨県", "長野県", "岐阜県", "静岡県", "愛知県"],
    "関西": ["三重県", "滋賀県", "京都府", "大阪府", "兵庫県", "奈良県", "和歌山県"],
    "中国": ["鳥取県", "島根県", "岡山県", "広島県", "山口県"],
    "四国": ["徳島県", "香川県", "愛媛県", "高知県"],
    "九州・沖縄": ["福岡県", "佐賀県", "長崎県", "熊本県", "大分県", "宮崎県", "鹿児島県", "沖縄県"],
}

# Public holidays.
HOLIDAYS = [
    "2024-01-01", "2024-01-08", "2024-02-11", "2024-02-12", "2024-02-23", "2024-03-20", "2024-04-29", "2024-05-03",
    "2024-05-04", "2024-05-05", "2024-05-06", "2024-07-15", "2024-08-11", "2024-08-12", "2024-09-16", "2024-09-22",
    "2024-09-23", "2024-10-14", "2024-11-03", "2024-11-04", "2024-11-23", "2025-01-01", "2025-01-13", "2025-02-11",
    "2025-02-23", "2025-02-24", "2025-03-20", "2025-04-29", "2025-05-03", "2025-05-04", "2025-05-05", "2025-05-06",
    "2025-07-21", "2025-08-11", "2025-09-15", "2025-09-23", "2025-10-13", "2025-11-03", "2025-11-23", "2025-11-24",
    "2026-01-01", "2026-01-12", "2026-02-11", "2026-02-23", "2026-03-20", "2026-04-29", "2026-05-03", "2026-05-04",
    "2026-05-05", "2026-05-06", "2026-07-20", "2026-08-11", "2026-09-21", "2026-09-22", "2026-09-23", "2026-10-12",
    "2026-11-03", "2026-11-23",
]
