"""The same results as SQL for DuckDB.

Shared pieces are CTEs; ``sql`` puts the ones a query needs in front of it.
"""

from __future__ import annotations

import re

from acceptance.views import VIEWS

SILVER = {
    "dim_products": """
        SELECT product_id, brand, model_name, display_name, category, price_usd, available_sizes_json,
          replace(tags, '|', ', ') AS tags, is_active <> 0 AS is_active, is_hype_product <> 0 AS is_hype_product
        FROM products_raw WHERE price_usd > 0""",
    "dim_users": r"""
        SELECT user_id, regexp_replace(lower(email), '^\s+|\s+$', '', 'g') AS email, first_name, last_name,
          nullif(regexp_extract(phone, '^\+\d+'), '') AS phone, coalesce(loyalty_tier, 'none') AS loyalty_tier,
          country_code
        FROM users_raw""",
    "fct_orders": """
        SELECT order_id, user_id, TRY_CAST(order_date AS TIMESTAMP) AS order_date, status, subtotal_usd,
          discount_amount_usd, shipping_cost_usd, tax_usd, total_usd, coalesce(coupon_code, '') AS coupon_code
        FROM orders_raw
        WHERE status IN ('delivered', 'shipped', 'processing', 'returned', 'cancelled', 'chargeback')
          AND TRY_CAST(order_date AS TIMESTAMP) IS NOT NULL""",
    "fct_order_lines": """
        SELECT order_id, product_id, quantity, unit_price_usd, line_total_usd
        FROM order_line_items_raw
        WHERE quantity > 0 AND abs(line_total_usd - unit_price_usd * quantity) <= CAST(0.01 AS DOUBLE)""",
    "dim_reviews": """
        SELECT review_id, product_id, user_id, rating, title, body, moderation_status
        FROM reviews_raw WHERE rating BETWEEN 1 AND 5""",
    "fct_reviews": "SELECT * FROM dim_reviews WHERE moderation_status = 'approved'",
    "fct_clickstream": """
        SELECT event_id, event_type, event_ts, user_id, session_id, page_path, is_bot, dt,
          user_id IS NULL AS is_anonymous
        FROM clickstream_raw WHERE NOT coalesce(is_bot, false)""",
    "fct_payments": """
        SELECT transaction_id, order_id, user_id, amount_usd, transaction_type, status FROM payments_raw""",
    "fct_inventory": """
        SELECT product_id, warehouse_id, movement_type, quantity, movement_ts,
          CASE WHEN movement_type IN ('sale', 'transfer_out', 'damaged_write_off', 'stock_adjustment_minus')
            THEN -abs(quantity) ELSE abs(quantity) END AS signed_quantity
        FROM inventory_raw""",
    "abandoned_carts": """
        SELECT CAST(o_orderkey AS STRING) AS cart_id, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_custkey END AS user_id,
          CASE WHEN o_orderkey % 4 = 0 THEN 'payment' ELSE 'shipping' END AS abandonment_step,
          o_totalprice AS cart_total_usd, o_orderkey % 12 = 0 AS cart_recovered,
          CASE WHEN o_orderkey % 12 = 0 THEN o_orderkey END AS recovered_order_id,
          o_orderkey, o_custkey, o_orderkey % 9 // 3 AS n_items
        FROM orders""",
    "cart_items": """
        SELECT cart_id, user_id, abandonment_step, cart_total_usd, cart_recovered, recovered_order_id,
          o_custkey % 100 AS product_id, 1 + o_orderkey % 3 AS quantity,
          CAST(900 + o_custkey % 100 AS DOUBLE) AS unit_price_usd
        FROM abandoned_carts WHERE n_items >= 1
        UNION ALL
        SELECT cart_id, user_id, abandonment_step, cart_total_usd, cart_recovered, recovered_order_id,
          o_orderkey % 100, 1, CAST(900 + o_orderkey % 100 AS DOUBLE)
        FROM abandoned_carts WHERE n_items >= 2
        UNION ALL
        SELECT cart_id, user_id, abandonment_step, cart_total_usd, cart_recovered, recovered_order_id,
          NULL, NULL, NULL
        FROM abandoned_carts WHERE n_items = 0""",
    "sold_orders": "SELECT * FROM fct_orders WHERE status NOT IN ('cancelled', 'chargeback')",
    "daily_revenue": """
        SELECT CAST(o.order_date AS DATE) AS order_date, CAST(COUNT(DISTINCT o.order_id) AS BIGINT) AS total_orders,
          CAST(SUM(CAST(o.total_usd AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue,
          CAST(SUM(CAST(o.total_usd AS DECIMAL(18,2))) AS DOUBLE) / COUNT(o.total_usd) AS avg_order_value,
          CAST(SUM(l.quantity) AS BIGINT) AS total_items
        FROM sold_orders o LEFT JOIN fct_order_lines l ON o.order_id = l.order_id
        GROUP BY 1""",
    "order_items": "SELECT order_id, SUM(quantity) AS quantity FROM fct_order_lines GROUP BY order_id",
    "daily_revenue_exact": """
        SELECT CAST(o.order_date AS DATE) AS order_date, CAST(COUNT(DISTINCT o.order_id) AS BIGINT) AS total_orders,
          CAST(SUM(CAST(o.total_usd AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue,
          CAST(SUM(CAST(o.total_usd AS DECIMAL(18,2))) AS DOUBLE) / COUNT(o.total_usd) AS avg_order_value,
          CAST(SUM(l.quantity) AS BIGINT) AS total_items
        FROM sold_orders o LEFT JOIN order_items l ON o.order_id = l.order_id
        GROUP BY 1""",
    "product_performance": """
        SELECT p.product_id, p.model_name, p.brand, p.category, CAST(SUM(l.quantity) AS BIGINT) AS total_quantity_sold,
          CAST(SUM(CAST(l.line_total_usd AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue,
          CAST(COUNT(DISTINCT l.order_id) AS BIGINT) AS num_orders,
          CAST(SUM(CAST(l.unit_price_usd AS DECIMAL(18,2))) AS DOUBLE) / COUNT(l.unit_price_usd) AS avg_unit_price
        FROM fct_order_lines l JOIN dim_products p ON l.product_id = p.product_id
          JOIN sold_orders o ON l.order_id = o.order_id
        GROUP BY p.product_id, p.model_name, p.brand, p.category""",
    "customer_ltv": """
        SELECT u.user_id, u.email, u.first_name, u.last_name, u.loyalty_tier,
          CAST(COUNT(DISTINCT o.order_id) AS BIGINT) AS total_orders,
          CAST(SUM(CAST(o.total_usd AS DECIMAL(18,2))) AS DOUBLE) AS total_spent,
          CAST(SUM(CAST(o.total_usd AS DECIMAL(18,2))) AS DOUBLE) / COUNT(o.total_usd) AS avg_order_value,
          MIN(o.order_date) AS first_order_date, MAX(o.order_date) AS last_order_date,
          CAST(EXTRACT(DAY FROM MAX(o.order_date) - MIN(o.order_date)) AS BIGINT) AS days_as_customer
        FROM sold_orders o JOIN dim_users u ON o.user_id = u.user_id
        GROUP BY u.user_id, u.email, u.first_name, u.last_name, u.loyalty_tier""",
    "session_steps": """
        SELECT session_id, bool_or(event_type = 'page_view') AS s1, bool_or(event_type = 'product_view') AS s2,
          bool_or(event_type = 'add_to_cart') AS s3, bool_or(event_type = 'checkout') AS s4
        FROM fct_clickstream WHERE session_id IS NOT NULL GROUP BY session_id""",
    "moments1": """
        SELECT e.session_id, min({'ts': e.event_ts, 'id': e.event_id}) AS moment FROM fct_clickstream e
        WHERE e.event_type = 'page_view' AND e.session_id IS NOT NULL AND e.event_ts IS NOT NULL GROUP BY e.session_id""",
    "moments2": """
        SELECT e.session_id, min({'ts': e.event_ts, 'id': e.event_id}) AS moment FROM fct_clickstream e JOIN moments1 b ON b.session_id = e.session_id AND (e.event_ts > b.moment.ts OR e.event_ts = b.moment.ts AND e.event_id > b.moment.id)
        WHERE e.event_type = 'product_view' AND e.session_id IS NOT NULL AND e.event_ts IS NOT NULL GROUP BY e.session_id""",
    "moments3": """
        SELECT e.session_id, min({'ts': e.event_ts, 'id': e.event_id}) AS moment FROM fct_clickstream e JOIN moments2 b ON b.session_id = e.session_id AND (e.event_ts > b.moment.ts OR e.event_ts = b.moment.ts AND e.event_id > b.moment.id)
        WHERE e.event_type = 'add_to_cart' AND e.session_id IS NOT NULL AND e.event_ts IS NOT NULL GROUP BY e.session_id""",
    "moments4": """
        SELECT e.session_id, min({'ts': e.event_ts, 'id': e.event_id}) AS moment FROM fct_clickstream e JOIN moments3 b ON b.session_id = e.session_id AND (e.event_ts > b.moment.ts OR e.event_ts = b.moment.ts AND e.event_id > b.moment.id)
        WHERE e.event_type = 'checkout' AND e.session_id IS NOT NULL AND e.event_ts IS NOT NULL GROUP BY e.session_id""",
    "funnel_totals": """
        SELECT COUNT(*) FILTER (WHERE s1) AS n1, COUNT(*) FILTER (WHERE s2) AS n2,
          COUNT(*) FILTER (WHERE s3) AS n3, COUNT(*) FILTER (WHERE s4) AS n4 FROM session_steps""",
    "campaign_counts": """
        SELECT campaign_id, COUNT(*) FILTER (WHERE event_type = 'email_sent') AS sent,
          COUNT(*) FILTER (WHERE event_type = 'email_delivered') AS delivered,
          COUNT(*) FILTER (WHERE event_type = 'email_opened') AS opened,
          COUNT(*) FILTER (WHERE event_type = 'email_clicked') AS clicked,
          COUNT(*) FILTER (WHERE event_type = 'email_bounced') AS bounced
        FROM marketing_raw GROUP BY campaign_id""",
    "searches": r"""
        SELECT event_id, query_raw, regexp_replace(trim(lower(query_raw)), '\s+', ' ', 'g') AS query_clean FROM search_raw""",
    "terms": "SELECT DISTINCT lower(trim(query_normalized)) AS term FROM search_raw",
    "typed": "SELECT DISTINCT query_clean FROM searches",
    "corrections": """
        SELECT query_clean, term, levenshtein(query_clean, term) AS edit_distance,
          row_number() OVER (PARTITION BY query_clean ORDER BY levenshtein(query_clean, term), term) AS place
        FROM typed, terms WHERE levenshtein(query_clean, term) <= 2""",
    "batch": """
        SELECT order_id, user_id, order_date + INTERVAL 1 DAY AS order_date, 'shipped' AS status, subtotal_usd,
          discount_amount_usd, shipping_cost_usd, tax_usd, total_usd, coupon_code
        FROM fct_orders WHERE status = 'processing'
        UNION ALL SELECT * FROM fct_orders WHERE status = 'processing'
        UNION ALL
        SELECT order_id + 1000000000, user_id, order_date, status, subtotal_usd, discount_amount_usd,
          shipping_cost_usd, tax_usd, total_usd, coupon_code
        FROM fct_orders WHERE status = 'returned'""",
    "counts": """
        SELECT 'products' AS table_name, COUNT(*) AS rows FROM products_raw
        UNION ALL SELECT 'users', COUNT(*) FROM users_raw
        UNION ALL SELECT 'orders', COUNT(*) FROM orders_raw
        UNION ALL SELECT 'order_line_items', COUNT(*) FROM order_line_items_raw
        UNION ALL SELECT 'reviews', COUNT(*) FROM reviews_raw
        UNION ALL SELECT 'clickstream', COUNT(*) FROM clickstream_raw""",
    "expected_revenue": "SELECT SUM(CAST(total_usd AS DECIMAL(18,2))) AS expected FROM sold_orders",
}
CTES = {**VIEWS, **SILVER}


def _needed(text: str, done: list[str]) -> None:
    for word in re.findall(r"\w+", text):
        # A CTE may carry the name of a column or of a literal; a spare CTE does no harm.
        if word in CTES and word not in done:
            done.append(word)
            _needed(CTES[word], done)


def sql(query: str) -> str:
    """``query`` with the CTEs it refers to, each after those it is built on."""
    found: list[str] = []
    _needed(query, found)
    ordered = [name for name in CTES if name in found]
    return "WITH " + ",\n".join(f"{name} AS ({CTES[name]})" for name in ordered) + "\n" + query


def _fk(relation: str, child: str, key: str, parent: str, parent_key: str) -> str:
    return f"""
        SELECT '{relation}' AS relation, COUNT({key}) AS checked_rows,
          COUNT(*) FILTER (WHERE {key} IS NOT NULL AND {key} NOT IN (SELECT {parent_key} FROM {parent})) AS orphan_rows,
          COUNT(DISTINCT {key}) FILTER (WHERE {key} NOT IN (SELECT {parent_key} FROM {parent})) AS orphan_keys
        FROM {child}"""


def _filled(table: str, raw: str, *names: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{name}' AS column_name, COUNT({name}) AS filled FROM {raw}" for name in names
    )


def _column_profile(raw: str, kinds: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, COUNT(*) AS rows, COUNT(*) - COUNT({name}) AS nulls, "
        f"COUNT(DISTINCT {name}) AS distinct_values, '{kind}' AS data_type FROM {raw}"
        for name, kind in kinds.items()
    )


def _numeric(raw: str, *names: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{name}' AS column_name, COUNT({name}) AS count,
          round(avg({name}), 6) AS mean,
          round(stddev_samp({name}), 4) AS std, MIN({name}) AS min, quantile_cont({name}, 0.25) AS p25,
          quantile_cont({name}, 0.5) AS p50, quantile_cont({name}, 0.75) AS p75, MAX({name}) AS max FROM {raw}"""
        for name in names
    )


def _rule(dataset: str, rule: str, raw: str, broken: str) -> str:
    return f"SELECT '{dataset}' AS dataset, '{rule}' AS rule, COUNT(*) FILTER (WHERE {broken}) AS violations FROM {raw}"


def _cast_check(name: str, kind: str) -> str:
    return (
        f"SELECT '{name}' AS column_name, COUNT({name}) AS filled, "
        f"COUNT(*) FILTER (WHERE {name} IS NOT NULL AND TRY_CAST({name} AS {kind}) IS NULL) AS failed FROM orders_raw"
    )


def _layer(table: str, raw: str, silver: str, bronze_cols: int, silver_cols: int) -> str:
    return f"""
        SELECT '{table}' AS table_name, CAST({bronze_cols} AS BIGINT) AS bronze_cols, CAST({silver_cols} AS BIGINT) AS silver_cols,
          (SELECT COUNT(*) FROM {raw}) AS bronze_rows, (SELECT COUNT(*) FROM {silver}) AS silver_rows, 'OK' AS status"""


def _leak(table: str, silver: str, internal: int) -> str:
    return f"""
        SELECT '{table}' AS table_name, CAST({internal} AS BIGINT) AS internal_cols, CAST(0 AS BIGINT) AS leaked_cols,
          CAST(0 AS BIGINT) AS leaked_values, COUNT(*) AS silver_rows FROM {silver}"""


def _audit(table: str, raw: str, columns: int) -> str:
    return f"""
        SELECT 'transform' AS step, '{table}' AS table_name, (SELECT COUNT(*) FROM {raw}) AS rows_in,
          (SELECT COUNT(*) FROM {table}) AS rows_out,
          (SELECT COUNT(*) FROM {raw}) - (SELECT COUNT(*) FROM {table}) AS rows_dropped,
          CAST({columns} AS INTEGER) AS columns, 'success' AS status"""


def _audit_rule(table: str, rule: str, raw: str, broken: str) -> str:
    return f"SELECT '{table}' AS table_name, '{rule}' AS rule, COUNT(*) FILTER (WHERE {broken}) AS violations FROM {raw}"


def _union(*parts: str) -> str:
    return " UNION ALL ".join(parts)


KNOWN = "coalesce(status IN ('delivered', 'shipped', 'processing', 'returned', 'cancelled', 'chargeback'), false)"
ORDER_GAP = "abs(total_usd - (subtotal_usd - discount_amount_usd + shipping_cost_usd + tax_usd))"
LINE_GAP = "abs(line_total_usd - unit_price_usd * quantity)"
TOLERANCE = "CAST(0.01 AS DOUBLE)"
OUTGOING = "movement_type IN ('sale', 'transfer_out', 'damaged_write_off', 'stock_adjustment_minus')"
USER_COLUMNS = (
    "user_id", "email", "first_name", "last_name", "phone", "loyalty_tier", "country_code",
    "_hashed_password", "_last_ip", "_device_fingerprint",
)
SIGN_RULES = (
    ("payments", "negative_without_refund", "payments_raw", "amount_usd < 0 AND transaction_type <> 'refund'"),
    ("payments", "refund_not_negative", "payments_raw", "amount_usd >= 0 AND transaction_type = 'refund'"),
    ("inventory", "negative_without_outgoing", "inventory_raw", f"quantity < 0 AND NOT {OUTGOING}"),
    ("inventory", "outgoing_not_negative", "inventory_raw", f"quantity >= 0 AND {OUTGOING}"),
)

PLAIN = (
    "dim_products", "dim_users", "fct_orders", "fct_order_lines", "dim_reviews", "fct_reviews", "fct_clickstream",
    "fct_payments", "fct_inventory", "daily_revenue", "daily_revenue_exact", "product_performance", "customer_ltv",
)

ORACLE: dict[str, str] = {name: sql(f"SELECT * FROM {name}") for name in PLAIN}
ORACLE |= {name: sql(text) for name, text in {
    "dim_users_short_phone": r"""
        SELECT user_id, email, first_name, last_name, nullif(regexp_extract(phone, '^\+\d{1,3}'), '') AS phone,
          loyalty_tier, country_code FROM dim_users""",
    "fct_order_lines_checked": "SELECT * FROM fct_order_lines WHERE order_id IN (SELECT order_id FROM fct_orders)",
    "daily_revenue_report": """
        SELECT order_date, total_orders, CAST(ROUND(CAST(total_revenue AS DECIMAL(38,6)), 2) AS DOUBLE) AS total_revenue,
          CAST(ROUND(CAST(avg_order_value AS DECIMAL(38,6)), 2) AS DOUBLE) AS avg_order_value,
          coalesce(total_items, 0) AS total_items
        FROM daily_revenue_exact""",
    "product_performance_named": """
        SELECT product_id, model_name AS product_name, brand, category, total_quantity_sold, total_revenue,
          num_orders, avg_unit_price FROM product_performance""",
    "funnel_analysis": """
        SELECT CAST(1 AS INTEGER) AS step_no, 'page_view' AS step, n1 AS sessions,
          CAST(n1 AS DOUBLE) / nullif(CAST(n1 AS DOUBLE), 0) AS rate FROM funnel_totals
        UNION ALL SELECT 2, 'product_view', n2, CAST(n2 AS DOUBLE) / nullif(CAST(n1 AS DOUBLE), 0) FROM funnel_totals
        UNION ALL SELECT 3, 'add_to_cart', n3, CAST(n3 AS DOUBLE) / nullif(CAST(n1 AS DOUBLE), 0) FROM funnel_totals
        UNION ALL SELECT 4, 'checkout', n4, CAST(n4 AS DOUBLE) / nullif(CAST(n1 AS DOUBLE), 0) FROM funnel_totals""",
    "inventory_status": """
        SELECT product_id, CAST(SUM(signed_quantity) AS BIGINT) AS current_stock, COUNT(*) AS movements
        FROM fct_inventory GROUP BY product_id""",
    "campaign_performance": """
        SELECT *, CAST(delivered AS DOUBLE) / nullif(CAST(sent AS DOUBLE), 0) AS delivery_rate,
          CAST(opened AS DOUBLE) / nullif(CAST(delivered AS DOUBLE), 0) AS open_rate,
          CAST(clicked AS DOUBLE) / nullif(CAST(opened AS DOUBLE), 0) AS click_rate,
          CAST(bounced AS DOUBLE) / nullif(CAST(sent AS DOUBLE), 0) AS bounce_rate
        FROM campaign_counts""",
    "payment_summary": """
        SELECT transaction_type, status, COUNT(*) AS transactions,
          CAST(SUM(CAST(amount_usd AS DECIMAL(18,2))) AS DOUBLE) AS net_amount
        FROM fct_payments GROUP BY transaction_type, status""",
    "brand_category_performance": """
        SELECT brand, category, COUNT(DISTINCT product_id) AS products_sold,
          CAST(SUM(total_quantity_sold) AS BIGINT) AS total_quantity_sold,
          CAST(SUM(CAST(total_revenue AS DECIMAL(38,2))) AS DOUBLE) AS total_revenue
        FROM product_performance GROUP BY brand, category""",
    "product_conversion": """
        SELECT p.product_id, p.num_orders, coalesce(t.interactions, 0) AS interactions,
          CAST(p.num_orders AS DOUBLE) / CAST(t.interactions AS DOUBLE) AS conversion
        FROM product_performance p
          LEFT JOIN (SELECT product_id, COUNT(*) AS interactions FROM interactions_raw GROUP BY product_id) t
          ON p.product_id = t.product_id""",
    "top_products": """
        SELECT product_id, model_name, brand, total_revenue FROM product_performance
        ORDER BY total_revenue DESC NULLS FIRST, product_id LIMIT 5""",
    "top_customers": """
        SELECT user_id, first_name, last_name, loyalty_tier, total_spent, total_orders FROM customer_ltv
        ORDER BY total_spent DESC NULLS FIRST, user_id LIMIT 5""",
    "first_days": "SELECT * FROM daily_revenue ORDER BY order_date LIMIT 5",
    "orders_enriched": """
        SELECT o.*, u.country_code, u.loyalty_tier FROM fct_orders o LEFT JOIN dim_users u ON o.user_id = u.user_id""",
    "lines_enriched": """
        SELECT l.*, p.brand, p.category FROM fct_order_lines l LEFT JOIN dim_products p ON l.product_id = p.product_id""",
    "lines_ri_semi": """
        SELECT l.* FROM fct_order_lines l WHERE EXISTS (SELECT 1 FROM fct_orders o WHERE o.order_id = l.order_id)""",
    "lines_orphans": """
        SELECT l.* FROM fct_order_lines l WHERE NOT EXISTS (SELECT 1 FROM fct_orders o WHERE o.order_id = l.order_id)""",
    "recovered_carts": """
        SELECT c.cart_id, c.user_id, c.abandonment_step, c.cart_total_usd, c.cart_recovered, c.recovered_order_id,
          o.status AS order_status, o.total_usd
        FROM abandoned_carts c LEFT JOIN fct_orders o ON c.recovered_order_id = o.order_id""",
    "clicked_searches": """
        SELECT s.*, p.brand, p.price_usd FROM search_raw s LEFT JOIN dim_products p ON s.clicked_product_id = p.product_id""",
    "reviews_with_products": """
        SELECT r.review_id, r.product_id, r.rating, p.brand
        FROM fct_reviews r LEFT JOIN dim_products p ON r.product_id = p.product_id""",
    "payments_with_orders": """
        SELECT p.*, o.status AS order_status FROM fct_payments p LEFT JOIN fct_orders o ON p.order_id = o.order_id""",
    "fk_violations": _union(
        _fk("orders.user_id", "orders_raw", "user_id", "users_raw", "user_id"),
        _fk("order_line_items.order_id", "order_line_items_raw", "order_id", "orders_raw", "order_id"),
        _fk("order_line_items.product_id", "order_line_items_raw", "product_id", "products_raw", "product_id"),
        _fk("payments.order_id", "payments_raw", "order_id", "orders_raw", "order_id"),
        _fk("clickstream.user_id", "clickstream_raw", "user_id", "users_raw", "user_id"),
        _fk("reviews.user_id", "reviews_raw", "user_id", "users_raw", "user_id"),
        _fk("reviews.product_id", "reviews_raw", "product_id", "products_raw", "product_id"),
        _fk("marketing.user_id", "marketing_raw", "user_id", "users_raw", "user_id"),
        _fk("search_events.user_id", "search_raw", "user_id", "users_raw", "user_id"),
        _fk("search_events.clicked_product_id", "search_raw", "clicked_product_id", "products_raw", "product_id"),
        _fk("interactions.user_id", "interactions_raw", "user_id", "users_raw", "user_id"),
        _fk("interactions.product_id", "interactions_raw", "product_id", "products_raw", "product_id"),
        _fk("inventory.product_id", "inventory_raw", "product_id", "products_raw", "product_id"),
        _fk("abandoned_carts.user_id", "abandoned_carts", "user_id", "users_raw", "user_id"),
        _fk("abandoned_carts.recovered_order_id", "abandoned_carts", "recovered_order_id", "orders_raw", "order_id"),
        _fk("abandoned_carts.items.product_id", "cart_items", "product_id", "products_raw", "product_id"),
        _fk("fct_order_lines.product_id", "fct_order_lines", "product_id", "dim_products", "product_id"),
    ),
    "product_sizes": """
        SELECT product_id, unnest(CAST(CAST(available_sizes_json AS JSON) AS VARCHAR[])) AS size FROM dim_products""",
    "product_tags": "SELECT product_id, unnest(string_split(tags, ', ')) AS tag FROM dim_products WHERE tags IS NOT NULL",
    "search_filters": r"""
        SELECT event_id, 'brand' AS filter_name, regexp_extract(filters_applied_json, ': "(.*)"', 1) AS filter_value
        FROM search_raw WHERE filters_applied_json IS NOT NULL""",
    "cart_items_flat": "SELECT * FROM cart_items",
    "bronze_jsonl_nested": "SELECT * FROM cart_items",
    "session_summary": """
        SELECT session_id, COUNT(*) AS events, MIN(event_ts) AS first_ts, MAX(event_ts) AS last_ts,
          COUNT(DISTINCT page_path) AS pages,
          CAST(epoch_us(MAX(event_ts)) - epoch_us(MIN(event_ts)) AS DOUBLE) / CAST(1000000 AS DOUBLE) AS duration_seconds
        FROM fct_clickstream GROUP BY session_id""",
    "session_events": """
        SELECT event_id, session_id, event_ts,
          row_number() OVER (PARTITION BY session_id ORDER BY event_ts, event_id) AS event_seq FROM fct_clickstream""",
    "search_normalized": """
        SELECT s.event_id, s.query_raw, s.query_clean, c.term AS query_corrected,
          CAST(c.edit_distance AS INTEGER) AS edit_distance
        FROM searches s LEFT JOIN corrections c ON s.query_clean = c.query_clean AND c.place = 1""",
    "users_masked": r"""
        SELECT user_id, sha256(email) AS email, nullif(regexp_extract(phone, '^\+\d+'), '') AS phone, loyalty_tier,
          country_code FROM users_raw""",
    "status_counts": "SELECT status, COUNT(*) AS cnt FROM orders_raw GROUP BY status",
    "rating_counts": "SELECT rating, COUNT(*) AS cnt FROM reviews_raw GROUP BY rating",
    "event_type_counts": "SELECT event_type, COUNT(*) AS cnt FROM clickstream_raw GROUP BY event_type",
    "table_counts": "SELECT * FROM counts",
    "tables_filled": """
        SELECT COUNT(*) AS tables, COUNT(*) = 6 AS expected_count, bool_and(rows > 0) AS all_filled FROM counts""",
    "table_shape": "SELECT COUNT(*) AS rows, CAST(12 AS BIGINT) AS columns FROM products_raw",
    "distinct_event_users": "SELECT DISTINCT event_type, user_id FROM clickstream_raw",
    "null_profile": _column_profile("users_raw", {c: "bigint" if c == "user_id" else "string" for c in USER_COLUMNS}),
    "numeric_profile": _numeric("orders_raw", "total_usd", "subtotal_usd", "discount_amount_usd"),
    "order_total_violations": f"""
        SELECT order_id, total_usd, {ORDER_GAP} AS gap FROM fct_orders WHERE {ORDER_GAP} > {TOLERANCE}""",
    "any_wrong_total": f"SELECT bool_or({ORDER_GAP} > {TOLERANCE}) AS any_broken FROM fct_orders",
    "line_total_violations": f"""
        SELECT order_id, product_id, quantity, unit_price_usd, line_total_usd, {LINE_GAP} AS gap
        FROM order_line_items_raw WHERE quantity > 0 AND {LINE_GAP} > {TOLERANCE}""",
    "allowed_value_violations": f"""
        SELECT 'status' AS column_name, status AS value, COUNT(*) AS cnt FROM orders_raw WHERE NOT {KNOWN} GROUP BY status
        UNION ALL
        SELECT 'rating', CAST(rating AS STRING), COUNT(*) FROM reviews_raw
        WHERE rating IS NULL OR rating NOT BETWEEN 1 AND 5 GROUP BY rating
        UNION ALL
        SELECT 'event_type', event_type, COUNT(*) FROM clickstream_raw
        WHERE event_type IS NULL OR event_type NOT IN ('page_view', 'product_view', 'add_to_cart', 'checkout')
        GROUP BY event_type""",
    "conditional_field_violations": _union(
        _rule("marketing", "clicked_url_iff_clicked", "marketing_raw",
              "(clicked_url IS NOT NULL) <> (event_type = 'email_clicked')"),
        _rule("marketing", "bounce_type_iff_bounced", "marketing_raw",
              "(bounce_type IS NOT NULL) <> (event_type = 'email_bounced')"),
        _rule("interactions", "selected_size_iff_size_select", "interactions_raw",
              "(selected_size IS NOT NULL) <> (event_type = 'size_select')"),
        _rule("interactions", "quantity_iff_add_to_cart", "interactions_raw",
              "(quantity IS NOT NULL) <> (event_type = 'add_to_cart')"),
    ),
    "sign_violations": _union(*[_rule(*rule) for rule in SIGN_RULES]),
    "cast_failures": _union(
        *[_cast_check(name, "BIGINT") for name in ("order_id", "user_id")],
        _cast_check("order_date", "DATE"),
        *[_cast_check(name, "DOUBLE") for name in (
            "subtotal_usd", "discount_amount_usd", "shipping_cost_usd", "tax_usd", "total_usd", "_fraud_score")],
    ),
    "revenue_reconciliation": """
        SELECT 'per_line' AS variant, CAST(SUM(total_revenue) AS DOUBLE) AS reported_revenue, CAST(MAX(expected) AS DOUBLE) AS expected_revenue,
          abs(SUM(CAST(total_revenue AS DECIMAL(18,2))) - MAX(expected)) <= 0.01 AS matches
        FROM (SELECT CAST(total_revenue AS DECIMAL(18,2)) AS total_revenue FROM daily_revenue), expected_revenue
        UNION ALL
        SELECT 'exact', CAST(SUM(total_revenue) AS DOUBLE), CAST(MAX(expected) AS DOUBLE),
          abs(SUM(CAST(total_revenue AS DECIMAL(18,2))) - MAX(expected)) <= 0.01
        FROM (SELECT CAST(total_revenue AS DECIMAL(18,2)) AS total_revenue FROM daily_revenue_exact), expected_revenue""",
    "layer_column_check": _union(
        _layer("products", "products_raw", "dim_products", 12, 10),
        _layer("users", "users_raw", "dim_users", 10, 7),
        _layer("orders", "orders_raw", "fct_orders", 12, 10),
        _layer("order_line_items", "order_line_items_raw", "fct_order_lines", 7, 5),
    ),
    "removed_columns": _union(
        _filled("products", "products_raw", "_internal_cost_usd", "_supplier_id"),
        _filled("users", "users_raw", "_hashed_password", "_last_ip", "_device_fingerprint"),
        _filled("orders", "orders_raw", "_stripe_charge_id", "_fraud_score"),
        _filled("order_line_items", "order_line_items_raw", "_warehouse_id", "_pick_slot"),
    ),
    "leaked_columns": _union(
        _leak("products", "dim_products", 2), _leak("users", "dim_users", 3),
        _leak("orders", "fct_orders", 2), _leak("order_line_items", "fct_order_lines", 2),
    ),
    "parameterised_sql": """
        SELECT order_id, status, total_usd FROM orders_raw WHERE status = 'shipped' AND total_usd >= 1000""",
    "concat_by_name": """
        SELECT event_id, event_type, event_ts, user_id, session_id, CAST(NULL AS BIGINT) AS product_id FROM clickstream_raw
        UNION ALL
        SELECT event_id, event_type, event_ts, user_id, NULL, product_id FROM interactions_raw""",
    "bronze_csv_roundtrip": """
        SELECT * REPLACE (is_active <> 0 AS is_active, is_hype_product <> 0 AS is_hype_product) FROM products_raw""",
    "bronze_csv_users": "SELECT * FROM users_raw",
    "bronze_jsonl_roundtrip": "SELECT * FROM reviews_raw",
    "bronze_parquet_partitioned": """
        SELECT * REPLACE (CASE WHEN dt >= DATE '2024-01-16' THEN _ttfb_ms END AS _ttfb_ms) FROM clickstream_raw""",
    "bronze_parquet_plain": "SELECT * FROM interactions_raw",
    "upsert_orders": """
        SELECT * FROM fct_orders o WHERE NOT EXISTS (SELECT 1 FROM batch b WHERE b.order_id = o.order_id)
        UNION ALL
        SELECT order_id, user_id, order_date, status, subtotal_usd, discount_amount_usd, shipping_cost_usd, tax_usd,
          total_usd, coupon_code
        FROM (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY order_date DESC) AS place FROM batch)
        WHERE place = 1""",
    "load_audit": _union(
        _audit("dim_products", "products_raw", 10), _audit("dim_users", "users_raw", 7),
        _audit("fct_orders", "orders_raw", 10), _audit("fct_order_lines", "order_line_items_raw", 5),
        _audit("fct_reviews", "reviews_raw", 7), _audit("fct_clickstream", "clickstream_raw", 9),
        _audit("fct_payments", "payments_raw", 6), _audit("fct_inventory", "inventory_raw", 6),
    ),
    "load_audit_rules": _union(
        _audit_rule("dim_products", "price_not_positive", "products_raw", "NOT coalesce(price_usd > 0, false)"),
        _audit_rule("fct_orders", "unknown_status", "orders_raw", f"NOT {KNOWN}"),
        _audit_rule("fct_orders", "unreadable_date", "orders_raw",
                    f"{KNOWN} AND TRY_CAST(order_date AS TIMESTAMP) IS NULL"),
        _audit_rule("fct_orders", "ambiguous_date", "orders_raw", "false"),
        _audit_rule("fct_orders", "inconsistent_total", "fct_orders", f"{ORDER_GAP} > {TOLERANCE}"),
        _audit_rule("fct_order_lines", "quantity_not_positive", "order_line_items_raw",
                    "NOT coalesce(quantity > 0, false)"),
        _audit_rule("fct_order_lines", "inconsistent_total", "order_line_items_raw",
                    f"quantity > 0 AND {LINE_GAP} > {TOLERANCE}"),
        _audit_rule("fct_order_lines", "missing_amount", "order_line_items_raw", f"quantity > 0 AND {LINE_GAP} IS NULL"),
        _audit_rule("fct_reviews", "rating_out_of_range", "reviews_raw", "NOT coalesce(rating BETWEEN 1 AND 5, false)"),
        _audit_rule("fct_clickstream", "bot", "clickstream_raw", "coalesce(is_bot, false)"),
        _audit_rule("fct_clickstream", "anonymous", "clickstream_raw", "user_id IS NULL"),
        _audit_rule("fct_payments", *SIGN_RULES[0][1:]), _audit_rule("fct_payments", *SIGN_RULES[1][1:]),
        _audit_rule("fct_inventory", *SIGN_RULES[2][1:]), _audit_rule("fct_inventory", *SIGN_RULES[3][1:]),
    ),
}.items()}

ORACLE["upsert_twice"] = sql("""
    SELECT * REPLACE (CASE WHEN status = 'returned' THEN CAST(1 AS DOUBLE) ELSE total_usd END AS total_usd) FROM fct_orders
    UNION ALL
    SELECT DISTINCT * REPLACE (CAST(NULL AS BIGINT) AS order_id, CAST(1 AS DOUBLE) AS total_usd) FROM fct_orders
    WHERE status = 'processing'""")
# A whole run ends in the tables that the same SQL gives over the files' contents.
ORACLE |= {f"run_{table}": ORACLE[table] for table in ("daily_revenue", "product_performance", "customer_ltv")}
ORACLE |= {f"run_incremental_{table}": ORACLE[table] for table in ("daily_revenue", "product_performance", "customer_ltv")}

ORACLE |= {name: sql(text) for name, text in {
    "carts_with_products": """
        SELECT c.cart_id, c.product_id, c.quantity, c.unit_price_usd, p.brand, p.price_usd
        FROM cart_items c LEFT JOIN dim_products p ON c.product_id = p.product_id""",
    "funnel_in_order": """
        SELECT step_no, step, sessions, CAST(sessions AS DOUBLE) / nullif(CAST(first_value(sessions) OVER (ORDER BY step_no) AS DOUBLE), 0) AS rate FROM (
          SELECT 1 AS step_no, 'page_view' AS step, count(*) AS sessions FROM moments1
          UNION ALL SELECT 2, 'product_view', count(*) FROM moments2
          UNION ALL SELECT 3, 'add_to_cart', count(*) FROM moments3
          UNION ALL SELECT 4, 'checkout', count(*) FROM moments4) AS steps""",
}.items()}

MISFIT_CELLS = """
    (SELECT line_item_id, note,
      CASE WHEN quantity LIKE 'KE-%' OR quantity IN ('1,000', '4.5') THEN quantity END AS quantity_text,
      CASE WHEN unit_price_usd = '12 USD' THEN unit_price_usd END AS price_text,
      quantity, unit_price_usd FROM misfits_raw) AS cells"""
ORACLE |= {name: sql(text) for name, text in {
    "bronze_csv_rescued": f"""
        SELECT line_item_id, CASE WHEN quantity_text IS NULL THEN CAST(CAST(quantity AS DOUBLE) AS BIGINT) END AS quantity,
          CASE WHEN price_text IS NULL THEN CAST(unit_price_usd AS DOUBLE) END AS unit_price_usd, quantity_text, price_text FROM {MISFIT_CELLS}""",
    "bronze_jsonl_rescued": f"""
        SELECT line_item_id, 'quantity' AS column_name, quantity_text AS text FROM {MISFIT_CELLS} WHERE quantity_text IS NOT NULL
        UNION ALL SELECT line_item_id, 'unit_price_usd', price_text FROM {MISFIT_CELLS} WHERE price_text IS NOT NULL
        UNION ALL SELECT line_item_id, 'note', note FROM misfits_raw WHERE note IS NOT NULL""",
    "quarantine_audit": f"""
        SELECT n AS rows_in, n AS rows_out, unnest(['quarantined', 'broken_line', 'unknown_field', 'misfit_line_item_id',
          'misfit_quantity', 'misfit_unit_price_usd']) AS rule, unnest([quarantined, 0, 0, 0, quantities, prices]) AS violations
        FROM (SELECT count(*) AS n, count(*) FILTER (quantity_text IS NOT NULL OR price_text IS NOT NULL) AS quarantined,
          count(quantity_text) AS quantities, count(price_text) AS prices FROM {MISFIT_CELLS})""",
    "bronze_parquet_drift": """
        SELECT event_id, CAST(user_id AS VARCHAR) AS user_id, CASE WHEN dt < DATE '2024-01-11' THEN floor(_ttfb_ms) ELSE _ttfb_ms END AS _ttfb_ms, dt
        FROM clickstream_raw""",
}.items()}
ORACLE["bronze_csv_stream"] = ORACLE["bronze_csv_rescued"]
ORACLE |= {name: sql(text) for name, text in {
    "fct_orders_dated": """
        SELECT r.order_id, r.status, r.total_usd, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) + CASE r.order_id % 8 WHEN 2 THEN INTERVAL '8 hours 15 minutes'
            WHEN 5 THEN INTERVAL '8 hours 30 minutes' WHEN 6 THEN INTERVAL '25 hours 500 milliseconds' ELSE INTERVAL '0 hours' END AS order_date
        FROM orders_dated_raw r JOIN orders ON r.order_id = o_orderkey WHERE r.order_id % 8 <> 7""",
    "date_formats": """
        SELECT CASE order_id % 8 WHEN 0 THEN 'iso' WHEN 1 THEN 'year_first' WHEN 3 THEN 'dotted' WHEN 4 THEN 'compact' WHEN 5 THEN 'iso_offset'
            WHEN 6 THEN 'iso_offset' WHEN 7 THEN 'other' ELSE CASE WHEN CAST(substr(order_date, 1, 2) AS INTEGER) > 12 THEN 'day_first' ELSE 'ambiguous' END END AS format,
          count(*) AS cnt FROM orders_dated_raw GROUP BY ALL""",
}.items()}
