"""Views that give the driver's tables the columns of the retail datasets.

The text runs in Spark and in DuckDB; carts are nested, so their view is Spark only.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

VIEWS: dict[str, str] = {
    "products_raw": """
        SELECT p_partkey AS product_id, p_brand AS brand, p_name AS model_name, p_name AS display_name, p_type AS category,
          CASE WHEN p_size = 13 THEN -p_retailprice WHEN p_size = 17 THEN CAST(0 AS DOUBLE) WHEN p_size = 19 THEN NULL ELSE p_retailprice END AS price_usd,
          '["S", "M", "' || CAST(p_size AS STRING) || '"]' AS available_sizes_json,
          CASE WHEN p_size = 23 THEN NULL ELSE replace(p_name, ' ', '|') || '|' || lower(p_type) END AS tags,
          CASE WHEN p_size % 10 = 0 THEN 0 ELSE 1 END AS is_active,
          CASE WHEN p_size % 7 = 0 THEN 1 ELSE 0 END AS is_hype_product,
          p_retailprice * 0.5 AS _internal_cost_usd, 'SUP' || CAST(p_partkey % 10 AS STRING) AS _supplier_id
        FROM part
    """,
    "users_raw": """
        SELECT c_custkey AS user_id, chr(9) || ' ' || replace(c_name, '#', '.') || '@Example.COM ' AS email,
          'First' || CAST(c_custkey AS STRING) AS first_name, c_mktsegment AS last_name,
          CASE WHEN c_custkey % 5 = 0 THEN NULL WHEN c_custkey % 5 = 1 THEN '06 12 34' WHEN c_custkey % 5 = 2 THEN '+33612345678'
               ELSE '+' || CAST(c_nationkey + 1 AS STRING) || ' 555 01' END AS phone,
          CASE WHEN c_mktsegment = 'BUILDING' THEN NULL WHEN c_acctbal < 0 THEN 'bronze' WHEN c_acctbal < 5000 THEN 'silver' ELSE 'gold' END AS loyalty_tier,
          CAST(c_nationkey AS STRING) AS country_code,
          'h' || CAST(c_custkey AS STRING) AS _hashed_password, '10.0.0.1' AS _last_ip, 'fp' AS _device_fingerprint
        FROM customer
    """,
    "orders_raw": """
        SELECT o_orderkey AS order_id, o_custkey AS user_id,
          CASE WHEN o_orderkey % 101 = 7 THEN 'bad-date' WHEN o_orderkey % 103 = 9 THEN NULL ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS order_date,
          CASE o_orderkey % 8 WHEN 0 THEN 'delivered' WHEN 1 THEN 'shipped' WHEN 2 THEN 'processing' WHEN 3 THEN 'returned'
               WHEN 4 THEN 'cancelled' WHEN 5 THEN 'chargeback' WHEN 6 THEN 'delivered' ELSE CASE WHEN o_orderkey % 16 = 7 THEN 'invalid_status' ELSE NULL END END AS status,
          o_totalprice AS subtotal_usd,
          CASE WHEN o_orderpriority = '1-URGENT' THEN CAST(10 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS discount_amount_usd,
          CAST(5 AS DOUBLE) AS shipping_cost_usd, CAST(2 AS DOUBLE) AS tax_usd,
          o_totalprice - CASE WHEN o_orderpriority = '1-URGENT' THEN CAST(10 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END + CAST(5 AS DOUBLE) + CAST(2 AS DOUBLE)
            + CASE WHEN o_orderkey % 40 = 3 THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS total_usd,
          CASE WHEN o_orderpriority = '1-URGENT' THEN 'SAVE10' END AS coupon_code,
          'ch_' || CAST(o_orderkey AS STRING) AS _stripe_charge_id, CAST(o_orderkey % 10 AS DOUBLE) AS _fraud_score
        FROM orders
    """,
    "orders_dated_raw": """
        SELECT o_orderkey AS order_id, 'shipped' AS status, o_totalprice AS total_usd,
          CASE o_orderkey % 8 WHEN 0 THEN d WHEN 1 THEN substr(d, 1, 4) || '/' || substr(d, 6, 2) || '/' || substr(d, 9, 2)
            WHEN 2 THEN substr(d, 9, 2) || '/' || substr(d, 6, 2) || '/' || substr(d, 1, 4) || ' 08:15:00'
            WHEN 3 THEN substr(d, 9, 2) || '.' || substr(d, 6, 2) || '.' || substr(d, 1, 4) WHEN 4 THEN replace(d, '-', '')
            WHEN 5 THEN d || 'T10:30:00+02:00' WHEN 6 THEN d || ' 23:30:00.5-0130' ELSE 'on ' || d END AS order_date
        FROM (SELECT *, CAST(CAST(o_orderdate AS DATE) AS STRING) AS d FROM orders) AS dated
    """,
    "order_line_items_raw": """
        SELECT CASE WHEN l_orderkey % 97 = 5 THEN l_orderkey + 100000000 ELSE l_orderkey END AS order_id, l_partkey AS product_id,
          CAST(CASE WHEN l_linenumber = 7 AND l_orderkey % 10 = 1 THEN 0 ELSE l_quantity END AS BIGINT) AS quantity,
          CAST(900 + l_partkey % 100 AS DOUBLE) AS unit_price_usd,
          CAST(900 + l_partkey % 100 AS DOUBLE) * l_quantity + CASE WHEN l_orderkey % 50 = 7 THEN CAST(0.5 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS line_total_usd,
          'W' || CAST(l_suppkey AS STRING) AS _warehouse_id, l_returnflag AS _pick_slot
        FROM lineitem
    """,
    "order_line_items_keyed_raw": """
        SELECT (((l_orderkey * 10 + l_linenumber) * 100000 + l_partkey) * 10000 + l_suppkey) * 100 + CAST(l_quantity AS BIGINT) AS line_item_id, CASE WHEN l_orderkey % 97 = 5 THEN l_orderkey + 100000000 ELSE l_orderkey END AS order_id, l_partkey AS product_id,
          CAST(CASE WHEN l_linenumber = 7 AND l_orderkey % 10 = 1 THEN 0 ELSE l_quantity END AS BIGINT) AS quantity,
          CAST(900 + l_partkey % 100 AS DOUBLE) AS unit_price_usd,
          CAST(900 + l_partkey % 100 AS DOUBLE) * l_quantity + CASE WHEN l_orderkey % 50 = 7 THEN CAST(0.5 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS line_total_usd,
          'W' || CAST(l_suppkey AS STRING) AS _warehouse_id, l_returnflag AS _pick_slot
        FROM lineitem
    """,
    "order_line_items_numbered_raw": """
        SELECT CASE WHEN l_linenumber IS NOT NULL AND l_partkey IS NOT NULL AND l_suppkey IS NOT NULL AND l_quantity IS NOT NULL THEN l_orderkey * 100000000 + place END AS line_item_id,
          CASE WHEN l_orderkey % 97 = 5 THEN l_orderkey + 100000000 ELSE l_orderkey END AS order_id, l_partkey AS product_id,
          CAST(CASE WHEN l_linenumber = 7 AND l_orderkey % 10 = 1 THEN 0 ELSE l_quantity END AS BIGINT) AS quantity,
          CAST(900 + l_partkey % 100 AS DOUBLE) AS unit_price_usd,
          CAST(900 + l_partkey % 100 AS DOUBLE) * l_quantity + CASE WHEN l_orderkey % 50 = 7 THEN CAST(0.5 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS line_total_usd,
          'W' || CAST(l_suppkey AS STRING) AS _warehouse_id, l_returnflag AS _pick_slot
        FROM (SELECT *, DENSE_RANK() OVER (PARTITION BY coalesce(l_orderkey, l_partkey, l_suppkey) ORDER BY l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS BIGINT)) AS place FROM lineitem) AS placed
    """,
    "misfits_raw": """
        SELECT l_orderkey * 10 + l_linenumber AS line_item_id,
          CASE l_orderkey % 9 WHEN 1 THEN 'KE-' || CAST(l_linenumber AS STRING) WHEN 2 THEN '1,000' WHEN 3 THEN '4.5' WHEN 4 THEN NULL WHEN 5 THEN '7.0' ELSE CAST(l_suppkey AS STRING) END AS quantity,
          CASE l_linenumber WHEN 1 THEN '12 USD' WHEN 2 THEN '1e3' WHEN 3 THEN '2.5' ELSE '99' END AS unit_price_usd,
          CASE WHEN l_orderkey % 5 = 0 THEN 'x' || CAST(l_partkey AS STRING) END AS note
        FROM lineitem
    """,
    "clickstream_raw": """
        SELECT event_id, CASE event_type WHEN 'view' THEN 'page_view' WHEN 'click' THEN 'product_view' WHEN 'signup' THEN 'add_to_cart' WHEN 'purchase' THEN 'checkout' ELSE event_type END AS event_type,
          ts AS event_ts, CASE WHEN event_id % 10 < 3 THEN NULL ELSE user_id END AS user_id,
          CAST(user_id AS STRING) || '-' || CAST(CAST(ts AS DATE) AS STRING) AS session_id, '/p/' || CAST(event_id % 50 AS STRING) AS page_path,
          '10.0.0.' || CAST(user_id AS STRING) AS ip_address, CASE WHEN event_id % 40 = 0 THEN NULL ELSE event_id % 20 = 1 END AS is_bot,
          CAST(ts AS DATE) AS dt, 'ga' AS _ga_client_id, value AS _ttfb_ms
        FROM events
    """,
    "reviews_raw": """
        SELECT d.doc_id AS review_id, d.doc_id % 200 AS product_id, d.doc_id % 150 AS user_id, d.doc_id % 7 AS rating, d.source AS title,
          CASE WHEN d.n_chars < 50 THEN NULL ELSE d.text END AS body,
          CASE WHEN l.doc_id IS NULL THEN 'pending' WHEN l.toxic = 1 THEN 'rejected' ELSE 'approved' END AS moderation_status,
          CAST(l.quality AS DOUBLE) AS _sentiment_raw, CAST(l.toxic AS DOUBLE) AS _toxicity_score, d.lang AS _language_detected
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
    """,
    "payments_raw": """
        SELECT o_orderkey AS transaction_id, o_orderkey AS order_id, o_custkey AS user_id,
          CASE WHEN o_orderkey % 9 = 4 THEN -o_totalprice ELSE o_totalprice END AS amount_usd,
          CASE WHEN o_orderkey % 18 = 4 THEN 'refund' WHEN o_orderkey % 9 = 5 THEN 'chargeback' ELSE 'charge' END AS transaction_type,
          CASE o_orderstatus WHEN 'F' THEN 'succeeded' WHEN 'O' THEN 'pending' ELSE 'failed' END AS status,
          CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE 'visa' END AS _card_brand
        FROM orders
    """,
    "inventory_raw": """
        SELECT l_partkey AS product_id, 'W' || CAST(l_suppkey AS STRING) AS warehouse_id,
          CASE l_linenumber WHEN 1 THEN 'purchase_order_received' WHEN 2 THEN 'sale' WHEN 3 THEN 'return' WHEN 4 THEN 'transfer_in' WHEN 5 THEN 'transfer_out'
            WHEN 6 THEN 'damaged_write_off' ELSE CASE WHEN l_orderkey % 2 = 0 THEN 'stock_adjustment_plus' ELSE 'stock_adjustment_minus' END END AS movement_type,
          CAST(CASE WHEN l_linenumber IN (2, 5) AND l_orderkey % 11 <> 0 THEN -l_quantity ELSE l_quantity END AS BIGINT) AS quantity,
          l_shipdate AS movement_ts, 'b' AS _batch_code
        FROM lineitem
    """,
    "marketing_raw": """
        SELECT event_id, CASE event_type WHEN 'view' THEN 'email_sent' WHEN 'click' THEN 'email_clicked' WHEN 'signup' THEN 'email_delivered' WHEN 'purchase' THEN 'email_opened' ELSE 'email_bounced' END AS event_type,
          ts AS event_ts, user_id, 'C' || CAST(user_id % 12 AS STRING) AS campaign_id,
          CASE WHEN event_type = 'click' AND event_id % 50 <> 0 THEN '/promo' END AS clicked_url, CASE WHEN event_type = 'error' THEN 'hard' END AS bounce_type, 'x' AS _smtp_response
        FROM events
    """,
    "search_raw": """
        SELECT p_partkey AS event_id, CASE WHEN p_partkey % 20 < 7 THEN NULL ELSE p_partkey % 150 END AS user_id,
          CASE WHEN p_partkey % 4 = 0 THEN ' ' || upper(p_name) || 'x' ELSE p_name END AS query_raw, p_name AS query_normalized, p_partkey % 4 = 0 AS had_typo,
          p_size AS num_results, CASE WHEN p_partkey % 3 = 0 THEN p_partkey END AS clicked_product_id,
          CASE WHEN p_size % 2 = 0 THEN '{"brand": "' || p_brand || '"}' END AS filters_applied_json
        FROM part
    """,
    "interactions_raw": """
        SELECT event_id, CASE event_type WHEN 'view' THEN 'quick_view' WHEN 'click' THEN 'add_to_cart' WHEN 'signup' THEN 'wishlist' WHEN 'purchase' THEN 'size_select' ELSE 'zoom' END AS event_type,
          ts AS event_ts, CASE WHEN event_id % 4 = 0 THEN NULL ELSE user_id END AS user_id, event_id % 200 AS product_id,
          CASE WHEN event_type = 'purchase' THEN 'M' END AS selected_size, CASE WHEN event_type = 'click' AND event_id % 25 <> 0 THEN 1 END AS quantity
        FROM events
    """,
}

# Every order is an abandoned cart as well; it holds none, one or two items.
CARTS = """
    SELECT CAST(o_orderkey AS STRING) AS cart_id, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_custkey END AS user_id,
      CASE WHEN o_orderkey % 4 = 0 THEN 'payment' ELSE 'shipping' END AS abandonment_step, o_totalprice AS cart_total_usd,
      filter(array(
        named_struct('product_id', o_custkey % 100, 'quantity', 1 + o_orderkey % 3, 'unit_price_usd', CAST(900 + o_custkey % 100 AS DOUBLE)),
        named_struct('product_id', o_orderkey % 100, 'quantity', CAST(1 AS BIGINT), 'unit_price_usd', CAST(900 + o_orderkey % 100 AS DOUBLE))
      ), (x, i) -> i < (o_orderkey % 9) div 3) AS items,
      o_orderkey % 12 = 0 AS cart_recovered, CASE WHEN o_orderkey % 12 = 0 THEN o_orderkey END AS recovered_order_id
    FROM orders
"""
TABLES = ("part", "customer", "orders", "lineitem", "events", "documents", "labels")


def register(spark: SparkSession, sf_dir: str, table: str) -> None:
    spark.read.parquet(f"{sf_dir}/{table}.parquet").createOrReplaceTempView(table)


def base_tables(name: str) -> set[str]:
    """The given tables an adapted dataset is made from."""
    return {table for table in TABLES if re.search(rf"(FROM|JOIN) {table}\b", _text(name))}


def view(spark: SparkSession, name: str) -> DataFrame:
    """One of the adapted datasets, such as ``orders_raw``, over the registered tables."""
    return spark.sql(_text(name))


def _text(name: str) -> str:
    return CARTS if name == "abandoned_carts_raw" else VIEWS[name]
