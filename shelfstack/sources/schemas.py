"""Documented columns of the twelve datasets, used to cast by name after a read.

Files hold more columns than these; the others keep the type they were read with.
"""

from __future__ import annotations

# Column names and types of the source data, "_" marks internal columns.
DOCUMENTED: dict[str, dict[str, str]] = {
    "products": {
        "product_id": "bigint", "product_uuid": "string", "brand": "string", "model_name": "string",
        "colorway": "string", "category": "string", "subcategory": "string", "slug": "string",
        "display_name": "string", "price_usd": "double", "available_sizes_json": "string",
        "weight_grams": "bigint", "is_active": "boolean", "is_hype_product": "boolean",
        "created_at": "timestamp_ntz", "tags": "string", "_internal_cost_usd": "double",
        "_supplier_id": "string", "_warehouse_location": "string", "_internal_cost_code": "string",
    },
    "users": {
        "user_id": "bigint", "user_uuid": "string", "email": "string", "first_name": "string",
        "last_name": "string", "phone": "string", "gender": "string", "date_of_birth": "date",
        "country_code": "string", "country_name": "string", "city": "string",
        "address_line_1": "string", "address_line_2": "string", "postal_code": "string",
        "timezone": "string", "registration_date": "date", "is_verified": "boolean",
        "loyalty_tier": "string", "newsletter_opt_in": "boolean", "preferred_language": "string",
        "_hashed_password": "string", "_ga_client_id": "string", "_fbp": "string",
        "_device_fingerprint": "string", "_last_ip": "string", "_failed_login_count": "bigint",
        "_account_flags": "bigint", "_internal_segment_id": "string",
    },
    "orders": {
        "order_id": "bigint", "order_uuid": "string", "user_id": "bigint", "order_date": "date",
        "status": "string", "subtotal_usd": "double", "shipping_cost_usd": "double",
        "tax_usd": "double", "total_usd": "double", "coupon_code": "string",
        "discount_amount_usd": "double", "payment_method": "string", "shipping_method": "string",
        "_stripe_charge_id": "string", "_paypal_txn_id": "string", "_internal_channel": "string",
        "_fraud_score": "double", "_fulfillment_warehouse": "string", "_ab_test_variant": "string",
    },
    "order_line_items": {
        "line_item_id": "bigint", "order_id": "bigint", "product_id": "bigint",
        "selected_size": "string", "colorway": "string", "quantity": "bigint",
        "unit_price_usd": "double", "line_total_usd": "double", "_warehouse_id": "string",
        "_internal_batch_code": "string", "_pick_slot": "string",
    },
    "reviews": {
        "review_id": "bigint", "product_id": "bigint", "user_id": "bigint", "rating": "bigint",
        "title": "string", "body": "string", "verified_purchase": "boolean",
        "moderation_status": "string", "helpful_votes": "bigint", "_sentiment_raw": "double",
        "_toxicity_score": "double", "_moderation_score": "double", "_language_detected": "string",
        "_review_source": "string",
    },
    "clickstream": {
        "event_id": "string", "event_type": "string", "timestamp": "timestamp_ntz",
        "user_id": "bigint", "session_id": "string", "page_url": "string", "page_path": "string",
        "page_type": "string", "referrer_url": "string", "referrer_source": "string",
        "user_agent_raw": "string", "ip_address": "string", "viewport_width": "bigint",
        "viewport_height": "bigint", "is_bot": "boolean", "_ga_client_id": "string",
        "_gtm_container_id": "string", "_dom_interactive_ms": "double", "_dom_complete_ms": "double",
        "_ttfb_ms": "double", "_connection_type": "string", "_js_heap_size_mb": "double",
        "_consent_string": "string",
    },
    "payments": {
        "transaction_id": "bigint", "transaction_uuid": "string", "order_id": "bigint",
        "user_id": "bigint", "amount_usd": "double", "transaction_type": "string",
        "status": "string", "risk_score": "double", "_card_brand": "string",
        "_card_last_four": "string", "_3ds_result": "string",
    },
    "inventory": {
        "movement_id": "bigint", "product_id": "bigint", "warehouse_id": "string",
        "movement_type": "string", "quantity": "bigint", "timestamp": "timestamp_ntz",
        "reference_id": "string", "_batch_code": "string", "_po_number": "string",
    },
    "marketing": {
        "event_id": "string", "event_type": "string", "timestamp": "timestamp_ntz",
        "user_id": "bigint", "campaign_id": "string", "campaign_name": "string",
        "campaign_type": "string", "subject_line": "string", "clicked_url": "string",
        "bounce_type": "string", "_smtp_response": "string", "_delivery_time_ms": "double",
    },
    "search_events": {
        "event_id": "string", "timestamp": "timestamp_ntz", "user_id": "bigint",
        "query_raw": "string", "query_normalized": "string", "had_typo": "boolean",
        "num_results": "bigint", "clicked_product_id": "bigint", "filters_applied_json": "string",
    },
    "abandoned_carts": {
        "cart_id": "string", "user_id": "bigint", "abandonment_step": "string",
        "cart_total_usd": "double",
        "items": "array<struct<product_id:bigint,quantity:bigint,unit_price_usd:double>>",
        "recovery_email_sent": "boolean", "cart_recovered": "boolean", "recovered_order_id": "bigint",
    },
    "interactions": {
        "event_id": "string", "event_type": "string", "timestamp": "timestamp_ntz",
        "user_id": "bigint", "product_id": "bigint", "selected_size": "string", "quantity": "bigint",
    },
}

TEMPORAL_TYPES = ("date", "timestamp_ntz")


def column_types(dataset: str, temporal: bool = True) -> dict[str, str]:
    """Documented types; with ``temporal=False`` dates and stamps stay text, as in a CSV load."""
    return {
        name: "string" if kind in TEMPORAL_TYPES and not temporal else kind
        for name, kind in DOCUMENTED[dataset].items()
    }
