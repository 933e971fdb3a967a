"""The datasets: where each one lies, its format, its tables and keys."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Dataset:
    name: str
    format: str  # csv, jsonl or parquet
    key: str  # path below the raw root
    bronze: str
    silver: str | None
    primary_key: str
    order_by: str | None = None  # newest row per key, for upserts
    partition_by: str | None = None
    core: bool = True


# Names and paths of the source files and tables.
DATASETS = (
    Dataset("products", "csv", "catalog/products.csv", "products", "dim_products", "product_id", "created_at"),
    Dataset("users", "csv", "users/users.csv", "users", "dim_users", "user_id", "registration_date"),
    Dataset("orders", "csv", "orders/orders.csv", "orders", "fct_orders", "order_id", "order_date"),
    Dataset("order_line_items", "csv", "order_line_items/order_line_items.csv", "order_line_items",
            "fct_order_lines", "line_item_id"),
    Dataset("reviews", "jsonl", "reviews/reviews.jsonl", "reviews", "fct_reviews", "review_id"),
    Dataset("clickstream", "parquet", "clickstream/", "clickstream", "fct_clickstream", "event_id",
            "timestamp", partition_by="dt"),
    Dataset("payments", "csv", "payments/payment_transactions.csv", "payments", "fct_payments",
            "transaction_id", core=False),
    Dataset("inventory", "csv", "inventory/inventory_movements.csv", "inventory", "fct_inventory",
            "movement_id", "timestamp", core=False),
    Dataset("marketing", "jsonl", "marketing/marketing_events.jsonl", "marketing_events", None,
            "event_id", "timestamp", core=False),
    Dataset("search_events", "jsonl", "search_events/search_events.jsonl", "search_events", None,
            "event_id", "timestamp", core=False),
    Dataset("abandoned_carts", "jsonl", "abandoned_carts/abandoned_carts.jsonl", "abandoned_carts", None,
            "cart_id", core=False),
    Dataset("interactions", "parquet", "interactions/", "interactions", None, "event_id", "timestamp",
            core=False),
)

BY_NAME = {dataset.name: dataset for dataset in DATASETS}


def datasets(bonus: bool = False) -> tuple[Dataset, ...]:
    """The six core datasets, or all twelve."""
    return tuple(d for d in DATASETS if d.core or bonus)


# Child dataset and column (with a dot: a field of the items of an array), and the dataset and key they point to.
RELATIONS = (
    ("orders", "user_id", "users", "user_id"),
    ("order_line_items", "order_id", "orders", "order_id"),
    ("order_line_items", "product_id", "products", "product_id"),
    ("payments", "order_id", "orders", "order_id"),
    ("clickstream", "user_id", "users", "user_id"),
    ("reviews", "user_id", "users", "user_id"),
    ("reviews", "product_id", "products", "product_id"),
    ("marketing", "user_id", "users", "user_id"),
    ("search_events", "user_id", "users", "user_id"),
    ("search_events", "clicked_product_id", "products", "product_id"),
    ("interactions", "user_id", "users", "user_id"),
    ("interactions", "product_id", "products", "product_id"),
    ("inventory", "product_id", "products", "product_id"),
    ("abandoned_carts", "user_id", "users", "user_id"),
    ("abandoned_carts", "recovered_order_id", "orders", "order_id"),
    ("abandoned_carts", "items.product_id", "products", "product_id"),
)
