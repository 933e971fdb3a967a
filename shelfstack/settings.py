"""Names and rule values used across the layers."""

from __future__ import annotations

from dataclasses import dataclass

# The words a CSV reader takes for "no value".
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
)

# The domains of the source data.
ORDER_STATUSES = ("delivered", "shipped", "processing", "returned", "cancelled", "chargeback")
NON_REVENUE_STATUSES = ("cancelled", "chargeback")
FUNNEL_STEPS = ("page_view", "product_view", "add_to_cart", "checkout")
EMAIL_EVENTS = ("email_sent", "email_delivered", "email_opened", "email_clicked", "email_bounced")
MODERATION_STATUSES = ("approved", "pending", "rejected")
OUTGOING_MOVEMENTS = ("sale", "transfer_out", "damaged_write_off", "stock_adjustment_minus")
MIN_RATING, MAX_RATING = 1, 5

MODES = ("replace", "append", "upsert")

# Largest difference, in dollars, between a stored and a recomputed amount.
AMOUNT_TOLERANCE = 0.01


@dataclass(frozen=True)
class Settings:
    """Where one run reads its files and which databases it fills."""

    raw_root: str = "raw"
    bronze: str = "bronze"
    silver: str = "silver"
    gold: str = "gold"
    na_tokens: tuple[str, ...] = NA_TOKENS
    # Columns in which a token such as "NA" is a real value (country codes).
    na_exempt: tuple[str, ...] = ()
    multiline_csv: bool = False
    # Off: Parquet columns are those of one file, and not every footer is read first.
    merge_parquet_schema: bool = True
    # Bronze column that keeps what does not fit its type or has no column; None drops it.
    rescue: str | None = "_rescued"
    # "replace" builds every table anew; "append" and "upsert" load changes (plans/incremental.py).
    mode: str = "replace"
    check_order_lines_ri: bool = False
    exact_revenue: bool = False
