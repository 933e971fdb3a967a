"""Bronze to Silver: cleaned dimensions and facts.

Every function takes the Bronze frame and returns the Silver frame; optional columns may be missing.
All but the referential check of the order lines are one pass without a shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfstack.functions.dates import is_ambiguous, parse_timestamp
from shelfstack.functions.text import clean_email, join_tags, phone_country
from shelfstack.functions.values import flag, is_number, signed_quantity
from shelfstack.operators.columns import drop_internal, fill, has_columns
from shelfstack.operators.joins import with_parent
from shelfstack.operators.quality import (
    ORDER_AMOUNTS,
    inventory_sign_rules,
    line_total_gap,
    order_total_gap,
    payment_sign_rules,
)
from shelfstack.operators.ranking import number_events
from shelfstack.settings import AMOUNT_TOLERANCE, MAX_RATING, MIN_RATING, ORDER_STATUSES
from shelfstack.sources.files import apply_types
from shelfstack.sources.schemas import column_types

PRODUCT_FLAGS = ("is_active", "is_hype_product")


def _apply(df: DataFrame, changes: Mapping[str, Column]) -> DataFrame:
    return df.withColumns({name: col for name, col in changes.items() if name in df.columns})


def dim_products(bronze: DataFrame) -> DataFrame:
    """Sellable products: positive price, ``a, b`` tags, real booleans."""
    df = drop_internal(bronze)
    df = df.filter((F.col("price_usd") > 0) & is_number(df, "price_usd"))
    flags = {name: flag(F.col(name)) for name in PRODUCT_FLAGS}
    return _apply(df, {"tags": join_tags(F.col("tags")), **flags})


def dim_users(bronze: DataFrame, max_phone_digits: int | None = None) -> DataFrame:
    """Users without internal columns; of the phone only the leading country part stays."""
    df = fill(drop_internal(bronze), {"loyalty_tier": "none"})
    return _apply(df, {
        "email": clean_email(F.col("email")),
        "phone": phone_country(F.col("phone"), max_phone_digits),
    })


def fct_orders(bronze: DataFrame, day_first: bool | None = None) -> DataFrame:
    """Orders with a known status and a readable date; wrong totals are counted, not dropped.

    ``day_first`` tells how to read slashed dates (``dates.day_first`` counts what the column itself says).
    """
    df = drop_internal(bronze).filter(F.col("status").isin(*ORDER_STATUSES))
    df = df.withColumn("order_date", parse_timestamp(F.col("order_date"), day_first))
    return fill(df.filter(F.col("order_date").isNotNull()), {"coupon_code": ""})


def fct_order_lines(bronze: DataFrame, orders: DataFrame | None = None) -> DataFrame:
    """Lines with a positive quantity and a total that fits; with ``orders`` only lines of those."""
    df = drop_internal(bronze)
    df = df.filter((F.col("quantity") > 0) & is_number(df, "quantity"))
    df = df.filter(line_total_gap(df) <= AMOUNT_TOLERANCE)
    return with_parent(df, orders, "order_id") if orders is not None else df


def dim_reviews(bronze: DataFrame) -> DataFrame:
    """Reviews with a rating in range."""
    return drop_internal(bronze).filter(F.col("rating").between(MIN_RATING, MAX_RATING))


def fct_reviews(bronze: DataFrame, moderation: tuple[str, ...] = ("approved",)) -> DataFrame:
    """Reviews with a rating in range that passed moderation."""
    return dim_reviews(bronze).filter(F.col("moderation_status").isin(*moderation))


def fct_clickstream(bronze: DataFrame, ts: str | None = None) -> DataFrame:
    """Human traffic without addresses; an unknown bot flag counts as human.

    With ``ts`` every event has its place in its session as well (``event_seq``), which takes a shuffle.
    """
    df = drop_internal(bronze).drop("ip_address")
    df = df.filter(~F.coalesce(F.col("is_bot"), F.lit(False)))
    df = df.withColumn("is_anonymous", F.col("user_id").isNull())
    return number_events(df, "session_id", ts, "event_id") if ts else df


def fct_payments(bronze: DataFrame) -> DataFrame:
    """Transactions with documented types; what does not fit its type is NULL."""
    return apply_types(drop_internal(bronze), column_types("payments"))


def fct_inventory(bronze: DataFrame) -> DataFrame:
    """Stock movements with the quantity signed by the movement type."""
    df = apply_types(drop_internal(bronze), column_types("inventory"))
    return df.withColumn("signed_quantity", signed_quantity(F.col("movement_type"), F.col("quantity")))


def product_rules(df: DataFrame) -> dict[str, Column]:
    return {"price_not_positive": ~F.coalesce((F.col("price_usd") > 0) & is_number(df, "price_usd"), F.lit(False))}


def order_rules(df: DataFrame, day_first: bool | None = None) -> dict[str, Column]:
    known = F.coalesce(F.col("status").isin(*ORDER_STATUSES), F.lit(False))
    dated = parse_timestamp(F.col("order_date"), day_first).isNotNull()
    unclear = known & ~dated & is_ambiguous(F.col("order_date"))  # part of the unreadable ones
    rules = {"unknown_status": ~known, "unreadable_date": known & ~dated, "ambiguous_date": unclear}
    if has_columns(df, *ORDER_AMOUNTS):
        rules["inconsistent_total"] = known & dated & (order_total_gap(df) > AMOUNT_TOLERANCE)
    return rules


def line_rules(df: DataFrame) -> dict[str, Column]:
    positive = F.coalesce((F.col("quantity") > 0) & is_number(df, "quantity"), F.lit(False))
    gap = line_total_gap(df)
    return {
        "quantity_not_positive": ~positive,
        "inconsistent_total": positive & (gap > AMOUNT_TOLERANCE),
        "missing_amount": positive & gap.isNull(),
    }


def review_rules(df: DataFrame) -> dict[str, Column]:
    return {"rating_out_of_range": ~F.coalesce(F.col("rating").between(MIN_RATING, MAX_RATING), F.lit(False))}


def clickstream_rules(df: DataFrame) -> dict[str, Column]:
    return {"bot": F.coalesce(F.col("is_bot"), F.lit(False)), "anonymous": F.col("user_id").isNull()}


# Rules counted on the Bronze rows while a Silver table is written.
RULES = {
    "dim_products": product_rules,
    "fct_orders": order_rules,
    "fct_order_lines": line_rules,
    "fct_reviews": review_rules,
    "fct_clickstream": clickstream_rules,
    "fct_payments": lambda df: payment_sign_rules(),
    "fct_inventory": lambda df: inventory_sign_rules(),
}

BUILDERS = {
    "dim_products": dim_products,
    "dim_users": dim_users,
    "fct_orders": fct_orders,
    "fct_order_lines": fct_order_lines,
    "fct_reviews": fct_reviews,
    "fct_clickstream": fct_clickstream,
    "fct_payments": fct_payments,
    "fct_inventory": fct_inventory,
}
