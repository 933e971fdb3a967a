from datetime import datetime

import pytest
from pyspark.sql import functions as F

from shelfstack.operators import columns
from shelfstack.plans import silver
from tests.conftest import rows


def test_drop_internal(spark, users):
    assert columns.drop_internal(users).columns == [
        "user_id", "email", "first_name", "last_name", "loyalty_tier", "phone"
    ]
    plain = spark.createDataFrame([], "a int, b string")
    assert columns.drop_internal(plain).columns == ["a", "b"]
    assert columns.drop_internal(spark.createDataFrame([], "_a int, _b string")).columns == []


def test_products_keep_positive_prices(products):
    df = silver.dim_products(products)
    assert rows(df, "product_id") == [(1,), (2,), (7,), (8,)]
    assert not columns.internal_columns(df)


def test_products_tags_and_flags(products):
    got = {r.product_id: r for r in silver.dim_products(products).collect()}
    assert got[1].tags == "running, casual" and got[2].tags == "running, boost"
    assert got[7].tags is None and got[8].tags == "solo"
    assert (got[1].is_active, got[1].is_hype_product) == (True, False)
    # NULL counts as false, any other number than 0 as true
    assert (got[7].is_active, got[7].is_hype_product) == (False, True)
    assert (got[8].is_active, got[8].is_hype_product) == (False, False)


def test_products_without_optional_columns(spark):
    df = spark.createDataFrame([(1, 2.0)], "product_id long, price_usd double")
    assert rows(silver.dim_products(df)) == [(1, 2.0)]


def test_empty_products(products):
    assert silver.dim_products(products.limit(0)).count() == 0


def test_users(users):
    got = {r.user_id: r for r in silver.dim_users(users).collect()}
    assert [got[i].email for i in (1, 2, 3, 4)] == ["alice@example.com", "bob@test.com", "carl@x.org", None]
    assert [got[i].loyalty_tier for i in (1, 2, 3)] == ["gold", "none", "silver"]
    assert [got[i].phone for i in (1, 2, 3, 4)] == ["+33", "+33612345678", None, None]
    assert not {"_hashed_password", "_last_ip", "_device_fingerprint"} & set(silver.dim_users(users).columns)
    short = {r.user_id: r.phone for r in silver.dim_users(users, max_phone_digits=3).collect()}
    assert short == {1: "+33", 2: "+336", 3: None, 4: None}


def test_users_without_phone(users):
    assert "phone" not in silver.dim_users(users.drop("phone")).columns


def test_orders(orders):
    df = silver.fct_orders(orders)
    got = {r.order_id: r for r in df.collect()}
    assert set(got) == {1, 2, 9, 10, 11}
    assert got[1].order_date == datetime(2026, 2, 10) and got[2].order_date == datetime(2026, 2, 11, 10)
    assert got[1].coupon_code == "SAVE10" and got[2].coupon_code == ""
    assert dict(df.dtypes)["order_date"] == "timestamp_ntz"


def test_orders_without_amounts(orders):
    small = orders.select("order_id", "order_date", "status")
    assert set(silver.order_rules(small)) == {"unknown_status", "unreadable_date", "ambiguous_date"}
    assert silver.fct_orders(small).count() == 5


def test_order_rules(orders):
    rules = silver.order_rules(orders)
    counted = orders.agg(*[F.count_if(c).alias(n) for n, c in rules.items()]).first().asDict()
    # order 2 is off by a dollar; 9 is within the tolerance; NULL and NaN totals are not counted
    assert counted == {"unknown_status": 2, "unreadable_date": 4, "ambiguous_date": 0, "inconsistent_total": 1}


def test_lines(lines):
    assert rows(silver.fct_order_lines(lines), "line_item_id") == [(1,), (8,)]


def test_line_boundary_is_a_double_comparison(lines):
    # 30.01 - 30.00 is a little more than 0.01 in binary floating point
    assert (7,) not in rows(silver.fct_order_lines(lines), "line_item_id")


def test_line_rules(lines):
    rules = silver.line_rules(lines)
    counted = lines.agg(*[F.count_if(c).alias(n) for n, c in rules.items()]).first().asDict()
    assert counted == {"quantity_not_positive": 3, "inconsistent_total": 2, "missing_amount": 2}
    kept = silver.fct_order_lines(lines).count()
    assert kept == lines.count() - sum(counted.values())


def test_lines_with_referential_check(lines, orders):
    df = silver.fct_order_lines(lines, silver.fct_orders(orders))
    assert rows(df, "line_item_id") == [(1,)]
    assert df.columns == silver.fct_order_lines(lines).columns


def test_reviews(spark):
    raw = spark.createDataFrame(
        [(1, 0, "approved"), (2, 1, "approved"), (3, 5, "pending"), (4, 6, "approved"), (5, None, "approved"),
         (6, 4, None), (7, 5, "rejected")],
        "review_id long, rating long, moderation_status string",
    ).withColumn("_sentiment_raw", F.lit(0.5))
    assert rows(silver.dim_reviews(raw), "review_id") == [(2,), (3,), (6,), (7,)]
    assert rows(silver.fct_reviews(raw), "review_id") == [(2,)]
    assert rows(silver.fct_reviews(raw, ("approved", "pending")), "review_id") == [(2,), (3,)]


def test_clickstream(spark):
    raw = spark.createDataFrame(
        [("a", 1, True, "ip"), ("b", None, False, "ip"), ("c", 2, None, "ip")],
        "event_id string, user_id long, is_bot boolean, ip_address string",
    )
    df = silver.fct_clickstream(raw)
    assert "ip_address" not in df.columns
    assert rows(df, "event_id", "is_anonymous") == [("b", True), ("c", False)]


def test_payments_types(spark):
    raw = spark.createDataFrame(
        [("1", "2.0", "-5.5", "refund", "x"), ("x", "7", "abc", "charge", "y")],
        "transaction_id string, order_id string, amount_usd string, transaction_type string, _card_brand string",
    )
    df = silver.fct_payments(raw)
    assert dict(df.dtypes) == {
        "transaction_id": "bigint", "order_id": "bigint", "amount_usd": "double", "transaction_type": "string"
    }
    assert rows(df, "transaction_id", "order_id", "amount_usd") == [(1, 2, -5.5), (None, 7, None)]


@pytest.mark.parametrize("kind,quantity,signed", [
    ("sale", 3, -3), ("sale", -3, -3), ("return", 3, 3), ("return", -3, 3), ("transfer_out", 2, -2),
    ("damaged_write_off", 2, -2), ("stock_adjustment_minus", 2, -2), ("stock_adjustment_plus", 2, 2),
    ("transfer_in", 2, 2), ("purchase_order_received", 2, 2), (None, 2, 2), ("sale", None, None),
])
def test_inventory_sign(spark, kind, quantity, signed):
    raw = spark.createDataFrame([(1, kind, quantity)], "product_id long, movement_type string, quantity long")
    assert silver.fct_inventory(raw).first().signed_quantity == signed
