"""Gold tables against plain SQL joins, also with repeated, missing and hot keys."""

import random

import pytest

from shelfstack.plans import gold
from tests.conftest import rows

ORDERS = "order_id long, user_id long, order_date timestamp_ntz, status string, total_usd double"
LINES = "order_id long, product_id long, quantity long, unit_price_usd double, line_total_usd double"
PRODUCTS = "product_id long, model_name string, brand string, category string"
USERS = "user_id long, email string, first_name string, last_name string, loyalty_tier string"


def sample(spark, seed):
    """A third of the lines and orders share one key; some keys are NULL, repeated or unmatched."""
    from datetime import datetime, timedelta

    pick = random.Random(seed)
    statuses = ["delivered", "shipped", "cancelled", "chargeback", "returned", None]

    def key(n, hot):
        return pick.choice([hot, *[pick.choice([None, *range(n)]) for _ in range(2)]])

    start = datetime(2026, 1, 1)
    orders = [
        (key(40, 1), key(10, 2), start + timedelta(hours=pick.randrange(200)), pick.choice(statuses),
         pick.choice([None, round(pick.uniform(1, 500), 2)]))
        for _ in range(80)
    ]
    lines = [
        (key(40, 1), key(12, 3), pick.choice([None, 1, 2, 3]), pick.choice([None, round(pick.uniform(1, 90), 2)]),
         pick.choice([None, round(pick.uniform(1, 90), 2)]))
        for _ in range(150)
    ]
    products = [(i % 10, f"m{i % 3}", "b", pick.choice([None, "c"])) for i in range(15)]
    users = [(i % 7, pick.choice([None, f"e{i % 7}"]), "f", "l", "gold") for i in range(12)]
    for name, data, schema in (("o", orders, ORDERS), ("l", lines, LINES), ("p", products, PRODUCTS), ("u", users, USERS)):
        spark.createDataFrame(data, schema).createOrReplaceTempView(name)
    return [spark.table(t) for t in ("o", "l", "p", "u")]


@pytest.mark.parametrize("seed", range(3))
def test_daily_revenue_is_the_plain_join(spark, seed):
    orders, lines, _, _ = sample(spark, seed)
    expected = spark.sql("""
        SELECT to_date(o.order_date), count(DISTINCT o.order_id), cast(sum(cast(o.total_usd AS decimal(18,2))) AS double),
          cast(sum(cast(o.total_usd AS decimal(18,2))) AS double) / nullif(count(o.total_usd), 0), sum(l.quantity)
        FROM o LEFT JOIN l USING (order_id) WHERE status NOT IN ('cancelled', 'chargeback') GROUP BY 1""")
    assert rows(gold.daily_revenue(orders, lines)) == rows(expected)


@pytest.mark.parametrize("seed", range(3))
def test_exact_daily_revenue_counts_each_order_once(spark, seed):
    orders, lines, _, _ = sample(spark, seed)
    expected = spark.sql("""
        WITH items AS (SELECT order_id, sum(quantity) AS quantity FROM l GROUP BY 1)
        SELECT to_date(o.order_date), count(DISTINCT o.order_id), cast(sum(cast(o.total_usd AS decimal(18,2))) AS double),
          cast(sum(cast(o.total_usd AS decimal(18,2))) AS double) / nullif(count(o.total_usd), 0), sum(i.quantity)
        FROM o LEFT JOIN items i USING (order_id) WHERE status NOT IN ('cancelled', 'chargeback') GROUP BY 1""")
    assert rows(gold.daily_revenue(orders, lines, exact=True)) == rows(expected)


@pytest.mark.parametrize("seed", range(3))
def test_product_performance_is_the_plain_join(spark, seed):
    orders, lines, products, _ = sample(spark, seed)
    expected = spark.sql("""
        SELECT p.product_id, p.model_name, p.brand, p.category, sum(l.quantity),
          cast(sum(cast(l.line_total_usd AS decimal(18,2))) AS double), count(DISTINCT l.order_id),
          cast(sum(cast(l.unit_price_usd AS decimal(18,2))) AS double) / nullif(count(l.unit_price_usd), 0)
        FROM l JOIN p ON l.product_id = p.product_id JOIN o ON l.order_id = o.order_id
        WHERE o.status NOT IN ('cancelled', 'chargeback')
        GROUP BY p.product_id, p.model_name, p.brand, p.category""")
    assert rows(gold.product_performance(lines, products, orders)) == rows(expected)


@pytest.mark.parametrize("seed", range(3))
def test_customer_ltv_is_the_plain_join(spark, seed):
    orders, _, _, users = sample(spark, seed)
    expected = spark.sql("""
        SELECT u.user_id, u.email, u.first_name, u.last_name, u.loyalty_tier, count(DISTINCT o.order_id),
          cast(sum(cast(o.total_usd AS decimal(18,2))) AS double),
          cast(sum(cast(o.total_usd AS decimal(18,2))) AS double) / nullif(count(o.total_usd), 0),
          min(o.order_date), max(o.order_date), cast(extract(DAY FROM max(o.order_date) - min(o.order_date)) AS bigint)
        FROM o JOIN u ON o.user_id = u.user_id WHERE o.status NOT IN ('cancelled', 'chargeback')
        GROUP BY u.user_id, u.email, u.first_name, u.last_name, u.loyalty_tier""")
    assert rows(gold.customer_ltv(orders, users)) == rows(expected)


def test_orders_with_no_one_and_many_lines(spark):
    orders = spark.sql("""
        SELECT * FROM VALUES (1L, 'shipped', 10D), (2L, 'shipped', 20D), (3L, 'shipped', 40D), (4L, 'cancelled', 80D)
        AS t(order_id, status, total_usd)""").selectExpr("*", "timestamp_ntz '2026-01-01' AS order_date")
    lines = spark.sql("SELECT * FROM VALUES (2L, 1L), (3L, 1L), (3L, 2L), (3L, 5L), (4L, 9L) AS t(order_id, quantity)")
    plain = gold.daily_revenue(orders, lines).first()
    assert (plain.total_orders, plain.total_revenue, plain.total_items) == (3, 150.0, 9)
    assert plain.avg_order_value == 30.0
    exact = gold.daily_revenue(orders, lines, exact=True).first()
    assert (exact.total_orders, exact.total_revenue, exact.total_items) == (3, 70.0, 9)


def test_day_without_lines_has_no_items(spark):
    orders = spark.sql("SELECT 1L AS order_id, 'shipped' AS status, 10D AS total_usd, timestamp_ntz '2026-01-01' AS order_date")
    lines = spark.createDataFrame([], LINES)
    assert gold.daily_revenue(orders, lines).first().total_items is None


def test_order_of_reports(spark):
    orders, lines, products, users = sample(spark, 0)
    days = [r.order_date for r in gold.daily_revenue(orders, lines).collect()]
    assert days == sorted(days)
    for table, column in (
        (gold.product_performance(lines, products, orders), "total_revenue"), (gold.customer_ltv(orders, users), "total_spent"),
    ):
        got = [r[column] for r in table.collect()]
        known = [v for v in got if v is not None]
        assert got == [None] * (len(got) - len(known)) + sorted(known, reverse=True)


def test_tenure_in_full_days(spark):
    orders = spark.sql("""
        SELECT * FROM VALUES (1L, 1L, 'shipped', 1D, timestamp_ntz '2026-01-01 00:00:00'),
          (2L, 1L, 'shipped', 1D, timestamp_ntz '2026-01-02 02:00:00'), (3L, 2L, 'shipped', 1D, timestamp_ntz '2026-01-01 00:00:00')
        AS t(order_id, user_id, status, total_usd, order_date)""")
    users = spark.createDataFrame([(1, "a", "f", "l", "t"), (2, "b", "f", "l", "t")], USERS)
    assert rows(gold.customer_ltv(orders, users), "user_id", "days_as_customer") == [(1, 1), (2, 0)]


def test_product_name_variant(spark):
    orders, lines, products, _ = sample(spark, 0)
    assert "product_name" in gold.product_performance(lines, products, orders, product_name=True).columns
    assert "model_name" in gold.product_performance(lines, products, orders).columns


def test_funnel(spark):
    events = spark.createDataFrame(
        [("s1", "page_view"), ("s1", "page_view"), ("s1", "product_view"), ("s2", "page_view"), ("s3", "add_to_cart"),
         (None, "page_view"), ("s1", "other")],
        "session_id string, event_type string",
    )
    got = {r.step: (r.step_no, r.sessions, r.rate) for r in gold.funnel_analysis(events).collect()}
    assert got == {
        "page_view": (1, 2, 1.0), "product_view": (2, 1, 0.5), "add_to_cart": (3, 1, 0.5), "checkout": (4, 0, 0.0)
    }


def test_funnel_without_first_step(spark):
    events = spark.createDataFrame([("s1", "checkout")], "session_id string, event_type string")
    assert {r.rate for r in gold.funnel_analysis(events).collect()} == {None}


def test_campaigns_without_sends(spark):
    events = spark.createDataFrame([("c", "email_clicked")], "campaign_id string, event_type string")
    row = gold.campaign_performance(events).first()
    assert (row.sent, row.clicked, row.delivery_rate, row.click_rate) == (0, 1, None, None)


def test_conversion_without_interactions(spark):
    sold = spark.createDataFrame([(1, 4), (2, 1)], "product_id long, num_orders long")
    touched = spark.createDataFrame([(1,), (1,)], "product_id long")
    assert rows(gold.product_conversion(sold, touched)) == [(1, 4, 2, 2.0), (2, 1, 0, None)]


def test_funnel_in_order(spark):
    events = spark.createDataFrame(
        [
            # In order; each step before the one it needs; the second view of a page does not undo the first.
            ("a", 1, 1, "page_view"), ("a", 2, 2, "product_view"), ("a", 3, 3, "page_view"), ("a", 4, 4, "add_to_cart"), ("a", 5, 5, "checkout"),
            ("b", 1, 6, "checkout"), ("b", 2, 7, "add_to_cart"), ("b", 3, 8, "product_view"), ("b", 4, 9, "page_view"),
            # A step left out; equal stamps in the order of the ids; no stamp, no session.
            ("c", 1, 10, "page_view"), ("c", 2, 11, "add_to_cart"), ("c", 3, 12, "product_view"), ("c", 4, 13, "add_to_cart"),
            ("d", 1, 14, "page_view"), ("d", 1, 15, "product_view"), ("e", 1, 17, "page_view"), ("e", 1, 16, "product_view"),
            ("f", 1, 18, "page_view"), ("f", None, 19, "product_view"), (None, 2, 20, "page_view"),
        ],
        "session_id string, timestamp long, event_id long, event_type string")
    got = {r.step: (r.step_no, r.sessions, r.rate) for r in gold.funnel_in_order(events).collect()}
    assert got == {"page_view": (1, 6, 1.0), "product_view": (2, 3, 0.5), "add_to_cart": (3, 2, 2 / 6), "checkout": (4, 1, 1 / 6)}
    none = gold.funnel_in_order(events.filter("event_id < 0"))
    assert {(r.sessions, r.rate) for r in none.collect()} == {(0, None)}
