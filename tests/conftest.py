import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shelfstack.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    warehouse = tmp_path_factory.mktemp("warehouse")
    session = build_session(
        "tests", master="local[4]", shuffle_partitions=4,
        conf={
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.warehouse.dir": str(warehouse),
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df, *order):
    """Rows as tuples, sorted so that NULLs do not matter."""
    picked = df.select(*order) if order else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


@pytest.fixture
def products(spark):
    return spark.createDataFrame(
        [
            (1, "Runner", "A", "sneakers", 149.99, "running|casual", 1, 0, 50.0, "S1"),
            (2, "Boost", "B", "sneakers", 179.99, "running|boost", 1, 0, 60.0, "S2"),
            (3, "Retro", "C", "sneakers", -10.0, "retro|hype", 0, 1, 70.0, "S3"),
            (4, "Free", "C", "tees", 0.0, "x|y", 1, 0, 1.0, "S3"),
            (5, "Unpriced", "C", "tees", None, "x|y", 1, 0, 1.0, "S3"),
            (6, "Broken", "C", "tees", float("nan"), "x|y", 1, 0, 1.0, "S3"),
            (7, "Plain", "C", "tees", 5.0, None, None, 2, 1.0, "S3"),
            (8, "Single", "C", "tees", 5.0, "solo", 0, None, 1.0, "S3"),
        ],
        "product_id long, display_name string, brand string, category string, price_usd double, tags string, "
        "is_active int, is_hype_product int, _internal_cost_usd double, _supplier_id string",
    )


@pytest.fixture
def users(spark):
    return spark.createDataFrame(
        [
            (1, " Alice@Example.COM ", "Alice", "M", "gold", "+33 6 12", "h", "1.2.3.4", "f"),
            (2, "bob@test.com", "Bob", "S", None, "+33612345678", "h", "1.2.3.4", "f"),
            (3, "\t\n Carl@X.org \n", "Carl", "S", "silver", "0612", "h", "1.2.3.4", "f"),
            (4, None, "Dee", "S", "silver", None, "h", "1.2.3.4", "f"),
        ],
        "user_id long, email string, first_name string, last_name string, loyalty_tier string, phone string, "
        "_hashed_password string, _last_ip string, _device_fingerprint string",
    )


@pytest.fixture
def orders(spark):
    return spark.createDataFrame(
        [
            (1, 1, "2026-02-10", "delivered", 149.99, 149.99, 0.0, 0.0, 0.0, "SAVE10", "c", 0.1),
            (2, 2, "2026-02-11 10:00:00", "shipped", 180.99, 179.99, 0.0, 0.0, 0.0, None, "c", 0.2),
            (3, 1, "2026-02-12", "invalid_status", 50.0, 50.0, 0.0, 0.0, 0.0, None, "c", 0.9),
            (4, 1, "bad", "shipped", 50.0, 50.0, 0.0, 0.0, 0.0, None, "c", 0.9),
            (5, 1, None, "shipped", 50.0, 50.0, 0.0, 0.0, 0.0, None, "c", 0.9),
            (6, 1, "2026-02-30", "shipped", 50.0, 50.0, 0.0, 0.0, 0.0, None, "c", 0.9),
            (7, 1, "2026", "shipped", 50.0, 50.0, 0.0, 0.0, 0.0, None, "c", 0.9),
            (8, 1, "2026-02-12", None, 50.0, 50.0, 0.0, 0.0, 0.0, None, "c", 0.9),
            (9, 3, "2026-02-12", "cancelled", 50.005, 50.0, 0.0, 0.0, 0.0, None, "c", 0.9),
            (10, 3, "2026-02-12", "returned", None, 50.0, 0.0, 0.0, 0.0, None, "c", 0.9),
            (11, 3, "2026-02-12", "returned", float("nan"), 50.0, 0.0, 0.0, 0.0, None, "c", 0.9),
        ],
        "order_id long, user_id long, order_date string, status string, total_usd double, subtotal_usd double, "
        "discount_amount_usd double, shipping_cost_usd double, tax_usd double, coupon_code string, "
        "_stripe_charge_id string, _fraud_score double",
    )


@pytest.fixture
def lines(spark):
    return spark.createDataFrame(
        [
            (1, 1, 1, 2, 10.0, 20.0, "W"),
            (2, 1, 2, 1, 10.0, 10.02, "W"),
            (3, 2, 2, 0, 10.0, 0.0, "W"),
            (4, 2, 2, -1, 10.0, -10.0, "W"),
            (5, 2, 2, None, 10.0, 10.0, "W"),
            (6, 2, 2, 1, None, 10.0, "W"),
            (7, 2, 2, 3, 10.0, 30.01, "W"),
            (8, 999, 1, 1, 5.0, 5.0, "W"),
            (9, 2, 1, 1, 5.0, float("nan"), "W"),
        ],
        "line_item_id long, order_id long, product_id long, quantity long, unit_price_usd double, "
        "line_total_usd double, _warehouse_id string",
    )
