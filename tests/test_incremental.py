"""Runs that load changes give the tables of a run over everything."""

import pytest
from pyspark.sql import functions as F

from shelfstack.plans import incremental, layers
from shelfstack.settings import Settings
from shelfstack.sinks import tables as sinks
from shelfstack.sinks.upsert import changed_rows, latest_per_key, replace_keys
from tests.conftest import rows

GOLD = ("daily_revenue", "product_performance", "customer_ltv")
SILVER = ("dim_products", "dim_users", "fct_orders", "fct_order_lines")
PATHS = {
    "products": "catalog/products.csv", "users": "users/users.csv", "orders": "orders/orders.csv",
    "order_line_items": "order_line_items/order_line_items.csv",
}


def write_files(root, frames):
    for name, frame in frames.items():
        if name in PATHS:
            sinks.write_csv(frame, f"{root}/{PATHS[name]}")
    sinks.write_jsonl(frames["reviews"], f"{root}/reviews/reviews.jsonl")
    sinks.write_parquet(frames["clickstream"], f"{root}/clickstream/", partition_by="dt")


@pytest.fixture
def frames(spark, products, users, orders, lines):
    reviews = spark.createDataFrame([(1, 1, 1, 5, "approved"), (2, 2, 1, 4, "pending")], "review_id long, product_id long, user_id long, rating long, moderation_status string")
    clicks = spark.createDataFrame(
        [("a", "page_view", 1, False, "2024-01-01"), ("b", "checkout", None, None, "2024-01-02")],
        "event_id string, event_type string, user_id long, is_bot boolean, dt string")
    return {
        "products": products.withColumn("model_name", F.col("display_name")), "users": users, "orders": orders,
        "order_line_items": lines, "reviews": reviews, "clickstream": clicks}


def settings_of(name, root, **more):
    return Settings(raw_root=str(root), bronze=f"{name}_b", silver=f"{name}_s", gold=f"{name}_g", multiline_csv=True, **more)


def contents(spark, settings):
    found = {t: spark.table(f"{settings.gold}.{t}") for t in GOLD} | {t: spark.table(f"{settings.silver}.{t}") for t in SILVER}
    return {t: rows(df, *sorted(df.columns)) for t, df in found.items()}


CHANGES = {
    # A new total, a status that leaves Silver, one that enters it, another day and customer, a new order, one as it was.
    "orders": [
        (1, 1, "2026-02-10", "delivered", 99.0), (2, 2, "2026-02-11", "unheard_of", 180.99), (3, 1, "2026-02-12", "shipped", 50.0),
        (9, 2, "2026-03-01", "shipped", 50.005), (20, 3, "2026-03-01", "shipped", 7.0), (8, 1, "2026-02-12", None, 50.0)],
    "lines": [(1, 1, 1, 3, 10.0, 30.0), (2, 1, 3, 1, 10.0, 10.0), (30, 20, 2, 1, 5.0, 5.0), (31, 9, 1, 1, 5.0, 5.0)],
}


def changed(spark, frames):
    orders = spark.createDataFrame(CHANGES["orders"], "order_id long, user_id long, order_date string, status string, total_usd double")
    lines = spark.createDataFrame(
        CHANGES["lines"], "line_item_id long, order_id long, product_id long, quantity long, unit_price_usd double, line_total_usd double")
    fill = lambda df, like: df.select(*[df[c] if c in df.columns else F.lit(None).cast(like.schema[c].dataType).alias(c) for c in like.columns])
    return {
        "orders": fill(orders, frames["orders"]), "order_line_items": fill(lines, frames["order_line_items"]),
        "products": frames["products"].filter("product_id = 3").withColumn("price_usd", F.lit(20.0)).unionByName(frames["products"].filter("product_id = 1")),
        "users": frames["users"].filter("user_id = 3").withColumn("loyalty_tier", F.lit("gold")),
        "reviews": frames["reviews"].limit(1), "clickstream": frames["clickstream"].filter("event_id = 'b'").withColumn("is_bot", F.lit(True))}


def merged(old, new, key):
    return old.join(new.select(key), key, "left_anti").unionByName(new)


KEYS = {"products": "product_id", "users": "user_id", "orders": "order_id", "order_line_items": "line_item_id", "reviews": "review_id", "clickstream": "event_id"}


def test_upserts_give_what_a_whole_run_gives_even_if_one_died(spark, frames, tmp_path, monkeypatch):
    name, checked = "up", True
    write_files(tmp_path / "first", frames)
    delta = changed(spark, frames)
    write_files(tmp_path / "second", delta)
    write_files(tmp_path / "all", {n: merged(frames[n], delta[n], KEYS[n]) for n in frames})

    first = settings_of(name, tmp_path / "first", mode="upsert", check_order_lines_ri=checked)
    layers.run(spark, first)  # nothing is there yet, so everything is built
    before = contents(spark, first)
    layers.run(spark, first)  # the same files again change nothing
    assert contents(spark, first) == before

    second = settings_of(name, tmp_path / "second", mode="upsert", check_order_lines_ri=checked)
    audit = {(r.step, r.table_name): r for r in layers.run(spark, second, "extract").collect()}
    with monkeypatch.context() as patched:
        patched.setattr(incremental, "gold_changes", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            layers.run(spark, second)  # Bronze and Silver are done by now
    audit |= {(r.step, r.table_name): r for r in layers.run(spark, second, "gold").collect()}
    whole = settings_of(f"{name}_all", tmp_path / "all", check_order_lines_ri=checked)
    layers.run(spark, whole)
    got, want = contents(spark, second), contents(spark, whole)
    for table in want:
        assert got[table] == want[table], table
    # Product 1 is as it was and no change.
    assert audit["extract", "orders"].rows_out == 6 and audit["extract", "products"].rows_out == 1
    # Days 10, 11 and 12 February and 1 March; the last is new, the second is gone.
    assert audit["gold", "daily_revenue"].rows_out == 3
    assert not [t.name for t in spark.catalog.listTables(second.bronze) + spark.catalog.listTables(second.gold) if "__" in t.name]
    assert rows(spark.table(f"{second.silver}.fct_orders"), "order_id") == rows(spark.table(f"{whole.silver}.fct_orders"), "order_id")


def test_appended_files(spark, frames, tmp_path):
    write_files(tmp_path / "first", {**frames, "orders": frames["orders"].filter("order_id < 4"), "order_line_items": frames["order_line_items"].filter("order_id < 2")})
    empty = {n: f.limit(0) for n, f in frames.items()}
    more = {**empty, "orders": frames["orders"].filter("order_id >= 4"), "order_line_items": frames["order_line_items"].filter("order_id >= 2")}
    for n, f in more.items():
        if n in PATHS:
            sinks.write_csv(f.coalesce(1), f"{tmp_path}/second/{PATHS[n]}")
    sinks.write_jsonl(frames["reviews"].limit(1), f"{tmp_path}/second/reviews/reviews.jsonl")
    sinks.write_parquet(frames["clickstream"].limit(1), f"{tmp_path}/second/clickstream/", partition_by="dt")
    write_files(tmp_path / "all", frames)
    layers.run(spark, settings_of("app", tmp_path / "first"))
    layers.run(spark, settings_of("app", tmp_path / "second", mode="append"))
    layers.run(spark, settings_of("app_all", tmp_path / "all"))
    got, want = contents(spark, settings_of("app", "")), contents(spark, settings_of("app_all", ""))
    assert got == want
    assert spark.table("app_b.reviews").count() == 3


def test_untouched_groups_are_not_computed_again(spark, frames, tmp_path):
    write_files(tmp_path / "first", frames)
    settings = settings_of("touch", tmp_path / "first", mode="upsert")
    layers.run(spark, settings)
    write_files(tmp_path / "second", {**{n: f.limit(1) for n, f in frames.items()}, "orders": frames["orders"].filter("order_id = 1").withColumn("total_usd", F.lit(1.0))})
    second = settings_of("touch", tmp_path / "second", mode="upsert")
    layers.run(spark, second, "extract")
    layers.run(spark, second, "transform")
    groups = incremental.touched_groups(spark, second)
    assert [str(r[0]) for r in groups["daily_revenue"].collect()] == ["2026-02-10"]
    assert rows(groups["customer_ltv"]) == [(1,)]
    assert rows(groups["product_performance"]) == [(1,)]  # its line with product 2 has a wrong total


def test_unknown_mode(spark):
    with pytest.raises(ValueError, match="mode"):
        layers.run(spark, Settings(mode="merge"))


def test_changed_rows(spark):
    kind = "id long, v string, m map<string,string>"
    old = spark.createDataFrame([(1, "a", {"x": "1", "y": "2"}), (2, "b", None), (None, "n", None)], kind)
    new = spark.createDataFrame([(1, "a", {"y": "2", "x": "1"}), (2, "B", None), (3, "c", {"q": "1"}), (None, "n", None), (None, "o", None), (None, "o", None)], kind)
    assert rows(changed_rows(old, new, ["id"])) == [(2, "B", None), (3, "c", {"q": "1"}), (None, "o", None)]
    assert rows(changed_rows(old, new.drop("m"), ["id"])) == [(1, "a"), (2, "B"), (3, "c"), (None, "o")]
    assert rows(changed_rows(old.drop("m"), new, ["id"]), "id") == [(1,), (2,), (3,), (None,)]
    copies = spark.createDataFrame([(1, "a", {"b": "1"}), (1, "a", {"c": "1"}), (1, "a", None)], kind)
    assert rows(latest_per_key(copies, ["id"])) == [(1, "a", {"c": "1"})]


def test_replaced_keys_of_partitions(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS swap")
    frame = lambda *r: spark.createDataFrame(r, "id long, v string, day string")
    sinks.save_table(frame((1, "a", "d1"), (2, "b", "d1"), (3, "c", "d2"), (None, "n", None), (4, "d", None)), "swap", "t", partition_by="day")
    fresh = frame((2, "B", "d3"), (None, "N", "d2")).withColumn("extra", F.lit(1))
    gone = spark.createDataFrame([(2,), (None,), (9,)], "id long")
    for _ in range(2):
        assert replace_keys(spark, "swap", "t", gone, fresh, ["id"], "day") == 2
        assert rows(spark.table("swap.t"), "id", "v", "day", "extra") == sorted(
            [(1, "a", "d1", None), (2, "B", "d3", 1), (3, "c", "d2", None), (4, "d", None, None), (None, "N", "d2", 1)], key=repr)
