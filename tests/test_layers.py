"""A whole run over files in the source formats."""

import json

import pytest

from shelfstack.operators import quality, sets
from shelfstack.plans import layers
from shelfstack.settings import Settings
from shelfstack.sinks import tables as sinks
from shelfstack.sources import tables
from tests.conftest import rows


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    from acceptance.queries import Inputs

    root = tmp_path_factory.mktemp("lake")
    raw = Inputs(spark, "/root/testdata/sf0.001").raw
    stamped = lambda name, **names: raw(name).withColumnsRenamed({"event_ts": "timestamp", **names})
    sinks.write_csv(raw("products"), f"{root}/catalog/products.csv")
    sinks.write_csv(raw("users"), f"{root}/users/users.csv")
    sinks.write_csv(raw("orders"), f"{root}/orders/orders.csv")
    sinks.write_csv(raw("order_line_items"), f"{root}/order_line_items/order_line_items.csv")
    sinks.write_csv(raw("payments"), f"{root}/payments/payment_transactions.csv")
    sinks.write_csv(raw("inventory").withColumnRenamed("movement_ts", "timestamp"), f"{root}/inventory/inventory_movements.csv")
    sinks.write_jsonl(raw("reviews"), f"{root}/reviews/reviews.jsonl")
    sinks.write_jsonl(stamped("marketing"), f"{root}/marketing/marketing_events.jsonl")
    sinks.write_jsonl(raw("search"), f"{root}/search_events/search_events.jsonl")
    sinks.write_jsonl(raw("abandoned_carts"), f"{root}/abandoned_carts/abandoned_carts.jsonl")
    sinks.write_parquet(stamped("clickstream"), f"{root}/clickstream/", partition_by="dt")
    sinks.write_parquet(stamped("interactions"), f"{root}/interactions/")
    return str(root)


def test_core_run(spark, lake, tmp_path):
    settings = Settings(raw_root=lake, bronze="run_bronze", silver="run_silver", gold="run_gold")
    audit = layers.run(spark, settings)
    found = tables.tables_per_layer(spark, ("run_bronze", "run_silver", "run_gold"))
    assert rows(found) == [("run_bronze", 6), ("run_gold", 3), ("run_silver", 4)]
    got = {(r.step, r.table_name): r for r in audit.collect()}
    assert len(got) == 13 and {r.status for r in got.values()} == {"success"}
    for (step, name), row in got.items():
        layer = {"extract": "run_bronze", "transform": "run_silver", "gold": "run_gold"}[step]
        table = spark.table(f"{layer}.{name}")
        assert row.rows_out == table.count() and row.columns == len(table.columns)
        if step != "gold":
            assert row.rows_in - row.rows_out == row.rows_dropped
    dropped = got["transform", "fct_orders"]
    assert dropped.rows_dropped == dropped.rules["unknown_status"] + dropped.rules["unreadable_date"]
    lines = got["transform", "fct_order_lines"]
    assert lines.rows_dropped == sum(lines.rules.values())
    layers.write_audit(audit, str(tmp_path / "audit"))
    logged = [json.loads(line) for f in (tmp_path / "audit").glob("*.json") for line in f.read_text().splitlines()]
    assert len(logged) == 13

    counts = sets.table_counts({
        r.table_name: spark.table(f"run_bronze.{r.table_name}") for r in tables.list_tables(spark, "run_bronze").collect()
    })
    assert tuple(quality.all_filled(counts, 6).first()) == (6, True, True)
    sizes = quality.layer_sizes(found, {"run_bronze": 6, "run_silver": 5, "run_gold": 3, "other": 1})
    assert rows(sizes) == [
        ("other", 0, 1, False), ("run_bronze", 6, 6, True), ("run_gold", 3, 3, True), ("run_silver", 4, 5, False)
    ]
    assert "dt" in spark.table("run_bronze.clickstream").columns

    # Steps run alone give the same tables.
    before = rows(spark.table("run_gold.customer_ltv"))
    layers.run(spark, settings, "transform")
    layers.run(spark, settings, "gold")
    assert rows(spark.table("run_gold.customer_ltv")) == before


def test_core_run_matches_the_queries(spark, lake):
    from acceptance.queries import QUERIES

    settings = Settings(raw_root=lake, bronze="same_bronze", silver="same_silver", gold="same_gold")
    layers.run(spark, settings)
    for table in ("daily_revenue", "product_performance", "customer_ltv"):
        expected = QUERIES[table](spark, "/root/testdata/sf0.001")
        assert rows(spark.table(f"same_gold.{table}"), *expected.columns) == rows(expected)


def test_full_run_with_options(spark, lake):
    settings = Settings(
        raw_root=lake, bronze="all_bronze", silver="all_silver", gold="all_gold",
        check_order_lines_ri=True, exact_revenue=True,
    )
    layers.run(spark, settings, bonus=True)
    found = dict(rows(tables.tables_per_layer(spark, ("all_bronze", "all_silver", "all_gold"))))
    assert found == {"all_bronze": 12, "all_silver": 8, "all_gold": 13}
    seen = spark.table("all_silver.fct_clickstream")
    assert "event_seq" in seen.columns
    sessions = spark.table("all_gold.session_summary").where("session_id IS NOT NULL")
    assert sessions.agg({"events": "sum"}).first()[0] == seen.where("event_seq IS NOT NULL").count()
    assert spark.table("all_gold.lines_enriched").count() == spark.table("all_silver.fct_order_lines").count()
    orders, days = spark.table("all_silver.fct_orders"), spark.table("all_gold.daily_revenue")
    assert quality.revenue_reconciliation(days, orders).first().matches is True
    orphans = spark.table("all_silver.fct_order_lines").join(orders, "order_id", "left_anti")
    assert orphans.count() == 0
    for table in tables.list_tables(spark, "all_silver").collect():
        names = spark.table(f"all_silver.{table.table_name}").columns
        assert not [c for c in names if c.startswith("_") or c == "ip_address"]


def test_unknown_step(spark):
    with pytest.raises(ValueError):
        layers.run(spark, Settings(), "load")


def test_missing_files_raise(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        layers.run(spark, Settings(raw_root=str(tmp_path), bronze="missing_bronze"), "extract")


def test_counts_of_a_shuffled_write_do_not_come_from_its_tasks(spark, tmp_path):
    """Tasks that run again can be observed twice; committed files and an aggregate can not."""
    from pyspark.sql import functions as F

    source = spark.range(100).withColumn("k", F.col("id") % 7)
    path = str(tmp_path / "t")
    row = layers.load_counted(
        "transform", "t", source, lambda df: df.repartition(3, "k").filter("id >= 10"), lambda df: sinks.write_parquet(df, path),
        {"small": F.col("id") < 10}, lambda: spark.read.parquet(path))
    assert row == ("transform", "t", 100, 90, 10, 2, {"small": 10}, "success")
    plan = spark.read.parquet(path).groupBy().count()._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in plan  # only footers are read


def test_a_run_that_dies_leaves_the_old_layer(spark, lake, tmp_path, monkeypatch):
    from shelfstack.sinks import publish

    settings = Settings(raw_root=lake, bronze="whole_bronze", silver="whole_silver", gold="whole_gold")
    layers.run(spark, settings)
    names = [r.table_name for r in tables.list_tables(spark, "whole_silver").collect()]
    before = {name: rows(spark.table(f"whole_silver.{name}")) for name in names}
    spark.sql("TRUNCATE TABLE whole_bronze.orders")

    real = layers.transform
    with monkeypatch.context() as patched:  # dies before the last table is written
        patched.setattr(layers, "transform", lambda s, t, d: real(s, t, d) if d.name != "order_line_items" else 1 / 0)
        with pytest.raises(ZeroDivisionError):
            layers.run(spark, settings, "transform")
    assert {name: rows(spark.table(f"whole_silver.{name}")) for name in names} == before

    publish.finish_publishing(spark, "whole_silver")  # what was staged only goes
    assert {r.table_name for r in tables.list_tables(spark, "whole_silver").collect()} == set(names)

    swap = publish.finish_last_run
    with monkeypatch.context() as patched:  # dies while the tables change places
        patched.setattr(publish, "finish_last_run", lambda s, y, t, p: swap(s, y, t, p) if t != "fct_orders" else 1 / 0)
        with pytest.raises(ZeroDivisionError):
            layers.run(spark, settings, "transform")
    publish.finish_publishing(spark, "whole_silver")
    assert spark.table("whole_silver.fct_orders").count() == 0
    assert rows(spark.table("whole_silver.dim_users")) == before["dim_users"]
    assert {r.table_name for r in tables.list_tables(spark, "whole_silver").collect()} == set(names)
