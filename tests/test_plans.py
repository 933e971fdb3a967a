"""The shape of the plans: what is pushed down, shuffled, split, and never done."""

import re

import pytest
from pyspark.sql import functions as F

from acceptance.oracle import ORACLE
from acceptance.queries import QUERIES, Inputs
from shelfstack.operators import joins, ranking
from shelfstack.plans import gold, silver
from tests.conftest import rows

SMALL = "/root/testdata/sf0.001"
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "EvalPython", "InPandas", "MapInArrow")
WRITERS = re.compile("^(bronze_|load_audit|run_)")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def conf(spark):
    changed = {}

    def set_conf(**settings):
        for key, value in settings.items():
            name = "spark.sql." + key.replace("__", ".")
            changed.setdefault(name, spark.conf.get(name, None))
            spark.conf.set(name, value)

    yield set_conf
    for name, value in changed.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@pytest.mark.parametrize("name", [n for n in QUERIES if not WRITERS.match(n)])
def test_no_cross_joins_and_no_python(spark, conf, name):
    conf(autoBroadcastJoinThreshold="-1")
    text = plan(QUERIES[name](spark, SMALL))
    assert not [word for word in FORBIDDEN if word in text]
    # Only frames with one row per profiled column are broadcast by hint.
    assert ("BroadcastHashJoin" in text) == (name == "numeric_profile")


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.fixture
def tables(spark, tmp_path):
    """The adapted tables as files, so that the scans show."""
    source = Inputs(spark, SMALL)
    for name in ("products", "users", "orders", "order_line_items", "clickstream"):
        source.raw(name).write.parquet(str(tmp_path / name))
    return lambda name: spark.read.parquet(str(tmp_path / name))


def test_filters_and_columns_reach_the_scan(spark, tables):
    text = plan(silver.dim_products(tables("products")))
    assert "GreaterThan(price_usd,0.0)" in text and "_supplier_id" not in text
    text = plan(silver.fct_orders(tables("orders")))
    assert "In(status, [cancelled,chargeback,delivered,processing,returned,shipped])" in text
    assert "Exchange" not in text
    text = plan(silver.fct_order_lines(tables("order_line_items")))
    assert "GreaterThan(quantity,0)" in text and "Exchange" not in text
    text = plan(silver.fct_clickstream(tables("clickstream")))
    assert "ip_address" not in text and "Exchange" not in text


def test_gold_reads_only_its_columns(spark, tables):
    orders, lines = silver.fct_orders(tables("orders")), silver.fct_order_lines(tables("order_line_items"))
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", plan(gold.daily_revenue(orders, lines)))
    assert sorted(re.sub(r":\w+", "", s) for s in scans) == [
        "order_id,order_date,status,total_usd", "order_id,quantity,unit_price_usd,line_total_usd"
    ]


def test_each_table_is_shuffled_once_on_its_key(spark, conf, tables):
    conf(autoBroadcastJoinThreshold="-1")
    orders, lines = silver.fct_orders(tables("orders")), silver.fct_order_lines(tables("order_line_items"))
    users, products = silver.dim_users(tables("users")), silver.dim_products(tables("products"))
    for table, shuffles in (
        (gold.daily_revenue(orders, lines, ordered=False), 3),
        (gold.product_performance(lines, products, orders, ordered=False), 4),
        (gold.customer_ltv(orders, users, ordered=False), 3),
    ):
        text = plan(table)
        assert text.count("Exchange hashpartitioning") == shuffles, text


def test_reports_sort_and_tables_do_not(spark, tables):
    orders, lines = silver.fct_orders(tables("orders")), silver.fct_order_lines(tables("order_line_items"))
    assert "rangepartitioning" in plan(gold.daily_revenue(orders, lines))
    assert "rangepartitioning" not in plan(gold.daily_revenue(orders, lines, ordered=False))


def hot_facts(spark, rows_per_task=20_000):
    """Every third key is the same one."""
    return spark.range(0, 4 * rows_per_task, numPartitions=8).select(
        "id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000).cast("long").alias("key"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )


def split_by_aqe(conf):
    conf(
        autoBroadcastJoinThreshold="-1", adaptive__autoBroadcastJoinThreshold="-1", shuffle__partitions="16",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="100KB", adaptive__skewJoin__skewedPartitionFactor="2",
        adaptive__advisoryPartitionSizeInBytes="100KB", adaptive__coalescePartitions__enabled="false",
    )


@pytest.mark.parametrize("join", ["lookup", "semi", "anti"])
def test_hot_keys_are_split(spark, conf, join):
    split_by_aqe(conf)
    facts = hot_facts(spark)
    parents = spark.range(2500).withColumnRenamed("id", "key")
    result = {
        "lookup": lambda: joins.lookup(facts, parents.withColumn("word", F.lit("w")), "key", "id"),
        "semi": lambda: joins.with_parent(facts, parents, "key"),
        "anti": lambda: joins.without_parent(facts, parents, "key"),
    }[join]()
    result.collect()
    text = plan(result)
    assert "skew=true" in text, text


def test_null_keys_are_spread_and_the_right_side_is_not_repeated(spark, conf):
    conf(autoBroadcastJoinThreshold="-1", adaptive__enabled="false", shuffle__partitions="16")
    parents = spark.range(2500).select(F.col("id").alias("key"), F.lit("w").alias("word"))
    facts = hot_facts(spark).withColumn("key", F.when(F.col("key") != 7, F.col("key")))
    joined = joins.lookup(facts, parents, "key", "id")
    assert "Generate" not in plan(joined) and "Expand" not in plan(joined)
    places = joined.select("key", F.spark_partition_id().alias("p"))
    assert places.filter("key IS NULL").select("p").distinct().count() > 8
    assert joined.count() == facts.count() and joined.filter("word IS NOT NULL").count() == facts.filter("key < 2500").count()


def test_hot_session_is_ranked_by_many_tasks(spark, conf):
    conf(autoBroadcastJoinThreshold="-1", adaptive__enabled="false", shuffle__partitions="16")
    events = spark.range(0, 6000, numPartitions=4).select(
        "id", F.lit("hot").alias("session"), F.timestamp_seconds(F.col("id") * 7).cast("timestamp_ntz").alias("ts")
    )
    numbered = ranking.number_events(events, "session", "ts", "id")
    places = numbered.select("id", "event_seq", F.spark_partition_id().alias("p"))
    assert places.select("p").distinct().count() > 4
    assert rows(places.filter(F.col("event_seq") != F.col("id") + 1)) == []


def test_events_without_stamp_or_session_use_many_tasks(spark, conf):
    conf(autoBroadcastJoinThreshold="-1", adaptive__enabled="false", shuffle__partitions="16")
    stamp = F.lit("2026-01-01 00:00:00").cast("timestamp_ntz")
    unstamped = spark.range(4000).select("id", F.lit("hot").alias("session"), F.when(F.col("id") < 0, stamp).alias("ts"))
    homeless = spark.range(4000, 8000).select("id", F.lit(None).cast("string").alias("session"), stamp.alias("ts"))
    numbered = ranking.number_events(unstamped.union(homeless), "session", "ts", "id")
    places = numbered.select("id", "session", "event_seq", F.spark_partition_id().alias("p"))
    for part in ("session IS NULL", "session IS NOT NULL"):
        # The position is part of the result, else the window is pruned.
        assert len(places.filter(part).groupBy("p").agg(F.max("event_seq")).collect()) > 4
    assert places.filter("session IS NOT NULL AND event_seq <> id + 1").count() == 0
    assert places.filter("session IS NULL AND event_seq IS NOT NULL").count() == 0
