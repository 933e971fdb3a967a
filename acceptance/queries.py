"""One query per operator or table, each over whole given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acceptance.views import base_tables, register, view
from shelfstack.functions import dates, values
from shelfstack.functions.text import tag_array
from shelfstack.operators import carts, columns, joins, profile, quality, ranking, search, sessions, sets
from shelfstack.plans import gold, layers, silver
from shelfstack.session import scratch_path
from shelfstack.settings import FUNNEL_STEPS, MAX_RATING, MIN_RATING, ORDER_STATUSES, Settings
from shelfstack.sinks import tables as sinks
from shelfstack.sinks.upsert import merge_rows
from shelfstack.sources import files
from shelfstack.sources.registry import BY_NAME
from shelfstack.sources.schemas import column_types
from shelfstack.sources.tables import read_table, run_sql
from shelfstack.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

TS = "event_ts"
RAW = {
    "products": "products_raw", "users": "users_raw", "orders": "orders_raw",
    "order_line_items": "order_line_items_raw", "reviews": "reviews_raw", "clickstream": "clickstream_raw",
}


class Inputs:
    """Bronze and Silver frames over one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.registered: set[str] = set()
        self.views: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        if name not in self.views:
            for table in base_tables(f"{name}_raw") - self.registered:
                register(self.spark, self.sf_dir, table)
                self.registered.add(table)
            self.views[name] = view(self.spark, f"{name}_raw")
        return self.views[name]

    products = property(lambda self: silver.dim_products(self.raw("products")))
    users = property(lambda self: silver.dim_users(self.raw("users")))
    orders = property(lambda self: silver.fct_orders(self.raw("orders")))
    lines = property(lambda self: silver.fct_order_lines(self.raw("order_line_items")))
    clickstream = property(lambda self: silver.fct_clickstream(self.raw("clickstream")))
    reviews = property(lambda self: silver.fct_reviews(self.raw("reviews")))
    payments = property(lambda self: silver.fct_payments(self.raw("payments")))
    inventory = property(lambda self: silver.fct_inventory(self.raw("inventory")))

    @property
    def performance(self) -> DataFrame:
        return gold.product_performance(self.lines, self.products, self.orders, ordered=False)

    @property
    def layer_pairs(self) -> dict[str, tuple[DataFrame, DataFrame]]:
        return {
            "products": (self.raw("products"), self.products),
            "users": (self.raw("users"), self.users),
            "orders": (self.raw("orders"), self.orders),
            "order_line_items": (self.raw("order_line_items"), self.lines),
        }

    def scratch(self, label: str) -> str:
        return scratch_path(self.spark, label)


def query(build: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    QUERIES[build.__name__] = lambda spark, sf_dir: build(Inputs(spark, sf_dir))
    return build


# Silver

@query
def dim_products(i: Inputs) -> DataFrame:
    return i.products


@query
def dim_users(i: Inputs) -> DataFrame:
    return i.users


@query
def dim_users_short_phone(i: Inputs) -> DataFrame:
    return silver.dim_users(i.raw("users"), max_phone_digits=3)


@query
def fct_orders(i: Inputs) -> DataFrame:
    return i.orders


@query
def fct_orders_dated(i: Inputs) -> DataFrame:
    """Dates in seven formats and unreadable ones."""
    bronze = i.raw("orders_dated")
    return silver.fct_orders(bronze, dates.day_first(bronze, "order_date"))


@query
def date_formats(i: Inputs) -> DataFrame:
    return dates.date_formats(i.raw("orders_dated"), "order_date")


@query
def fct_order_lines(i: Inputs) -> DataFrame:
    return i.lines


@query
def fct_order_lines_checked(i: Inputs) -> DataFrame:
    return silver.fct_order_lines(i.raw("order_line_items"), i.orders)


@query
def dim_reviews(i: Inputs) -> DataFrame:
    return silver.dim_reviews(i.raw("reviews"))


@query
def fct_reviews(i: Inputs) -> DataFrame:
    return i.reviews


@query
def fct_clickstream(i: Inputs) -> DataFrame:
    return i.clickstream


@query
def fct_payments(i: Inputs) -> DataFrame:
    return i.payments


@query
def fct_inventory(i: Inputs) -> DataFrame:
    return i.inventory


# Gold

@query
def daily_revenue(i: Inputs) -> DataFrame:
    return gold.daily_revenue(i.orders, i.lines)


@query
def daily_revenue_exact(i: Inputs) -> DataFrame:
    return gold.daily_revenue(i.orders, i.lines, exact=True)


@query
def daily_revenue_report(i: Inputs) -> DataFrame:
    days = gold.daily_revenue(i.orders, i.lines, exact=True, ordered=False)
    return columns.presentable(days, ("total_revenue", "avg_order_value"), ("total_items",))


@query
def product_performance(i: Inputs) -> DataFrame:
    return gold.product_performance(i.lines, i.products, i.orders)


@query
def product_performance_named(i: Inputs) -> DataFrame:
    return gold.product_performance(i.lines, i.products, i.orders, product_name=True)


@query
def customer_ltv(i: Inputs) -> DataFrame:
    return gold.customer_ltv(i.orders, i.users)


@query
def funnel_analysis(i: Inputs) -> DataFrame:
    return gold.funnel_analysis(i.clickstream)


@query
def funnel_in_order(i: Inputs) -> DataFrame:
    return gold.funnel_in_order(i.clickstream, ts=TS)


@query
def inventory_status(i: Inputs) -> DataFrame:
    return gold.inventory_status(i.inventory)


@query
def campaign_performance(i: Inputs) -> DataFrame:
    return gold.campaign_performance(i.raw("marketing"))


@query
def payment_summary(i: Inputs) -> DataFrame:
    return gold.payment_summary(i.payments)


@query
def brand_category_performance(i: Inputs) -> DataFrame:
    return gold.brand_category_performance(i.performance)


@query
def product_conversion(i: Inputs) -> DataFrame:
    return gold.product_conversion(i.performance, i.raw("interactions"))


@query
def top_products(i: Inputs) -> DataFrame:
    return ranking.top_k(i.performance, "total_revenue", 5, "product_id").select(
        "product_id", "model_name", "brand", "total_revenue"
    )


@query
def top_customers(i: Inputs) -> DataFrame:
    table = gold.customer_ltv(i.orders, i.users, ordered=False)
    return ranking.top_k(table, "total_spent", 5, "user_id").select(
        "user_id", "first_name", "last_name", "loyalty_tier", "total_spent", "total_orders"
    )


@query
def first_days(i: Inputs) -> DataFrame:
    days = gold.daily_revenue(i.orders, i.lines, ordered=False)
    return days.orderBy(ranking.ascending("order_date")).limit(5)


# Joins

@query
def orders_enriched(i: Inputs) -> DataFrame:
    return gold.orders_enriched(i.orders, i.users)


@query
def lines_enriched(i: Inputs) -> DataFrame:
    return gold.lines_enriched(i.lines, i.products)


@query
def lines_ri_semi(i: Inputs) -> DataFrame:
    return joins.with_parent(i.lines, i.orders, "order_id")


@query
def lines_orphans(i: Inputs) -> DataFrame:
    return joins.without_parent(i.lines, i.orders, "order_id")


@query
def recovered_carts(i: Inputs) -> DataFrame:
    found = i.orders.select("order_id", F.col("status").alias("order_status"), "total_usd")
    return joins.lookup(
        i.raw("abandoned_carts").drop("items"), found, "recovered_order_id", "cart_id", dimension_key="order_id"
    )


@query
def clicked_searches(i: Inputs) -> DataFrame:
    tables = {"search_events": i.raw("search"), "products": i.products}
    return joins.follow(tables, "search_events", "clicked_product_id", ["brand", "price_usd"], "event_id")


@query
def reviews_with_products(i: Inputs) -> DataFrame:
    tables = {"reviews": i.reviews.select("review_id", "product_id", "rating"), "products": i.products}
    return joins.follow(tables, "reviews", "product_id", ["brand"], "review_id")


@query
def payments_with_orders(i: Inputs) -> DataFrame:
    tables = {"payments": i.payments, "orders": i.orders.withColumnRenamed("status", "order_status")}
    return joins.follow(tables, "payments", "order_id", ["order_status"], "transaction_id")


@query
def carts_with_products(i: Inputs) -> DataFrame:
    tables = {"abandoned_carts": i.raw("abandoned_carts").select("cart_id", "items"), "products": i.products}
    return joins.follow(tables, "abandoned_carts", "items.product_id", ["brand", "price_usd"], "cart_id")


@query
def fk_violations(i: Inputs) -> DataFrame:
    bronze = {name: i.raw("search" if name == "search_events" else name) for name in BY_NAME}
    sold = joins.ForeignKey("fct_order_lines.product_id", i.lines, "product_id", i.products, "product_id")
    return joins.foreign_key_violations([*joins.foreign_keys(bronze), sold])


# Nested and delimited fields, sessions, searches

@query
def product_sizes(i: Inputs) -> DataFrame:
    return gold.product_sizes(i.products)


@query
def product_tags(i: Inputs) -> DataFrame:
    return i.products.select("product_id", F.explode(tag_array(F.col("tags"))).alias("tag"))


@query
def search_filters(i: Inputs) -> DataFrame:
    return i.raw("search").select(
        "event_id",
        F.explode(values.string_map(F.col("filters_applied_json"))).alias("filter_name", "filter_value"),
    )


@query
def cart_items_flat(i: Inputs) -> DataFrame:
    return carts.flatten_items(i.raw("abandoned_carts"))


@query
def session_summary(i: Inputs) -> DataFrame:
    return sessions.summarize_sessions(i.clickstream, ts=TS)


@query
def session_events(i: Inputs) -> DataFrame:
    return ranking.number_events(i.clickstream, "session_id", TS, "event_id").select(
        "event_id", "session_id", TS, "event_seq"
    )


@query
def search_normalized(i: Inputs) -> DataFrame:
    events = i.raw("search")
    found = search.correct_queries(events, events, "query_raw", "query_normalized", "event_id")
    return found.select("event_id", "query_raw", "query_clean", "query_corrected", "edit_distance")


@query
def users_masked(i: Inputs) -> DataFrame:
    policy = {"email": "hash", "phone": "phone_country", "first_name": "drop", "last_name": "drop"}
    return columns.mask(columns.drop_internal(i.raw("users")), policy)


# Profiles and quality

@query
def status_counts(i: Inputs) -> DataFrame:
    return profile.value_counts(i.raw("orders"), "status").orderBy(ranking.descending("cnt"))


@query
def rating_counts(i: Inputs) -> DataFrame:
    return profile.value_counts(i.raw("reviews"), "rating").orderBy(ranking.ascending("rating"))


@query
def event_type_counts(i: Inputs) -> DataFrame:
    return profile.value_counts(i.raw("clickstream"), "event_type").orderBy(ranking.descending("cnt"))


@query
def table_counts(i: Inputs) -> DataFrame:
    return sets.table_counts({name: i.raw(name) for name in RAW})


@query
def tables_filled(i: Inputs) -> DataFrame:
    return quality.all_filled(sets.table_counts({name: i.raw(name) for name in RAW}), len(RAW))


@query
def table_shape(i: Inputs) -> DataFrame:
    return profile.shape(i.raw("products"))


@query
def distinct_event_users(i: Inputs) -> DataFrame:
    return profile.distinct_values(i.raw("clickstream"), "event_type", "user_id")


@query
def null_profile(i: Inputs) -> DataFrame:
    return profile.column_profile(i.raw("users"))


@query
def numeric_profile(i: Inputs) -> DataFrame:
    stats = profile.numeric_profile(i.raw("orders"), ["total_usd", "subtotal_usd", "discount_amount_usd"])
    # Sums of doubles depend on the order of the rows in their last digits; the SQL rounds alike.
    return stats.withColumns({"mean": F.round("mean", 6), "std": F.round("std", 4)})


@query
def order_total_violations(i: Inputs) -> DataFrame:
    return quality.order_total_violations(i.orders).select("order_id", "total_usd", "gap")


@query
def any_wrong_total(i: Inputs) -> DataFrame:
    orders = i.orders
    return quality.any_broken(orders, quality.order_total_gap(orders) > 0.01)


@query
def line_total_violations(i: Inputs) -> DataFrame:
    lines = columns.drop_internal(i.raw("order_line_items")).filter("quantity > 0")
    return quality.line_total_violations(lines)


@query
def allowed_value_violations(i: Inputs) -> DataFrame:
    return sets.stack_rows([
        quality.unexpected_values(i.raw("orders"), "status", ORDER_STATUSES),
        quality.unexpected_values(i.raw("reviews"), "rating", range(MIN_RATING, MAX_RATING + 1)),
        quality.unexpected_values(i.raw("clickstream"), "event_type", FUNNEL_STEPS),
    ])


@query
def conditional_field_violations(i: Inputs) -> DataFrame:
    return quality.stack_rules({
        "marketing": quality.rule_counts(i.raw("marketing"), quality.iff_rules(quality.MARKETING_FIELDS)),
        "interactions": quality.rule_counts(i.raw("interactions"), quality.iff_rules(quality.INTERACTION_FIELDS)),
    })


@query
def sign_violations(i: Inputs) -> DataFrame:
    return quality.stack_rules({
        "payments": quality.rule_counts(i.payments, quality.payment_sign_rules()),
        "inventory": quality.rule_counts(i.inventory, quality.inventory_sign_rules()),
    })


@query
def cast_failures(i: Inputs) -> DataFrame:
    orders = i.raw("orders")
    text = orders.select(*[F.col(c).cast("string").alias(c) for c in orders.columns])
    return files.cast_failures(text, column_types("orders"))


@query
def revenue_reconciliation(i: Inputs) -> DataFrame:
    return quality.reconciled(gold.revenue_by_variant(i.orders, i.lines), i.orders)


@query
def layer_column_check(i: Inputs) -> DataFrame:
    return quality.layer_columns(i.layer_pairs)


@query
def removed_columns(i: Inputs) -> DataFrame:
    return quality.removed_values(i.layer_pairs)


@query
def leaked_columns(i: Inputs) -> DataFrame:
    return quality.leaked_values(i.layer_pairs)


# Sources, sinks, audit

@query
def parameterised_sql(i: Inputs) -> DataFrame:
    i.raw("orders").createOrReplaceTempView("bronze_orders")
    return run_sql(
        i.spark,
        "SELECT order_id, status, total_usd FROM bronze_orders WHERE status = :status AND total_usd >= :least",
        {"status": "shipped", "least": 1000.0},
    )


@query
def concat_by_name(i: Inputs) -> DataFrame:
    return sets.stack_rows([
        i.raw("clickstream").select("event_id", "event_type", TS, "user_id", "session_id"),
        i.raw("interactions").select("event_id", "event_type", TS, "user_id", "product_id"),
    ])


@query
def bronze_csv_roundtrip(i: Inputs) -> DataFrame:
    path = i.scratch("products")
    sinks.write_csv(i.raw("products"), path)
    return files.read_csv(i.spark, path, column_types("products", temporal=False))


@query
def bronze_csv_users(i: Inputs) -> DataFrame:
    path = i.scratch("users")
    sinks.write_csv(i.raw("users"), path)
    return files.read_csv(i.spark, path, column_types("users", temporal=False))


@query
def bronze_jsonl_roundtrip(i: Inputs) -> DataFrame:
    path = i.scratch("reviews")
    sinks.write_jsonl(i.raw("reviews"), path)
    return files.read_jsonl(i.spark, path, column_types("reviews"))


@query
def bronze_jsonl_nested(i: Inputs) -> DataFrame:
    path = i.scratch("carts")
    sinks.write_jsonl(i.raw("abandoned_carts"), path)
    return carts.flatten_items(files.read_jsonl(i.spark, path, column_types("abandoned_carts")))


@query
def bronze_parquet_partitioned(i: Inputs) -> DataFrame:
    """Day directories whose earlier half lacks a column."""
    path, events = i.scratch("clickstream"), i.raw("clickstream")
    older = F.col("dt") < "2024-01-16"
    sinks.write_parquet(events.filter(older).drop("_ttfb_ms"), path, partition_by="dt")
    sinks.write_parquet(events.filter(~older), path, mode="append", partition_by="dt")
    return files.read_parquet(i.spark, path)


@query
def bronze_csv_rescued(i: Inputs) -> DataFrame:
    """Text in number columns, read back from what Bronze has kept."""
    path = i.scratch("misfits")
    sinks.write_csv(i.raw("misfits"), path)
    bronze = files.read_csv(i.spark, path, column_types("order_line_items", temporal=False), rescue="_rescued")
    kept = lambda name: F.col("_rescued")[name]
    return bronze.select("line_item_id", "quantity", "unit_price_usd", kept("quantity").alias("quantity_text"), kept("unit_price_usd").alias("price_text"))


@query
def bronze_csv_stream(i: Inputs) -> DataFrame:
    """The same cells in files that arrive in two runs of an incremental load."""
    root, dataset = i.scratch("stream"), BY_NAME["order_line_items"]
    settings = Settings(raw_root=f"{root}/raw", bronze=f"bronze_{root.rpartition('-')[2]}")
    i.spark.sql(f"CREATE DATABASE {settings.bronze} LOCATION '{root}/bronze'")
    for late in (False, True):
        part = i.raw("misfits").filter((F.col("line_item_id") % 3 == 0) == late)
        sinks.write_csv(part, f"{settings.raw_root}/{dataset.key}", mode="append")
        ingest.ingest_new_files(i.spark, settings, dataset, f"{root}/log")
    kept = lambda name: F.col("_rescued")[name]
    bronze = read_table(i.spark, settings.bronze, dataset.bronze)
    return bronze.select("line_item_id", "quantity", "unit_price_usd", kept("quantity").alias("quantity_text"), kept("unit_price_usd").alias("price_text"))


@query
def bronze_jsonl_rescued(i: Inputs) -> DataFrame:
    """The same as JSON lines, read by a schema that does not know one of the fields."""
    path = i.scratch("misfits")
    sinks.write_jsonl(i.raw("misfits"), path)
    schema = "line_item_id bigint, quantity bigint, unit_price_usd double"
    bronze = files.read_jsonl(i.spark, path, column_types("order_line_items"), schema, rescue="_rescued")
    return files.rescued_cells(bronze, "line_item_id")


@query
def quarantine_audit(i: Inputs) -> DataFrame:
    """What the audit of an extract says about cells that do not fit."""
    path = i.scratch("misfits")
    sinks.write_csv(i.raw("misfits"), f"{path}/raw")
    types = column_types("order_line_items", temporal=False)
    bronze = files.read_csv(i.spark, f"{path}/raw", types, rescue="_rescued")
    row = layers.load_counted(
        "extract", "order_line_items", bronze, lambda df: df, lambda df: sinks.write_parquet(df, f"{path}/bronze"),
        files.rescue_rules(bronze, types))
    return layers.audit_frame(i.spark, [row]).select("rows_in", "rows_out", F.explode("rules").alias("rule", "violations"))


@query
def bronze_parquet_drift(i: Inputs) -> DataFrame:
    """Day directories whose measure was a whole number, then text, then a double, and whose flag became a number."""
    path, events = i.scratch("drift"), i.raw("clickstream")
    first, second = F.col("dt") < "2024-01-11", F.col("dt") < "2024-01-21"
    whole = F.floor("_ttfb_ms").cast("bigint")
    days = events.select("event_id", "user_id", "_ttfb_ms", "dt")
    sinks.write_parquet(days.filter(first).withColumn("_ttfb_ms", whole), path, partition_by="dt")
    sinks.write_parquet(days.filter(~first & second).withColumn("user_id", F.col("user_id").cast("int")), path, mode="append", partition_by="dt")
    sinks.write_parquet(days.filter(~second).withColumn("user_id", F.col("user_id").cast("string")), path, mode="append", partition_by="dt")
    return files.read_parquet_widened(i.spark, path)


@query
def bronze_parquet_plain(i: Inputs) -> DataFrame:
    path = i.scratch("interactions")
    sinks.write_parquet(i.raw("interactions"), path)
    return files.read_parquet(i.spark, path)


CORE_FILES = {
    "products": ("csv", "catalog/products.csv"), "users": ("csv", "users/users.csv"), "orders": ("csv", "orders/orders.csv"),
    "order_line_items": ("csv", "order_line_items/order_line_items.csv"), "reviews": ("jsonl", "reviews/reviews.jsonl"),
}


RUNS: dict[tuple[str, str, str], dict[str, str]] = {}


def _write_sources(root: str, frames: dict[str, DataFrame]) -> None:
    for name, (kind, path) in CORE_FILES.items():
        getattr(sinks, f"write_{kind}")(frames[name], f"{root}/{path}")
    sinks.write_parquet(frames["clickstream"].withColumnRenamed(TS, "timestamp"), f"{root}/clickstream/", partition_by="dt")


def _layer_names(i: Inputs, root: str) -> dict[str, str]:
    names = {layer: f"{layer}_{root.rpartition('-')[2]}" for layer in ("bronze", "silver", "gold")}
    for layer, name in names.items():
        i.spark.sql(f"CREATE DATABASE {name} LOCATION '{root}/{layer}'")
    return names


def _once(kind: str, i: Inputs, run: Callable[[Inputs, str], dict[str, str]]) -> dict[str, str]:
    """The layers of a run, which is made once per session and input."""
    key = (kind, i.spark.sparkContext.applicationId, i.sf_dir)
    if key not in RUNS:
        RUNS[key] = run(i, i.scratch("run"))
    return RUNS[key]


def _full_run(i: Inputs, root: str) -> dict[str, str]:
    """The given tables as source files, and a whole run over them."""
    names = _layer_names(i, root)
    _write_sources(f"{root}/raw", {name: i.raw(name) for name in (*CORE_FILES, "clickstream")})
    layers.run(i.spark, Settings(raw_root=f"{root}/raw", **names))
    return names


def _core_run(i: Inputs, table: str) -> DataFrame:
    return read_table(i.spark, _once("full", i, _full_run)["gold"], table)


@query
def run_daily_revenue(i: Inputs) -> DataFrame:
    return _core_run(i, "daily_revenue")


@query
def run_product_performance(i: Inputs) -> DataFrame:
    return _core_run(i, "product_performance")


@query
def run_customer_ltv(i: Inputs) -> DataFrame:
    return _core_run(i, "customer_ltv")


# What the digits of a packed line key can tell apart; the orders go as far as 64 bits do.
PACKED = {"l_orderkey": 9_223_371, "l_linenumber": 9, "l_partkey": 99_999, "l_suppkey": 9_999, "l_quantity": 99}


def _keyed_lines(i: Inputs) -> DataFrame:
    """Order lines with a key: their columns packed into one number, or numbered per order where a column is too large for that.

    A packed key overflows from 9,223,372 orders on, and with part or supplier keys beyond its digits two lines could
    have one. Numbers per order take one shuffle of the lines.
    """
    packed = i.raw("order_line_items_keyed")
    ends = i.spark.table("lineitem").agg(*[end(c).alias(f"{end.__name__}_{c}") for c in PACKED for end in (F.min, F.max)]).first()
    outside = [c for c, most in PACKED.items() if ends[f"max_{c}"] is not None and not 0 <= ends[f"min_{c}"] <= ends[f"max_{c}"] <= most]
    return i.raw("order_line_items_numbered") if outside else packed


def _changed_run(i: Inputs, root: str) -> dict[str, str]:
    """An older state of the given tables loaded whole, then what has changed since as an upsert."""
    names, now = _layer_names(i, root), {name: i.raw(name) for name in (*CORE_FILES, "clickstream")}
    now["order_line_items"] = _keyed_lines(i)
    late, moved = F.col("order_id") % 10 == 0, F.col("order_id") % 10 == 1
    sold, bought = F.col("line_item_id") % 7 == 0, F.col("user_id") % 9 == 0
    cheap, seen, rated = F.col("product_id") % 11 == 0, F.col("event_id") % 6 == 0, F.col("review_id") % 6 == 0
    before = now | {
        "orders": now["orders"].filter(~late).withColumns({
            "status": F.when(moved, "processing").otherwise(F.col("status")),
            "order_date": F.when(moved, "1990-01-01").otherwise(F.col("order_date")),
            "user_id": F.when(moved, F.col("user_id") + 1).otherwise(F.col("user_id"))}),
        "order_line_items": now["order_line_items"].withColumn("product_id", F.when(sold, F.col("product_id") + 1).otherwise(F.col("product_id"))),
        "users": now["users"].withColumn("first_name", F.when(bought, "Former").otherwise(F.col("first_name"))),
        "products": now["products"].withColumn("price_usd", F.when(cheap, -1.0).otherwise(F.col("price_usd"))),
        "clickstream": now["clickstream"].filter(~seen),
        "reviews": now["reviews"].filter(~rated),
    }
    _write_sources(f"{root}/before", before)
    layers.run(i.spark, Settings(raw_root=f"{root}/before", **names))
    _write_sources(f"{root}/since", {
        "orders": now["orders"].filter(late | moved), "order_line_items": now["order_line_items"].filter(sold),
        "users": now["users"].filter(bought), "products": now["products"].filter(cheap),
        "clickstream": now["clickstream"].filter(seen), "reviews": now["reviews"].filter(rated)})
    layers.run(i.spark, Settings(raw_root=f"{root}/since", mode="upsert", **names))
    return names


@query
def run_incremental_daily_revenue(i: Inputs) -> DataFrame:
    return read_table(i.spark, _once("changed", i, _changed_run)["gold"], "daily_revenue")


@query
def run_incremental_product_performance(i: Inputs) -> DataFrame:
    return read_table(i.spark, _once("changed", i, _changed_run)["gold"], "product_performance")


@query
def run_incremental_customer_ltv(i: Inputs) -> DataFrame:
    return read_table(i.spark, _once("changed", i, _changed_run)["gold"], "customer_ltv")


@query
def upsert_twice(i: Inputs) -> DataFrame:
    """A batch in which some orders have lost their key, merged and merged again."""
    orders = i.orders
    batch = orders.filter(F.col("status").isin("processing", "returned")).withColumns({
        "order_id": F.when(F.col("status") == "returned", F.col("order_id")), "total_usd": F.lit(1.0)})
    return merge_rows(merge_rows(orders, batch, ["order_id"]), batch, ["order_id"])


@query
def upsert_orders(i: Inputs) -> DataFrame:
    """A batch that ships all orders in processing, each key twice, and books a copy of the returned ones."""
    orders = i.orders
    before = orders.filter(F.col("status") == "processing")
    after = before.withColumns({
        "status": F.lit("shipped"), "order_date": F.col("order_date") + F.expr("INTERVAL '1' DAY")
    })
    booked = orders.filter(F.col("status") == "returned").withColumn("order_id", F.col("order_id") + 1_000_000_000)
    batch = after.unionByName(before).unionByName(booked)
    return merge_rows(orders, batch, ["order_id"], ["order_date"])


def _audit(i: Inputs) -> DataFrame:
    root = i.scratch("audit")
    sources = {
        "dim_products": "products", "dim_users": "users", "fct_orders": "orders",
        "fct_order_lines": "order_line_items", "fct_reviews": "reviews", "fct_clickstream": "clickstream",
        "fct_payments": "payments", "fct_inventory": "inventory",
    }
    rows = []
    for table, source in sources.items():
        bronze = i.raw(source)
        rules = silver.RULES[table](bronze) if table in silver.RULES else {}
        rows.append(layers.load_counted(
            "transform", table, bronze, silver.BUILDERS[table],
            lambda df, table=table: sinks.write_parquet(df, f"{root}/{table}"), rules,
        ))
    return layers.audit_frame(i.spark, rows)


@query
def load_audit(i: Inputs) -> DataFrame:
    return _audit(i).drop("rules")


@query
def load_audit_rules(i: Inputs) -> DataFrame:
    return _audit(i).select("table_name", F.explode("rules").alias("rule", "violations"))
