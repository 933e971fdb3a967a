"""Runs: files to Bronze, Bronze to Silver, Silver to Gold.

A layer reads only the tables of the layer before it, so each step can be run again by itself.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shelfstack.functions.dates import day_first
from shelfstack.operators.sessions import summarize_sessions
from shelfstack.plans import gold, silver
from shelfstack.settings import MODES, Settings
from shelfstack.sinks.publish import finish_publishing, newest_table, publish, stage_table
from shelfstack.sinks.tables import ensure_layers
from shelfstack.sources.files import bronze_types, read_dataset, rescue_rules
from shelfstack.sources.registry import BY_NAME, Dataset, datasets
from shelfstack.sources.tables import read_table

STEPS = ("extract", "transform", "gold")
AUDIT_SCHEMA = (
    "step string, table_name string, rows_in bigint, rows_out bigint, rows_dropped bigint, "
    "columns int, rules map<string,bigint>, status string"
)
CORE_SILVER = ("products", "users", "orders", "order_line_items")
# The column that tells the groups of a core Gold table apart.
GOLD_GROUPS = {"daily_revenue": "order_date", "product_performance": "product_id", "customer_ltv": "user_id"}


def load_counted(
    step: str,
    table: str,
    source: DataFrame,
    build: Callable[[DataFrame], DataFrame],
    write: Callable[[DataFrame], None],
    rules: dict[str, Column] | None = None,
    written: Callable[[], DataFrame] | None = None,
) -> tuple:
    """Writes ``build(source)`` and returns its audit row.

    Rows in, rows out and broken rules are observed by the write itself, without another scan. A write that
    shuffles may run tasks again after their rows were observed; with ``written`` (the table as it is then)
    rows out come from the footers of the committed files, and the others from an aggregate of their own.
    """
    counts = [F.count("*").alias("rows"), *[F.count_if(broken).alias(name) for name, broken in (rules or {}).items()]]
    if written:
        result = build(source)
        write(result)
        seen, rows_out = source.agg(*counts).first().asDict(), written().count()
    else:
        before, after = Observation(), Observation()
        result = build(source.observe(before, *counts))
        write(result.observe(after, F.count("*").alias("rows")))
        seen, rows_out = dict(before.get), after.get["rows"]
    rows_in = seen.pop("rows")
    return (step, table, rows_in, rows_out, rows_in - rows_out, len(result.columns), seen, "success")


def audit_frame(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """One row per loaded table."""
    return spark.createDataFrame(rows, AUDIT_SCHEMA)


def write_audit(audit: DataFrame, path: str) -> None:
    audit.write.mode("append").json(path)


def read_source(spark: SparkSession, settings: Settings, dataset: Dataset) -> DataFrame:
    """The files of a dataset, read by the schema of the Bronze table that the last load left."""
    name = f"{settings.bronze}.{dataset.bronze}"
    last = spark.table(name) if spark.catalog.tableExists(name) else None
    return read_dataset(spark, settings, dataset, last)


def extract(spark: SparkSession, settings: Settings, dataset: Dataset) -> tuple:
    """One dataset into the next Bronze table, as it is; cells that do not fit are kept and counted."""
    source = read_source(spark, settings, dataset)
    rules = rescue_rules(source, bronze_types(dataset), settings.rescue) if settings.rescue else {}
    return load_counted(
        "extract", dataset.bronze, source, lambda df: df,
        lambda df: stage_table(df, settings.bronze, dataset.bronze, dataset.partition_by), rules,
    )


def extract_all(spark: SparkSession, settings: Settings, bonus: bool = False) -> list[tuple]:
    """All datasets; their tables are published together, once every one is written."""
    ensure_layers(spark, settings.bronze)
    finish_publishing(spark, settings.bronze)
    rows = [extract(spark, settings, dataset) for dataset in datasets(bonus)]
    publish(spark, settings.bronze, {dataset.bronze: dataset.partition_by for dataset in datasets(bonus)})
    return rows


def transform(spark: SparkSession, settings: Settings, dataset: Dataset) -> tuple:
    """One Bronze table into the next Silver table."""
    table = dataset.silver
    bronze = read_table(spark, settings.bronze, dataset.bronze)
    build, shuffles = silver.BUILDERS[table], False
    if table == "fct_order_lines" and settings.check_order_lines_ri:
        shuffles = True
        orders = newest_table(spark, settings.silver, "fct_orders")
        build = lambda df: silver.fct_order_lines(df, orders)
    rules = silver.RULES[table](bronze) if table in silver.RULES else {}
    if table == "fct_clickstream" and {"session_id", "timestamp"} <= set(bronze.columns):
        build, shuffles = (lambda df: silver.fct_clickstream(df, "timestamp")), True
    if table == "fct_orders":
        order = day_first(bronze, "order_date")  # a pass over this one column
        build, rules = (lambda df: silver.fct_orders(df, order)), silver.order_rules(bronze, order)
    return load_counted(
        "transform", table, bronze, build,
        lambda df: stage_table(df, settings.silver, table, dataset.partition_by), rules,
        (lambda: newest_table(spark, settings.silver, table)) if shuffles else None,
    )


def transform_all(spark: SparkSession, settings: Settings, bonus: bool = False) -> list[tuple]:
    """The four core tables, with ``bonus`` also reviews, clickstream, payments and inventory."""
    ensure_layers(spark, settings.silver)
    finish_publishing(spark, settings.silver)
    names = [BY_NAME[name] for name in silver_names(bonus)]
    rows = [transform(spark, settings, dataset) for dataset in names]
    publish(spark, settings.silver, {dataset.silver: dataset.partition_by for dataset in names})
    return rows


def silver_names(bonus: bool = False) -> tuple[str, ...]:
    """Datasets that have a Silver table."""
    return CORE_SILVER + (("reviews", "clickstream", "payments", "inventory") if bonus else ())


def gold_frames(spark: SparkSession, settings: Settings, bonus: bool = False) -> dict[str, DataFrame]:
    """The Gold tables as lazy frames over the Silver tables."""
    def silver_table(name: str) -> DataFrame:
        return read_table(spark, settings.silver, name)

    orders, lines = silver_table("fct_orders"), silver_table("fct_order_lines")
    products, users = silver_table("dim_products"), silver_table("dim_users")
    performance = gold.product_performance(lines, products, orders, ordered=False)
    frames = {
        "daily_revenue": gold.daily_revenue(orders, lines, exact=settings.exact_revenue, ordered=False),
        "product_performance": performance,
        "customer_ltv": gold.customer_ltv(orders, users, ordered=False),
    }
    if bonus:
        frames |= {
            "funnel_analysis": gold.funnel_analysis(silver_table("fct_clickstream")),
            "inventory_status": gold.inventory_status(silver_table("fct_inventory")),
            "campaign_performance": gold.campaign_performance(
                read_table(spark, settings.bronze, BY_NAME["marketing"].bronze)
            ),
            "payment_summary": gold.payment_summary(silver_table("fct_payments")),
            "brand_category_performance": gold.brand_category_performance(performance),
            "product_conversion": gold.product_conversion(
                performance, read_table(spark, settings.bronze, BY_NAME["interactions"].bronze)),
            "orders_enriched": gold.orders_enriched(orders, users),
            "lines_enriched": gold.lines_enriched(lines, products),
            "session_summary": summarize_sessions(silver_table("fct_clickstream")),
            "product_sizes": gold.product_sizes(products),
        }
    return frames


def create_gold(spark: SparkSession, settings: Settings, bonus: bool = False, leave_out: tuple[str, ...] = ()) -> list[tuple]:
    """The Gold tables but for those to ``leave_out``, published together."""
    ensure_layers(spark, settings.gold)
    finish_publishing(spark, settings.gold)
    rows = []
    for table, frame in gold_frames(spark, settings, bonus).items():
        if table in leave_out:
            continue
        stage_table(frame, settings.gold, table)
        count = newest_table(spark, settings.gold, table).count()  # from the footers of the committed files
        rows.append(("gold", table, None, count, None, len(frame.columns), {}, "success"))
    publish(spark, settings.gold, {row[1]: None for row in rows})
    return rows


def run(spark: SparkSession, settings: Settings, step: str = "all", bonus: bool = False) -> DataFrame:
    """Runs one step, or all in order, and returns the audit of the loaded tables."""
    if step not in (*STEPS, "all"):
        raise ValueError(f"step must be one of {STEPS} or 'all', not {step!r}")
    if settings.mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {settings.mode!r}")
    if settings.mode != "replace":
        from shelfstack.plans.incremental import run_changes  # builds on this module

        return run_changes(spark, settings, step, bonus)
    rows = []
    if step in ("all", "extract"):
        rows += extract_all(spark, settings, bonus)
    if step in ("all", "transform"):
        rows += transform_all(spark, settings, bonus)
    if step in ("all", "gold"):
        rows += create_gold(spark, settings, bonus)
    return audit_frame(spark, rows)
