"""Data-quality rules: row-level violations, counts per rule and yes/no checks."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfstack.operators import sets
from shelfstack.functions.values import cents, dollars, number, total_of
from shelfstack.operators.columns import internal_columns
from shelfstack.operators.profile import value_counts
from shelfstack.settings import AMOUNT_TOLERANCE, NON_REVENUE_STATUSES, OUTGOING_MOVEMENTS

ORDER_AMOUNTS = ("total_usd", "subtotal_usd", "discount_amount_usd", "shipping_cost_usd", "tax_usd")


def order_total_gap(df: DataFrame) -> Column:
    """Distance of an order's total from subtotal - discount + shipping + tax; NULL if one is missing."""
    total, subtotal, discount, shipping, tax = (number(df, name) for name in ORDER_AMOUNTS)
    return F.abs(total - (subtotal - discount + shipping + tax))


def line_total_gap(df: DataFrame) -> Column:
    """Distance of a line's total from price times quantity; NULL if one is missing."""
    return F.abs(number(df, "line_total_usd") - number(df, "unit_price_usd") * number(df, "quantity"))


def order_total_violations(df: DataFrame) -> DataFrame:
    return df.withColumn("gap", order_total_gap(df)).filter(F.col("gap") > AMOUNT_TOLERANCE)


def line_total_violations(df: DataFrame) -> DataFrame:
    return df.withColumn("gap", line_total_gap(df)).filter(F.col("gap") > AMOUNT_TOLERANCE)


def rule_counts(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows that break each rule, all rules in one pass."""
    counts = df.agg(*[F.count_if(broken).alias(name) for name, broken in rules.items()])
    return counts.unpivot([], list(rules), "rule", "violations")


def iff_rules(pairs: Mapping[str, tuple[str, str]]) -> dict[str, Column]:
    """Rules "``field`` is filled exactly when ``event_type`` is ``event``", by rule name."""
    return {
        name: F.col(field).isNotNull() != (F.coalesce(F.col("event_type"), F.lit("")) == event)
        for name, (field, event) in pairs.items()
    }


# Optional fields and the one event type that fills each.
MARKETING_FIELDS = {
    "clicked_url_iff_clicked": ("clicked_url", "email_clicked"),
    "bounce_type_iff_bounced": ("bounce_type", "email_bounced"),
}
INTERACTION_FIELDS = {
    "selected_size_iff_size_select": ("selected_size", "size_select"),
    "quantity_iff_add_to_cart": ("quantity", "add_to_cart"),
}


def payment_sign_rules() -> dict[str, Column]:
    refund = F.coalesce(F.col("transaction_type") == "refund", F.lit(False))
    return {
        "negative_without_refund": (F.col("amount_usd") < 0) & ~refund,
        "refund_not_negative": (F.col("amount_usd") >= 0) & refund,
    }


def inventory_sign_rules() -> dict[str, Column]:
    outgoing = F.coalesce(F.col("movement_type").isin(*OUTGOING_MOVEMENTS), F.lit(False))
    return {
        "negative_without_outgoing": (F.col("quantity") < 0) & ~outgoing,
        "outgoing_not_negative": (F.col("quantity") >= 0) & outgoing,
    }


def stack_rules(counts: Mapping[str, DataFrame]) -> DataFrame:
    """Rule tables of several datasets in one."""
    return reduce(DataFrame.unionByName, [
        df.select(F.lit(name).alias("dataset"), "rule", "violations") for name, df in counts.items()
    ])


def unexpected_values(df: DataFrame, column: str, allowed: Iterable[object]) -> DataFrame:
    """Values of ``column`` outside ``allowed``, NULL included, with their row counts."""
    counts = value_counts(df, column)
    return counts.filter(F.col(column).isNull() | ~F.col(column).isin(*allowed)).select(
        F.lit(column).alias("column_name"), F.col(column).cast("string").alias("value"), "cnt"
    )


def revenue_reconciliation(daily_revenue: DataFrame, orders: DataFrame) -> DataFrame:
    """One row: revenue of the daily table against that of the orders it was made from."""
    reported = daily_revenue.select(F.col("total_revenue").alias("reported"))
    expected = orders.filter(~F.col("status").isin(*NON_REVENUE_STATUSES)).select(
        cents(F.col("total_usd")).alias("expected")
    )
    return (
        reported.unionByName(expected, allowMissingColumns=True)
        .agg(
            total_of(F.col("reported")).alias("reported_revenue"),
            dollars(F.sum("expected")).alias("expected_revenue"),
        )
        .withColumn("matches", F.coalesce(
            F.abs(F.col("reported_revenue") - F.col("expected_revenue")) <= AMOUNT_TOLERANCE, F.lit(False)
        ))
    )


def reconciled(reported: DataFrame, orders: DataFrame) -> DataFrame:
    """Rows of ``variant`` and ``reported_revenue`` (few) against the revenue of ``orders``, which are read once for all of them."""
    expected = orders.filter(~F.col("status").isin(*NON_REVENUE_STATUSES)).agg(
        dollars(F.sum(cents(F.col("total_usd")))).alias("expected_revenue"))
    off = F.abs(F.col("reported_revenue") - F.col("expected_revenue"))
    together = reported.unionByName(expected, allowMissingColumns=True)  # a handful of rows
    everywhere = F.max("expected_revenue").over(Window.partitionBy())
    return together.withColumn("expected_revenue", everywhere).filter(F.col("variant").isNotNull()).withColumn(
        "matches", F.coalesce(off <= AMOUNT_TOLERANCE, F.lit(False)))


def all_filled(counts: DataFrame, expected_tables: int) -> DataFrame:
    """One row: are there ``expected_tables`` tables, and does each hold rows?"""
    return counts.agg(
        F.count("*").alias("tables"),
        (F.count("*") == expected_tables).alias("expected_count"),
        F.coalesce(F.bool_and(F.col("rows") > 0), F.lit(False)).alias("all_filled"),
    )


def layer_sizes(found: DataFrame, expected: Mapping[str, int]) -> DataFrame:
    """Per layer: tables found and expected; a layer that is missing has none."""
    wanted = found.sparkSession.createDataFrame(list(expected.items()), "schemaname string, expected bigint")
    counted = F.coalesce("nb_tables", F.lit(0))
    return wanted.join(found, "schemaname", "left").select(
        "schemaname", counted.alias("nb_tables"), "expected", (counted == F.col("expected")).alias("matches")
    )


def any_broken(df: DataFrame, broken: Column) -> DataFrame:
    """One row: does any row break the rule?"""
    return df.agg(F.coalesce(F.bool_or(broken), F.lit(False)).alias("any_broken"))


def layer_columns(pairs: Mapping[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Per table: columns and rows in Bronze and Silver; OK when Silver has fewer columns."""
    def compare(name: str, bronze: DataFrame, silver: DataFrame) -> DataFrame:
        fewer = len(silver.columns) < len(bronze.columns)
        sides = bronze.agg(F.count("*").alias("bronze_rows")).unionByName(
            silver.agg(F.count("*").alias("silver_rows")), allowMissingColumns=True
        )
        return sides.agg(
            F.lit(name).alias("table_name"),
            F.lit(len(bronze.columns)).cast("bigint").alias("bronze_cols"),
            F.lit(len(silver.columns)).cast("bigint").alias("silver_cols"),
            F.max("bronze_rows").alias("bronze_rows"),
            F.max("silver_rows").alias("silver_rows"),
            F.lit("OK" if fewer else "PROBLEM").alias("status"),
        )

    return reduce(DataFrame.unionByName, [compare(name, *pair) for name, pair in pairs.items()])


def filled_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """Filled cells of the named columns, one row per column, in one pass."""
    if not names:
        return df.sparkSession.createDataFrame([], "column_name string, filled bigint")
    counts = df.agg(*[F.count(name).alias(name) for name in names])
    return counts.unpivot([], names, "column_name", "filled")


def removed_values(pairs: Mapping[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Columns that Silver no longer has, with the number of values each held in Bronze."""
    return reduce(DataFrame.unionByName, [
        filled_columns(bronze, sorted(r.column_name for r in sets.removed_columns(bronze, silver).collect())).select(
            F.lit(name).alias("table_name"), "column_name", "filled"
        )
        for name, (bronze, silver) in pairs.items()
    ])


def leaked_values(pairs: Mapping[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Per table: internal columns in Bronze, those still in Silver, and the values they show there."""
    def leaks(name: str, bronze: DataFrame, silver: DataFrame) -> DataFrame:
        leaked = sorted(r.column_name for r in sets.leaked_columns(bronze, silver).collect())
        shown = [F.count(c) for c in leaked] or [F.lit(0).cast("bigint")]
        return silver.agg(
            F.lit(name).alias("table_name"),
            F.lit(len(internal_columns(bronze))).cast("bigint").alias("internal_cols"),
            F.lit(len(leaked)).cast("bigint").alias("leaked_cols"),
            reduce(Column.__add__, shown).alias("leaked_values"),
            F.count("*").alias("silver_rows"),
        )

    return reduce(DataFrame.unionByName, [leaks(name, *pair) for name, pair in pairs.items()])
