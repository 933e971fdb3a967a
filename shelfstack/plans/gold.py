"""Silver to Gold: business aggregates.

Facts are collapsed per key before they meet another table. A key with a large share of all rows
is then a few rows per task in the shuffle, and no join multiplies rows. Amounts are summed as
whole cents, so results do not depend on how the rows are split. Keys need not be unique: where
plain SQL joins would repeat rows, the number of repeats is carried along and multiplied in.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfstack.functions.values import cents, dollars, string_list, total_of, whole_days
from shelfstack.operators.joins import lookup
from shelfstack.operators.ranking import ascending, descending
from shelfstack.settings import EMAIL_EVENTS, FUNNEL_STEPS, NON_REVENUE_STATUSES


def revenue_orders(orders: DataFrame) -> DataFrame:
    """Orders that count as revenue; a NULL status does not."""
    return orders.filter(~F.col("status").isin(*NON_REVENUE_STATUSES))


def _per(part: Column, whole: str) -> Column:
    """``part`` divided by ``whole``, NULL for 0."""
    return part.cast("double") / F.nullif(F.col(whole).cast("double"), F.lit(0.0))


def _share(part: str, whole: str) -> Column:
    return _per(F.col(part), whole)


def _orders_with_lines(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Per revenue order and day: its rows, its total in cents, and the rows and quantity of its lines.

    Orders are joined first: both sides then lie by order, and grouping by order needs no shuffle.
    """
    per_line_order = lines.groupBy("order_id").agg(
        F.count("*").alias("line_rows"), F.sum("quantity").alias("quantity")
    )
    return (
        revenue_orders(orders)
        .select("order_id", F.to_date("order_date").alias("order_date"), cents(F.col("total_usd")).alias("cents"))
        .join(per_line_order, "order_id", "left")
        .groupBy("order_id", "order_date")
        .agg(
            F.count("*").alias("order_rows"),
            F.sum("cents").alias("total"),
            F.count("cents").alias("priced_rows"),
            F.max("line_rows").alias("line_rows"),
            F.max("quantity").alias("quantity"),
        )
    )


def revenue_by_variant(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """``variant, reported_revenue`` of both daily revenues, from one join of orders and lines."""
    days = _orders_with_lines(orders, lines).groupBy("order_date").agg(
        F.sum(F.col("total") * F.coalesce(F.col("line_rows"), F.lit(1))).alias("per_line"), F.sum("total").alias("exact"))
    names = ["per_line", "exact"]
    sums = days.agg(*[total_of(dollars(F.col(name))).alias(name) for name in names])
    return sums.unpivot([], names, "variant", "reported_revenue")


def daily_revenue(orders: DataFrame, lines: DataFrame, exact: bool = False, ordered: bool = True) -> DataFrame:
    """Orders, revenue, average order value and items per day.

    The default counts the total of an order once per line it has, as the plain LEFT JOIN of orders
    and lines does; ``exact=True`` counts it once. ``ordered`` is for reading; a table needs no order.
    """
    repeats = F.lit(1) if exact else F.coalesce(F.col("line_rows"), F.lit(1))
    per_order = _orders_with_lines(orders, lines)
    days = (
        per_order.groupBy("order_date")
        .agg(
            F.count("order_id").alias("total_orders"),
            F.sum(F.col("total") * repeats).alias("revenue"),
            F.sum(F.col("priced_rows") * repeats).alias("priced_rows"),
            F.sum(F.col("quantity") * F.col("order_rows")).alias("total_items"),
        )
        .select(
            "order_date",
            "total_orders",
            dollars(F.col("revenue")).alias("total_revenue"),
            _per(dollars(F.col("revenue")), "priced_rows").alias("avg_order_value"),
            "total_items",
        )
    )
    return days.orderBy(ascending("order_date")) if ordered else days


def product_performance(
    lines: DataFrame,
    products: DataFrame,
    orders: DataFrame,
    ordered: bool = True,
    product_name: bool = False,
) -> DataFrame:
    """Quantity, revenue, orders and average price per sold product.

    ``product_name=True`` gives the name column its documented name instead of ``model_name``.
    """
    sold = revenue_orders(orders).groupBy("order_id").agg(F.count("*").alias("order_rows"))
    repeated = F.col("order_rows")
    # Lines cross the network once, by order; grouping by (order, product) is then local.
    per_pair = lines.select(
        "order_id", "product_id", "quantity", cents(F.col("line_total_usd")).alias("revenue"), cents(F.col("unit_price_usd")).alias("price")
    ).join(sold, "order_id").groupBy("order_id", "product_id").agg(
        F.sum(F.col("quantity") * repeated).alias("quantity"),
        F.sum(F.col("revenue") * repeated).alias("revenue"),
        F.sum(F.col("price") * repeated).alias("prices"),
        F.sum(F.when(F.col("price").isNotNull(), repeated).otherwise(0)).alias("priced_rows"),
    )
    measures = ("quantity", "revenue", "num_orders", "prices", "priced_rows")
    sales = per_pair.groupBy("product_id").agg(
        *[F.sum(m).alias(m) for m in measures if m != "num_orders"], F.count("*").alias("num_orders"))
    described = products.select("product_id", "model_name", "brand", "category")
    table = sales.join(described, "product_id").groupBy("product_id", "model_name", "brand", "category").agg(
        F.count("*").alias("product_rows"), *[F.first(m).alias(m) for m in measures]
    ).select(
        "product_id",
        "model_name",
        "brand",
        "category",
        (F.col("quantity") * F.col("product_rows")).alias("total_quantity_sold"),
        dollars(F.col("revenue") * F.col("product_rows")).alias("total_revenue"),
        "num_orders",
        _per(dollars(F.col("prices")), "priced_rows").alias("avg_unit_price"),
    )
    if product_name:
        table = table.withColumnRenamed("model_name", "product_name")
    return table.orderBy(descending("total_revenue")) if ordered else table


def customer_ltv(orders: DataFrame, users: DataFrame, ordered: bool = True) -> DataFrame:
    """Orders, spending and tenure per customer."""
    spending = (
        revenue_orders(orders)
        .groupBy("user_id")
        .agg(
            F.count_distinct("order_id").alias("total_orders"),
            F.sum(cents(F.col("total_usd"))).alias("spent"),
            F.count(cents(F.col("total_usd"))).alias("priced_rows"),
            F.min("order_date").alias("first_order_date"),
            F.max("order_date").alias("last_order_date"),
        )
    )
    described = users.select("user_id", "email", "first_name", "last_name", "loyalty_tier")
    measures = ("total_orders", "spent", "priced_rows", "first_order_date", "last_order_date")
    table = spending.join(described, "user_id").groupBy(*described.columns).agg(
        F.count("*").alias("user_rows"), *[F.first(m).alias(m) for m in measures]
    ).select(
        "user_id",
        "email",
        "first_name",
        "last_name",
        "loyalty_tier",
        "total_orders",
        dollars(F.col("spent") * F.col("user_rows")).alias("total_spent"),
        _per(dollars(F.col("spent")), "priced_rows").alias("avg_order_value"),
        "first_order_date",
        "last_order_date",
        whole_days(F.col("first_order_date"), F.col("last_order_date")).alias("days_as_customer"),
    )
    return table.orderBy(descending("total_spent")) if ordered else table


def funnel_analysis(events: DataFrame, steps: tuple[str, ...] = FUNNEL_STEPS) -> DataFrame:
    """Sessions that reached each step, and their share of the sessions of the first step."""
    per_session = (
        events.filter(F.col("event_type").isin(*steps) & F.col("session_id").isNotNull())
        .groupBy("session_id")
        .agg(*[F.bool_or(F.col("event_type") == step).alias(step) for step in steps])
    )
    totals = per_session.agg(*[F.count_if(F.col(step)).alias(step) for step in steps])
    numbers = F.create_map(*[F.lit(x) for i, step in enumerate(steps, start=1) for x in (step, i)])
    return (
        totals.withColumn("first_sessions", F.col(steps[0]))
        .unpivot(["first_sessions"], list(steps), "step", "sessions")
        .select(
            numbers[F.col("step")].alias("step_no"),
            "step",
            "sessions",
            _share("sessions", "first_sessions").alias("rate"),
        )
    )


def funnel_in_order(
    events: DataFrame, ts: str = "timestamp", event: str = "event_id", steps: tuple[str, ...] = FUNNEL_STEPS
) -> DataFrame:
    """Sessions that took the steps one after the other, and their share of the sessions of the first step.

    A step counts from its earliest event after the earliest time the step before was reached; of equal stamps
    the smaller ``event`` is first. Events without a stamp or session have no place in the order. Each step's
    events cross the network once, and a session is one row per task by then, however many events it has.
    """
    moment = F.struct(F.col(ts).alias("ts"), F.col(event).alias("event"))
    placed = events.filter(F.col("session_id").isNotNull() & F.col(ts).isNotNull())
    reached: list[DataFrame] = []
    for step in steps:
        of_step = placed.filter(F.col("event_type") == step).select("session_id", moment.alias("moment"))
        if reached:
            before = reached[-1].withColumnRenamed("moment", "before")
            of_step = of_step.join(before, "session_id").filter(F.col("moment") > F.col("before"))
        reached.append(of_step.groupBy("session_id").agg(F.min("moment").alias("moment")))
    counts = reduce(DataFrame.unionByName, [
        frame.agg(F.lit(i).alias("step_no"), F.lit(step).alias("step"), F.count("*").alias("sessions"))
        for i, (step, frame) in enumerate(zip(steps, reached), start=1)
    ])
    rows = counts.agg(F.array_sort(F.collect_list(F.struct("step_no", "step", "sessions"))).alias("rows"))  # one per step
    table = rows.select(F.col("rows")[0]["sessions"].alias("first_sessions"), F.inline("rows"))
    return table.select("step_no", "step", "sessions", _share("sessions", "first_sessions").alias("rate"))


def inventory_status(inventory: DataFrame) -> DataFrame:
    """Current stock per product from the signed movements."""
    return inventory.groupBy("product_id").agg(
        F.sum("signed_quantity").alias("current_stock"), F.count("*").alias("movements")
    )


def campaign_performance(marketing: DataFrame) -> DataFrame:
    """Email counts and rates per campaign."""
    counts = marketing.groupBy("campaign_id").agg(*[
        F.count_if(F.col("event_type") == event).alias(event.removeprefix("email_")) for event in EMAIL_EVENTS
    ])
    return counts.withColumns({
        "delivery_rate": _share("delivered", "sent"),
        "open_rate": _share("opened", "delivered"),
        "click_rate": _share("clicked", "opened"),
        "bounce_rate": _share("bounced", "sent"),
    })


def payment_summary(payments: DataFrame) -> DataFrame:
    """Transactions and net amount per type and status."""
    return payments.groupBy("transaction_type", "status").agg(
        F.count("*").alias("transactions"), dollars(F.sum(cents(F.col("amount_usd")))).alias("net_amount")
    )


def brand_category_performance(performance: DataFrame) -> DataFrame:
    """Product performance rolled up by brand and category."""
    return performance.groupBy("brand", "category").agg(
        F.count_distinct("product_id").alias("products_sold"),
        F.sum("total_quantity_sold").alias("total_quantity_sold"),
        total_of(F.col("total_revenue")).alias("total_revenue"),
    )


def product_conversion(performance: DataFrame, interactions: DataFrame) -> DataFrame:
    """Orders per interaction of each sold product; no interaction, no rate."""
    touched = interactions.groupBy("product_id").agg(F.count("*").alias("interactions"))
    return (
        performance.join(touched, "product_id", "left")
        .select("product_id", "num_orders", F.coalesce("interactions", F.lit(0)).alias("interactions"))
        .withColumn("conversion", _share("num_orders", "interactions"))
    )


def orders_enriched(orders: DataFrame, users: DataFrame) -> DataFrame:
    """Orders with country and tier of the customer."""
    return lookup(orders, users.select("user_id", "country_code", "loyalty_tier"), "user_id", spread_by="order_id")


def lines_enriched(lines: DataFrame, products: DataFrame) -> DataFrame:
    """Order lines with brand and category of the product."""
    return lookup(lines, products.select("product_id", "brand", "category"), "product_id", spread_by="order_id")


def product_sizes(products: DataFrame) -> DataFrame:
    """One row per product and size on offer, from the JSON list of sizes."""
    return products.select("product_id", F.explode(string_list(F.col("available_sizes_json"))).alias("size"))
