"""Joins, set operations, ranking, profiles, quality rules and query correction."""

import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from shelfstack.operators import joins, profile, quality, ranking, search, sessions, sets
from tests.conftest import rows


def test_lookup_keeps_every_fact_row(spark):
    fact = spark.createDataFrame([(i, 7 if i % 3 else None) for i in range(30)] + [(30, 8), (31, 9)], "id long, key long")
    dim = spark.createDataFrame([(7, "seven"), (9, "nine"), (9, "neun"), (None, "void")], "code long, word string")
    got = rows(joins.lookup(fact, dim, "key", spread_by="id", dimension_key="code"), "id", "key", "word")
    expected = [(i, 7, "seven") if i % 3 else (i, None, None) for i in range(30)]
    assert got == sorted([*expected, (30, 8, None), (31, 9, "nine"), (31, 9, "neun")], key=repr)


def test_parents(spark):
    child = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "key long, v string")
    parent = spark.createDataFrame([(1,), (1,), (3,)], "key long")
    assert rows(joins.with_parent(child, parent, "key")) == [(1, "a"), (1, "b")]
    assert rows(joins.without_parent(child, parent, "key")) == [(2, "c"), (None, "d")]


def test_foreign_key_violations(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (2,), (5,), (None,)], "fk long")
    parent = spark.createDataFrame([(1,), (1,)], "pk long")
    fk = joins.ForeignKey
    got = joins.foreign_key_violations([
        fk("some", child, "fk", parent, "pk"), fk("none", child.limit(0), "fk", parent, "pk")
    ])
    assert rows(got) == [("none", 0, 0, 0), ("some", 5, 3, 2)]


def test_documented_relations(spark):
    users = spark.createDataFrame([(1, "FR"), (2, "DE")], "user_id long, country_code string")
    orders = spark.createDataFrame([(10, 1), (11, 3), (12, None)], "order_id long, user_id long")
    tables = {"users": users, "orders": orders}
    got = joins.follow(tables, "orders", "user_id", ["country_code"], "order_id")
    assert rows(got, "order_id", "user_id", "country_code") == [(10, 1, "FR"), (11, 3, None), (12, None, None)]
    assert rows(joins.foreign_key_violations(joins.foreign_keys(tables))) == [("orders.user_id", 2, 1, 1)]
    with pytest.raises(ValueError):
        joins.follow(tables, "orders", "status", ["country_code"], "order_id")


def test_set_operations(spark):
    a = spark.createDataFrame([(1, "x")], "id long, a string")
    b = spark.createDataFrame([("y", 2)], "b string, id long")
    assert rows(sets.stack_rows([a, b]), "id", "a", "b") == [(1, "x", None), (2, None, "y")]
    before = spark.createDataFrame([], "id long, _x int, _y int, gone string")
    after = spark.createDataFrame([], "id long, _y int")
    assert rows(sets.removed_columns(before, after)) == [("_x",), ("gone",)]
    assert rows(sets.leaked_columns(before, after)) == [("_y",)]
    assert rows(sets.leaked_columns(before, after.drop("_y"))) == []


def test_order_of_nulls(spark):
    df = spark.createDataFrame([(2,), (None,), (1,)], "a int")
    assert [r.a for r in df.orderBy(ranking.ascending("a")).collect()] == [1, 2, None]
    assert [r.a for r in df.orderBy(ranking.descending("a")).collect()] == [None, 2, 1]


def test_top_k(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 9.0), (3, 5.0), (4, None)], "id long, v double")
    top = ranking.top_k(df, "v", 2, "id")
    assert [r.id for r in top.collect()] == [4, 2]
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()


def test_preview(spark):
    assert ranking.preview(spark.range(20)).count() == 5
    assert ranking.preview(spark.range(2)).count() == 2


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
@pytest.mark.parametrize("unit", ["minute", "hour"])
def test_number_events(spark, kind, unit):
    pick = random.Random(5)
    data = [
        (i, "hot" if i % 3 == 0 else pick.choice(["a", "b", None]), pick.choice([None, *range(-2000, 9000, 13)]))
        for i in range(400)
    ]
    # around the hour that New York skips in spring
    df = spark.createDataFrame(data, "event long, session string, secs int").withColumn(
        "ts", (F.lit("2024-03-10 01:30:00").cast(kind) + F.make_dt_interval(secs="secs")).cast(kind)
    )
    expected = {}
    for session in ("hot", "a", "b"):
        mine = sorted((r for r in data if r[1] == session), key=lambda r: (r[2] is not None, r[2] or 0, r[0]))
        expected |= {r[0]: place for place, r in enumerate(mine, start=1)}
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for other in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", other)
            numbered = ranking.number_events(df, "session", "ts", "event", slice_unit=unit)
            assert {r.event: r.event_seq for r in numbered.collect()} == {r[0]: expected.get(r[0]) for r in data}
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_session_summary(spark):
    df = spark.sql("""
        SELECT * FROM VALUES ('s', timestamp_ntz '2026-01-01 00:00:00.25', '/a'), ('s', timestamp_ntz '2026-01-02 00:00:01', '/a'),
          ('t', timestamp_ntz '2026-01-01 00:00:00', NULL) AS t(session_id, timestamp, page_path)""")
    got = {r.session_id: (r.events, r.pages, r.duration_seconds) for r in sessions.summarize_sessions(df).collect()}
    assert got == {"s": (2, 1, 86400.75), "t": (1, 0, 0.0)}


def test_counts_and_shape(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "v string")
    assert rows(profile.value_counts(df, "v")) == [("a", 2), (None, 1)]
    assert rows(profile.shape(df)) == [(3, 1)]
    assert rows(profile.distinct_values(df, "v")) == [("a",), (None,)]
    assert rows(sets.table_counts({"t": df, "e": df.limit(0)})) == [("e", 0), ("t", 3)]


@pytest.mark.parametrize("exact", [True, False])
def test_column_profile(spark, exact):
    df = spark.sql("""
        SELECT * FROM VALUES (1L, 'a', array(1), repeat('x', 100)), (1L, NULL, array(1, 2), repeat('x', 100)),
          (2L, 'b', NULL, repeat('y', 100)) AS t(n, s, arr, long_text)""")
    got = rows(profile.column_profile(df, exact), "column_name", "rows", "nulls", "distinct_values", "data_type")
    assert got == [
        ("arr", 3, 1, 2, "array<int>"), ("long_text", 3, 0, 2, "string"), ("n", 3, 0, 2, "bigint"), ("s", 3, 1, 2, "string")
    ]


def test_distinct_values_that_look_alike(spark):
    df = spark.sql("""
        SELECT * FROM VALUES (array('a, b'), 0.0D), (array('a', 'b'), -0.0D), (array('a', 'b'), 1.0D) AS t(a, d)""")
    assert rows(profile.column_profile(df), "column_name", "distinct_values") == [("a", 2), ("d", 2)]


@pytest.mark.parametrize("size", [1, 2, 3, 4, 5, 1000, 4001])
def test_exact_quartiles(spark, size):
    pick = random.Random(size)
    # A third of the values are the same.
    values = [50.0 if i % 3 == 0 else round(pick.lognormvariate(3, 2), 2) for i in range(size)]
    df = spark.createDataFrame([(v, int(v)) for v in values] + [(None, None), (float("nan"), None)], "a double, b long")
    got = {r.column_name: r for r in profile.numeric_profile(df, ["a", "b"]).collect()}
    for name, data in (("a", values), ("b", [float(int(v)) for v in values])):
        row = got[name]
        assert row["count"] == size and row["min"] == min(data) and row["max"] == max(data)
        assert math.isclose(row["mean"], statistics.fmean(data), rel_tol=1e-12)
        if size > 1:
            assert math.isclose(row["std"], statistics.stdev(data), rel_tol=1e-9, abs_tol=1e-9)
        ordered = sorted(data)
        for column, p in profile.QUARTILES.items():
            place = p * (size - 1)
            low, high = ordered[math.floor(place)], ordered[math.ceil(place)]
            assert math.isclose(row[column], low + (high - low) * (place - math.floor(place)), rel_tol=1e-12)


def test_quartiles_do_not_depend_on_the_brackets(spark):
    df = spark.range(1, 1002).select(F.col("id").cast("double").alias("a"))
    for margin, pieces in ((1e-7, 1000), (0.0005, 1), (0.0005, 7), (0.2, 3)):
        row = profile.numeric_profile(df, ["a"], margin=margin, pieces=pieces).first()
        assert (row.p25, row.p50, row.p75) == (251.0, 501.0, 751.0)
    wide = spark.createDataFrame([(float(v),) for v in ("-inf", "1", "2", "3", "inf")], "a double")
    row = wide.transform(lambda d: profile.numeric_profile(d.filter("a < 1e300"), ["a"])).first()
    assert row.p50 == 1.5


def test_sketch_quartiles(spark):
    row = profile.numeric_profile(spark.range(1, 1002), ["id"], exact=False).first()
    assert abs(row.p50 - 501) <= 2


def test_order_and_line_violations(spark, orders, lines):
    assert rows(quality.order_total_violations(orders), "order_id") == [(2,)]
    assert rows(quality.line_total_violations(lines), "line_item_id") == [(2,), (7,)]


def test_any_and_all(spark, orders):
    gap = quality.order_total_gap(orders)
    assert quality.any_broken(orders, gap > 0.01).first().any_broken is True
    assert quality.any_broken(orders, gap > 100).first().any_broken is False
    assert quality.any_broken(orders.limit(0), gap > 0.01).first().any_broken is False
    counts = spark.createDataFrame([("a", 1), ("b", 0)], "table_name string, rows long")
    assert tuple(quality.all_filled(counts, 2).first()) == (2, True, False)
    assert tuple(quality.all_filled(counts.filter("rows > 0"), 2).first()) == (1, False, True)


def test_unexpected_values(spark):
    df = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "v string")
    assert rows(quality.unexpected_values(df, "v", ("a",))) == [("v", "b", 2), ("v", None, 1)]


def test_conditional_fields(spark):
    df = spark.createDataFrame(
        [("email_clicked", "/x", None), ("email_clicked", None, None), ("email_sent", "/x", None),
         ("email_bounced", None, "hard"), (None, None, "hard"), (None, None, None)],
        "event_type string, clicked_url string, bounce_type string",
    )
    got = quality.rule_counts(df, quality.iff_rules(quality.MARKETING_FIELDS))
    assert rows(got) == [("bounce_type_iff_bounced", 1), ("clicked_url_iff_clicked", 2)]


def test_sign_rules(spark):
    payments = spark.createDataFrame(
        [(-1.0, "refund"), (-1.0, "charge"), (-1.0, None), (1.0, "refund"), (1.0, "charge"), (None, "refund")],
        "amount_usd double, transaction_type string",
    )
    got = quality.stack_rules({"payments": quality.rule_counts(payments, quality.payment_sign_rules())})
    assert rows(got) == [("payments", "negative_without_refund", 2), ("payments", "refund_not_negative", 1)]


def test_layer_checks(spark):
    bronze = spark.createDataFrame([(1, "x", None), (2, "y", "z")], "id long, _a string, _b string")
    clean, leaky = bronze.drop("_a", "_b"), bronze.drop("_b").filter("id = 1")
    pairs = {"clean": (bronze, clean), "leaky": (bronze, leaky), "same": (bronze, bronze)}
    assert rows(quality.layer_columns(pairs)) == [
        ("clean", 3, 1, 2, 2, "OK"), ("leaky", 3, 2, 2, 1, "OK"), ("same", 3, 3, 2, 2, "PROBLEM")
    ]
    assert rows(quality.leaked_values(pairs)) == [("clean", 2, 0, 0, 2), ("leaky", 2, 1, 1, 1), ("same", 2, 2, 3, 2)]
    assert rows(quality.removed_values(pairs)) == [("clean", "_a", 2), ("clean", "_b", 1), ("leaky", "_b", 1)]


def test_reconciliation(spark):
    orders = spark.createDataFrame(
        [("shipped", 10.1), ("returned", 5.2), ("cancelled", 7.0), (None, 1.0)], "status string, total_usd double"
    )
    days = spark.createDataFrame([(10.1,), (5.2,)], "total_revenue double")
    assert tuple(quality.revenue_reconciliation(days, orders).first()) == (15.3, 15.3, True)
    assert quality.revenue_reconciliation(days.limit(1), orders).first().matches is False
    assert quality.revenue_reconciliation(days.limit(0), orders).first().matches is False


def edits(a, b):
    last = list(range(len(b) + 1))
    for i, x in enumerate(a, start=1):
        row = [i]
        for j, y in enumerate(b, start=1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        last = row
    return last[-1]


def test_query_correction_against_all_pairs(spark):
    pick = random.Random(11)
    words = ["", "a", "ab", "red shoe", "blue shoe", "red shoes", "air max", "aab", *[
        "".join(pick.choice("abc") for _ in range(pick.randrange(1, 9))) for _ in range(60)
    ]]
    queries = [*words, "  RED   Shoe ", None, *[
        "".join(pick.choice("abcd") for _ in range(pick.randrange(0, 10))) for _ in range(120)
    ]]
    events = spark.createDataFrame(list(enumerate(queries)), "id long, q string")
    terms = spark.createDataFrame([(w,) for w in words if w], "term string")
    known = sorted({w for w in words if w})
    got = {
        r.id: (r.query_corrected, r.edit_distance)
        for r in search.correct_queries(events, terms, "q", "term", "id").collect()
    }
    assert len(got) == len(queries)
    for i, query in enumerate(queries):
        clean = None if query is None else " ".join(query.lower().split())
        near = [] if clean is None else sorted((edits(clean, w), w) for w in known if edits(clean, w) <= 2)
        assert got[i] == ((near[0][1], near[0][0]) if near else (None, None)), (query, near[:1])


def test_corrections_of_short_long_and_many_worded_queries(spark):
    import random

    rng = random.Random(5)
    words = ["".join(rng.choice("abc") for _ in range(rng.randint(0, 7))) for _ in range(80)] + ["red running shoe", "blue running shoe", "x" * 300]

    def changed(word):
        letters = list(word)
        for _ in range(rng.randint(0, 3)):
            at, kind = rng.randint(0, len(letters)), rng.randint(0, 2)
            letters[at : at + (kind > 0)] = [] if kind == 2 else [rng.choice("abc")]
        return "".join(letters)

    queries = sorted({changed(rng.choice(words)) for _ in range(150)} | {"rd runing shoe", "x" * 298, "y" + "x" * 299})

    def distance(one, two):
        row = list(range(len(two) + 1))
        for i, c in enumerate(one, 1):
            before, row[0] = row[0], i
            for j, d in enumerate(two, 1):
                before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (c != d))
        return row[-1]

    frames = spark.createDataFrame([(q,) for q in queries], "query_clean string"), spark.createDataFrame([(w,) for w in set(words)], "term string")
    for edits in (1, 2):
        got = {tuple(r) for r in search.candidate_pairs(*frames, edits).collect()}
        near = {(q, w) for q in queries for w in set(words) if abs(len(q) - len(w)) <= edits and distance(q, w) <= edits}
        assert near <= got
    # Rows do not grow with the length: three segments a term, and at most 3 places of 3 segments for 5 lengths.
    assert search.segments(frames[1], 2).count() == 3 * len(set(words))
    assert search._probes(frames[0].filter("length(query_clean) > 200"), 2).count() <= 2 * 45


def test_clustered_quartiles_are_cut_until_no_piece_is_large(spark, monkeypatch):
    pick = random.Random(3)
    values = [1.0 + pick.randrange(4000) * 1e-12 for _ in range(2000)] + [7.0] * 900 + [1e300, -1e300, float("inf"), float("-inf")]
    held = []
    real = profile._bracket_frame
    monkeypatch.setattr(profile, "_bracket_frame", lambda values, brackets: held.append(brackets) or real(values, brackets))
    df = spark.createDataFrame([(v,) for v in values], "a double").repartition(3)
    row = profile.numeric_profile(df, ["a"], margin=0.2, pieces=4, most_rows=60).first()
    ordered = sorted(values)
    for name, p in profile.QUARTILES.items():
        place = p * (len(values) - 1)
        low, high = ordered[math.floor(place)], ordered[math.ceil(place)]
        assert math.isclose(row[name], low + (high - low) * (place - math.floor(place)), rel_tol=1e-15)
    assert len(held) > 2
    assert all(b["rows"] <= 60 or b["low"] == b["high"] for b in held[-1])
    assert any(b["rows"] > 60 and b["low"] == b["high"] for b in held[-1])  # the 7.0s are counted, not ranked
