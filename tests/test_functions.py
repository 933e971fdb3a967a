from datetime import datetime

import pytest
from pyspark.sql import functions as F

from shelfstack.functions import dates, text, values
from shelfstack.operators import carts, columns
from tests.conftest import rows


def value(spark, col):
    return spark.range(1).select(col.alias("v")).first().v


@pytest.mark.parametrize("raw,expected", [
    ("  a b ", "a b"), ("\t\na\r", "a"), ("  x　", "x"), ("", ""), (" ", ""), (None, None),
])
def test_strip_whitespace(spark, raw, expected):
    assert value(spark, text.strip_whitespace(F.lit(raw).cast("string"))) == expected


@pytest.mark.parametrize("raw,expected", [
    ("true", True), ("False", False), ("1", True), ("0", False), ("0.0", False), ("2.5", True), ("No", False),
    ("yes", True), ("junk", False), (None, False), ("NaN", False),
])
def test_flag_from_text(spark, raw, expected):
    assert value(spark, values.flag(F.lit(raw).cast("string"))) is expected


@pytest.mark.parametrize("raw,expected", [(0, False), (1, True), (-3, True), (0.0, False), (0.5, True), (True, True)])
def test_flag_from_numbers(spark, raw, expected):
    assert value(spark, values.flag(F.lit(raw))) is expected


@pytest.mark.parametrize("raw,expected", [
    ("2026-02-11", datetime(2026, 2, 11)), ("2026-02-11 10:00:00", datetime(2026, 2, 11, 10)),
    ("2026-02-11T10:00:00", datetime(2026, 2, 11, 10)), ("2026-02-30", None), ("2026-02", None), ("2026", None),
    ("11/02/2026", None), ("bad", None), ("", None), (None, None),
    ("2026/2/11", datetime(2026, 2, 11)), ("2026/02/11 10:00:00", datetime(2026, 2, 11, 10)), ("20260211", datetime(2026, 2, 11)),
    ("11.2.2026", datetime(2026, 2, 11)), ("31/01/2026", datetime(2026, 1, 31)), ("01/31/2026 08:00:00", datetime(2026, 1, 31, 8)),
    ("2026-02-11T10:00:00+02:00", datetime(2026, 2, 11, 8)), ("2026-02-11 00:30:00+0100", datetime(2026, 2, 10, 23, 30)),
    ("2026-02-11T10:00:00Z", datetime(2026, 2, 11, 10)), ("2026-02-11T10:00:00.5-01:30", datetime(2026, 2, 11, 11, 30, 0, 500000)),
    ("2026-02-11T10:00:00-05", datetime(2026, 2, 11, 15)), ("2026/13/01", None), ("2026021", None), ("32.1.2026", None), ("13/13/2026", None),
])
def test_parse_timestamp(spark, raw, expected):
    assert value(spark, dates.parse_timestamp(F.lit(raw).cast("string"))) == expected


@pytest.mark.parametrize("raw,expected", [("7", 7), ("7.0", 7), ("7.00", 7), ("7.5", None), ("x", None), ("-3", -3)])
def test_whole_number(spark, raw, expected):
    assert value(spark, values.whole_number(F.lit(raw))) == expected


@pytest.mark.parametrize("raw,expected", [
    (1.15, 115), (-1.15, -115), (0.29, 29), (1234567.89, 123456789), (0.005, 1), (-0.005, -1), (0.0, 0),
    (None, None), (float("nan"), None), (7, 700),
    (1e14, 10**16), (-9e16, -9 * 10**18), (1e-8, 0),
])
def test_cents(spark, raw, expected):
    col = F.lit(raw) if isinstance(raw, int) else F.lit(raw).cast("double")
    assert value(spark, values.cents(col)) == expected


@pytest.mark.parametrize("raw", [float("inf"), float("-inf"), 1e300])
def test_amounts_out_of_range_stop_the_query(spark, raw):
    with pytest.raises(Exception, match="amount out of range"):
        value(spark, values.cents(F.lit(raw).cast("double")))


def test_cents_of_every_amount(spark):
    df = spark.range(-200_000, 200_000).select("id", (F.col("id") / 100).alias("a"), (F.col("id") * 7919 / 100).alias("b"))
    wrong = (values.cents(F.col("a")) != F.col("id")) | (values.cents(F.col("b")) != F.col("id") * 7919)
    back = values.dollars(F.col("id")) != F.col("a")
    assert df.filter(wrong | back).count() == 0


def test_whole_days_are_full_days(spark):
    start, end = (F.lit(s).cast("timestamp_ntz") for s in ("2026-02-10 23:00:00", "2026-02-12 01:00:00"))
    assert value(spark, values.whole_days(start, end)) == 1


def test_rounding(spark):
    assert value(spark, values.rounded(F.lit(2.675))) == 2.68
    assert value(spark, values.rounded(F.lit(None).cast("double"))) is None


def test_json_columns(spark):
    assert value(spark, values.string_list(F.lit('["S", "M"]'))) == ["S", "M"]
    assert value(spark, values.string_list(F.lit("not json"))) is None
    assert value(spark, values.string_map(F.lit('{"brand": "A"}'))) == {"brand": "A"}


def test_tags(spark):
    assert value(spark, text.tag_array(F.lit("a|b c|d"))) == ["a", "b c", "d"]
    assert value(spark, text.tag_array(F.lit("a, b c, d"))) == ["a", "b c", "d"]


def test_clean_query(spark):
    assert value(spark, text.clean_query(F.lit("  Red \t  SHOE \n"))) == "red shoe"


def test_mask(spark, users):
    df = columns.mask(users, {"email": "hash", "phone": "phone_country", "first_name": "drop", "absent": "drop"})
    first = {r.user_id: r for r in df.collect()}
    assert "first_name" not in df.columns
    assert len(first[2].email) == 64 and first[4].email is None and first[1].phone == "+33"
    with pytest.raises(ValueError):
        columns.mask(users, {"email": "blur"})


def test_presentable(spark):
    df = spark.createDataFrame([(1.005, None), (2.344, 3)], "amount double, items long")
    assert rows(columns.presentable(df, ("amount",), ("items",))) == [(1.01, 0), (2.34, 3)]


def test_flatten_items(spark):
    carts_df = spark.sql("""
        SELECT 'a' AS cart_id, array(named_struct('product_id', 1L, 'quantity', 2L), named_struct('product_id', 2L, 'quantity', 1L)) AS items
        UNION ALL SELECT 'b', array() UNION ALL SELECT 'c', NULL""")
    assert rows(carts.flatten_items(carts_df)) == [
        ("a", 1, 2), ("a", 2, 1), ("b", None, None), ("c", None, None)
    ]


def test_the_column_says_which_number_is_the_day(spark):
    frame = lambda *texts: spark.createDataFrame([(t,) for t in texts], "d string")
    days = frame("03/04/2024", "25/12/2024", "2024-01-01", None, "soon", "2024-01-01T10:00:00Z", "20240101", "1.1.2024", "2024/1/1")
    assert {r.format: r.cnt for r in dates.date_formats(days, "d").collect()} == {
        "ambiguous": 1, "day_first": 1, "iso": 1, "iso_offset": 1, "missing": 1, "other": 1, "compact": 1, "dotted": 1, "year_first": 1}
    assert dates.day_first(days, "d") is True
    assert dates.day_first(frame("03/04/2024", "12/25/2024"), "d") is False
    assert dates.day_first(frame("03/04/2024"), "d") is None and dates.day_first(frame("25/12/2024", "12/25/2024"), "d") is None
    read = lambda order: value(spark, dates.parse_timestamp(F.lit("03/04/2024"), order))
    assert (read(True), read(False), read(None)) == (datetime(2024, 4, 3), datetime(2024, 3, 4), None)
    both = frame("03/04/2024", "05/05/2024", "25/12/2024", "x")
    assert [r.a for r in both.select(dates.is_ambiguous(F.col("d")).alias("a")).collect()] == [True, False, False, False]
