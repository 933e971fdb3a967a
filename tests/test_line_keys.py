"""Order lines of large tables have a key of their own each."""

import datetime

import pytest
from pyspark.sql import functions as F

from acceptance import queries
from acceptance.queries import QUERIES, Inputs

LINES = (
    "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, "
    "l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz")
NOON = datetime.datetime(1997, 5, 6, 12)


def line(order, part, supplier, number, quantity):
    return (order, part, supplier, number, quantity, 1.0, 0.0, 0.0, "N", "O", NOON)


def keys(spark, root, rows):
    spark.createDataFrame(rows, LINES).write.parquet(f"{root}/lineitem.parquet")
    found = queries._keyed_lines(Inputs(spark, str(root))).select("line_item_id", "order_id", "product_id", "quantity", "_warehouse_id").collect()
    return {(r.order_id, r.product_id, r._warehouse_id, r.quantity): r.line_item_id for r in found}, len(found)


def test_lines_with_few_digits_are_packed(spark, tmp_path):
    found, _ = keys(spark, tmp_path, [line(9_223_371, 99_999, 9_999, 9, 99.0), line(0, 0, 0, 0, 0.0), line(2, None, 5, 1, 3.0)])
    assert found == {(9_223_371, 99_999, "W9999", 99): 9_223_371_999_999_999_999, (0, 0, "W0", 0): 0, (2, None, "W5", 3): None}


@pytest.mark.parametrize("order, part, supplier", [(54_000_000, 7, 7), (3, 7_200_000, 7), (3, 7, 360_000)])
def test_lines_beyond_those_digits_are_told_apart(spark, tmp_path, order, part, supplier):
    # Packed, the first three would have one key: a digit too many of one column counts as one of the next.
    rows = [line(order, 100_000 + part, supplier, 1, 5.0), line(order, part, supplier, 2, 5.0), line(order, 99_999 + part, 10_000 + supplier, 1, 5.0)]
    rows += [line(order, part, supplier, 2, 6.0), line(order + 1, part, supplier, 2, 6.0)]
    rows += [line(order + 1, part, supplier, 2, 6.0)]  # comes twice
    odd = [line(order, None, supplier, 3, 5.0), line(None, order, supplier, 3, 5.0)]
    found, n = keys(spark, tmp_path, rows + odd)
    assert n == len(rows) + len(odd) and len(found) == n - 1
    unkeyed = [k for k, v in found.items() if v is None]
    assert sorted(unkeyed, key=str) == sorted([(order, None, f"W{supplier}", 5), (None, order, f"W{supplier}", 5)], key=str)
    assert len({v for v in found.values() if v is not None}) == len(found) - 2


def test_incremental_run_over_large_keys_gives_the_whole_tables(spark, tmp_path):
    base, root = 54_000_000, str(tmp_path / "large")
    day = lambda k: datetime.datetime(1995, 1, 1) + datetime.timedelta(days=k % 9)
    save = lambda name, rows, schema: spark.createDataFrame(rows, schema).write.parquet(f"{root}/{name}.parquet")
    save("part", [(base + k, f"part {k}", "Brand#1", "TIN", 1 + k, 900.0 + k) for k in range(20)],
         "p_partkey long, p_name string, p_brand string, p_type string, p_size int, p_retailprice double")
    save("customer", [(base + k, f"Customer#{k}", k % 5, 100.0, "AUTOMOBILE") for k in range(12)],
         "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string")
    save("orders", [(base + k, base + k % 11, "O", 50.0 + k, day(k), "2-HIGH") for k in range(80)],
         "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string")
    save("lineitem", [line(base + k % 80, base + k % 19, base + k % 7, 1 + k % 6, 1.0 + k % 50) for k in range(300)], LINES)
    save("events", [(k, day(k), k % 12, "view", 1.0, "{}") for k in range(20)],
         "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")
    save("documents", [(k, "a text of some words", "en", "web", 60) for k in range(8)], "doc_id long, text string, lang string, source string, n_chars long")
    save("labels", [(k, 1, 0) for k in range(8)], "doc_id long, quality int, toxic int")
    for table in ("daily_revenue", "customer_ltv"):
        whole, got = QUERIES[table](spark, root), QUERIES[f"run_incremental_{table}"](spark, root)
        order = sorted(whole.columns)
        assert whole.count() > 5
        assert sorted(map(str, got.select(*order).collect())) == sorted(map(str, whole.select(*order).collect()))
