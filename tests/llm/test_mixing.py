import duckdb
import pytest

from shelfstack.llm import mixing, sql


def documents(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, source string, copies int")


def test_targets_share_by_weight_and_stop_at_three_times_their_source(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 500), (None, 50)], "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(sizes).collect()}
    # Weights 5, 2, 1, 5: "a" and null are capped, the rest share what is over by 2 to 1.
    assert got == {"a": 30.0, None: 150.0, "b": pytest.approx(920.0), "c": pytest.approx(460.0)}
    assert sum(got.values()) == pytest.approx(1560)


def test_odd_rows(spark):
    rows = [(1, None, "a", 7), (2, "", None, 7), (3, "x y", "a", 7), (3, "x y", "a", 7), (None, "w " * 5000, None, None)]
    got = mixing.mixture(documents(spark, rows)).collect()
    assert len(got) == 5
    assert {r["size"] for r in got} == {0, 2, 5000}
    assert all(r["taken"] <= 3 * r["size"] for r in got)
    assert len({r["copies"] for r in got if r["doc_id"] == 3}) == 1
    assert mixing.mixture(documents(spark, [])).count() == 0
    assert mixing.mixed(documents(spark, [])).columns == ["doc_id", "text", "source", "copies"]
    assert mixing.mixture(documents(spark, [(1, "", "a", 1)])).collect()[0]["target"] == 0.0


def test_copies_come_near_targets_and_agree_with_sql(spark):
    rows = [(i, "word " * (1 + i % 50), f"s{i % 7 if i % 3 else 0}", 0) for i in range(6000)]
    docs = documents(spark, rows)
    mix = mixing.mixture(docs).toPandas().sort_values("doc_id")
    by = mix.groupby("source").agg(taken=("taken", "sum"), target=("target", "first"))
    assert ((by.taken / by.target - 1).abs() < 0.3).all()
    again = mixing.mixed(docs).groupBy("doc_id").count().toPandas().set_index("doc_id")["count"]
    assert again.to_dict() == {r.doc_id: r.copies for r in mix.itertuples() if r.copies}
    con = duckdb.connect()
    documents_table = docs.toPandas()  # noqa: F841, read by DuckDB
    con.execute("CREATE VIEW documents AS SELECT * FROM documents_table")
    want = con.execute(sql.MIXING).fetchdf().sort_values("doc_id")
    for column in ("doc_id", "size", "source_size", "target", "taken", "copies"):
        assert mix[column].tolist() == want[column].tolist(), column
