import datetime
import json

import pytest
from pyspark.errors import AnalysisException

from shelfstack.settings import Settings
from shelfstack.sources import files, registry, schemas, tables
from shelfstack.sinks import tables as sinks
from tests.conftest import rows


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_csv_cells(spark, tmp_path):
    path = write(tmp_path / "p.csv", (
        "id,name,sizes,country,extra\n"
        '1,None,"[""S"", ""M""]",NA,x\n'
        '2,NA,,FR,"a,b"\n'
        '3,"quoted ""word""",[],DE,null\n'
        "4,, ,NULL,nan\n"
    ))
    df = files.read_csv(spark, path, {"id": "bigint"}, na_exempt=("country",))
    assert df.dtypes[0] == ("id", "bigint")
    assert rows(df) == [
        (1, None, '["S", "M"]', "NA", "x"),
        (2, None, None, "FR", "a,b"),
        (3, 'quoted "word"', "[]", "DE", None),
        (4, None, " ", "NULL", None),
    ]
    assert rows(files.read_csv(spark, path), "country")[0] == ("DE",)
    assert (None,) in rows(files.read_csv(spark, path), "country")


def test_csv_types_by_name(spark, tmp_path):
    path = write(tmp_path / "o.csv", "total_usd,order_id,surprise,order_date\n1.5,7.0,z,2026-01-01\nabc,x,y,bad\n")
    df = files.read_csv(spark, path, schemas.column_types("orders", temporal=False))
    assert dict(df.dtypes) == {
        "total_usd": "double", "order_id": "bigint", "surprise": "string", "order_date": "string"
    }
    assert rows(df) == [(1.5, 7, "z", "2026-01-01"), (None, None, "y", "bad")]


def test_csv_line_breaks_and_inference(spark, tmp_path):
    path = write(tmp_path / "m.csv", 'id,body\n1,"two\nlines"\n2,one\n')
    assert rows(files.read_csv(spark, path, multiline=True)) == [("1", "two\nlines"), ("2", "one")]
    inferred = files.read_csv(spark, path, multiline=True, infer=True)
    assert dict(inferred.dtypes)["id"] == "int"


def test_csv_blanks_survive_a_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "\t lead "), (2, None), (3, 'q "x", y')], "id long, text string")
    sinks.write_csv(df, str(tmp_path / "out"))
    assert rows(files.read_csv(spark, str(tmp_path / "out"), {"id": "bigint"})) == rows(df)


def test_jsonl(spark, tmp_path):
    lines = [
        {"review_id": 1, "rating": 5, "created_at": "2026-01-01T00:00:00", "extra": {"a": 1}},
        {"review_id": 2, "body": "two\nlines"},
        {"review_id": 3, "rating": "4", "body": None},
    ]
    path = write(tmp_path / "r.jsonl", "\n".join(json.dumps(line) for line in lines))
    df = files.read_jsonl(spark, path, schemas.column_types("reviews"))
    assert dict(df.dtypes)["rating"] == "bigint"
    assert rows(df, "review_id", "rating", "body") == [(1, 5, None), (2, None, "two\nlines"), (3, 4, None)]
    assert "extra" in df.columns
    narrow = files.read_jsonl(spark, path, schema="review_id bigint")
    assert narrow.columns == ["review_id"]


def test_jsonl_nested_and_stamps(spark, tmp_path):
    path = write(tmp_path / "c.jsonl", "\n".join([
        '{"cart_id": "a", "items": [{"product_id": 1, "quantity": 2, "unit_price_usd": 1.5}], "cart_recovered": true}',
        '{"cart_id": "b", "items": []}',
    ]))
    df = files.read_jsonl(spark, path, schemas.column_types("abandoned_carts"))
    assert df.schema["items"].dataType.simpleString().startswith("array<struct<")
    events = write(tmp_path / "e.jsonl", '{"event_id": "x", "timestamp": "2026-01-01 10:00:00"}')
    row = files.read_jsonl(spark, events, schemas.column_types("search_events")).first()
    assert row.timestamp == datetime.datetime(2026, 1, 1, 10)


def test_parquet_days_with_differing_columns(spark, tmp_path):
    base = tmp_path / "click"
    spark.sql("SELECT 'a' AS event_id, 1L AS user_id").write.parquet(f"{base}/dt=2026-02-05")
    spark.sql("SELECT 'b' AS event_id, 2L AS user_id, 'new' AS extra").write.parquet(f"{base}/dt=2026-02-06")
    write(base / "dt=2026-02-06" / "notes.txt", "not a table")
    df = files.read_parquet(spark, str(base))
    day = datetime.date
    assert rows(df, "event_id", "user_id", "extra", "dt") == [
        ("a", 1, None, day(2026, 2, 5)), ("b", 2, "new", day(2026, 2, 6))
    ]
    one = files.read_parquet(spark, f"{base}/dt=2026-02-05", base_path=str(base))
    assert rows(one, "event_id", "dt") == [("a", day(2026, 2, 5))]
    assert "dt" not in files.read_parquet(spark, f"{base}/dt=2026-02-05").columns


def test_empty_parquet_directory(spark, tmp_path):
    (tmp_path / "none").mkdir()
    for path in (tmp_path / "none", tmp_path / "absent"):
        df = files.read_parquet(spark, str(path), empty_schema="event_id string")
        assert df.columns == ["event_id"] and df.count() == 0
        with pytest.raises(AnalysisException):
            files.read_parquet(spark, str(path))


def test_partition_filter_reaches_the_scan(spark, tmp_path):
    spark.sql("SELECT 1 AS a, 2 AS b, date '2026-01-01' AS dt").write.partitionBy("dt").parquet(str(tmp_path / "t"))
    df = files.read_parquet(spark, str(tmp_path / "t")).filter("dt = '2026-01-02' AND a > 0").select("a")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan and "GreaterThan(a,0)" in plan and "struct<a:int>" in plan


def test_cast_failures(spark):
    df = spark.createDataFrame([("1", "x", "a"), ("y", "2026-01-01", "b"), (None, None, "c")], "a string, b string, c string")
    got = rows(files.cast_failures(df, {"a": "bigint", "b": "date", "c": "string"}))
    assert got == [("a", 2, 1), ("b", 2, 1)]


def test_registry():
    assert len(registry.DATASETS) == 12 and len(registry.datasets()) == 6 and len(registry.datasets(bonus=True)) == 12
    assert {d.name for d in registry.DATASETS} == set(schemas.DOCUMENTED)
    assert all(d.primary_key in schemas.DOCUMENTED[d.name] for d in registry.DATASETS)
    assert {d.format for d in registry.datasets()} == {"csv", "jsonl", "parquet"}


def test_unknown_format(spark):
    odd = registry.Dataset("orders", "xml", "o.xml", "orders", None, "order_id")
    with pytest.raises(ValueError):
        files.read_dataset(spark, Settings(), odd)


def test_catalog(spark):
    sinks.ensure_layers(spark, "cat_bronze", "cat_silver")
    sinks.save_table(spark.range(3).selectExpr("id", "'x' AS _secret"), "cat_bronze", "b")
    sinks.save_table(spark.range(3), "cat_bronze", "a")
    sinks.save_table(spark.range(3), "cat_silver", "a")
    sinks.create_view(spark, "cat_silver", "v", "SELECT id FROM cat_silver.a WHERE id > 0")
    assert [r.table_name for r in tables.list_tables(spark, "cat_bronze").collect()] == ["a", "b"]
    assert [r.table_name for r in tables.list_tables(spark, "cat_silver").collect()] == ["a", "v"]
    assert [tuple(r) for r in tables.list_columns(spark, "cat_bronze", "b").collect()] == [
        (1, "id", "bigint"), (2, "_secret", "string")
    ]
    assert tables.count_columns(spark, "cat_bronze", "b") == 2
    assert rows(tables.tables_per_layer(spark, ("cat_bronze", "cat_silver"))) == [("cat_bronze", 2), ("cat_silver", 1)]
    assert tables.read_table(spark, "cat_silver", "v").count() == 2


def test_parameterised_sql(spark):
    got = tables.run_sql(spark, "SELECT id FROM range(10) WHERE id > :low AND id < :high", {"low": 6, "high": 9})
    assert rows(got) == [(7,), (8,)]
    assert tables.run_sql(spark, "SELECT 1 AS one").first().one == 1
