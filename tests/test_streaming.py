"""Files that arrive one after the other end up in Bronze as if they had been read together."""

import json

import pytest
from pyspark.sql import functions as F

from shelfstack.settings import Settings
from shelfstack.sources.files import read_dataset
from shelfstack.sources.registry import BY_NAME
from shelfstack.streaming.ingest import bronze_stream, ingest_new_files
from tests.conftest import rows


def write(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text, encoding="utf-8")


def settings_of(spark, name, root, **more):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")
    return Settings(raw_root=str(root), bronze=name, **more)


def test_csv_files_in_two_runs(spark, tmp_path):
    settings, dataset = settings_of(spark, "stream_csv", tmp_path / "raw"), BY_NAME["orders"]
    folder = tmp_path / "raw" / dataset.key
    write(folder, "a.csv", "order_id,status,total_usd\n1,NA,1.5\nKE-2,shipped,2\n")
    ingest_new_files(spark, settings, dataset, str(tmp_path / "log"))
    write(folder, "b.csv", "order_id,status,total_usd\n3,shipped,12 USD\n4,shipped\n")
    for _ in range(2):  # the second time there is nothing new
        ingest_new_files(spark, settings, dataset, str(tmp_path / "log"))
        got, want = spark.table("stream_csv.orders"), read_dataset(spark, settings, dataset)
        assert got.dtypes == want.dtypes
        assert rows(got) == rows(want)
    assert rows(got, "_rescued")[0] == (None,) and got.where("_rescued is not null").count() == 3
    write(folder, "c.csv", "status,order_id,total_usd\nshipped,5,1\n")
    with pytest.raises(Exception, match="STREAM_FAILED"):
        ingest_new_files(spark, settings, dataset, str(tmp_path / "log"))


def test_json_fields_become_columns_with_the_next_run(spark, tmp_path):
    settings, dataset = settings_of(spark, "stream_json", tmp_path / "raw", mode="upsert"), BY_NAME["reviews"]
    folder = tmp_path / "raw" / dataset.key
    lines = lambda *r: "\n".join(map(json.dumps, r)) + "\n"
    write(folder, "a.jsonl", lines({"review_id": 1, "rating": 5}, {"review_id": 2, "rating": "bad"}))
    ingest_new_files(spark, settings, dataset, str(tmp_path / "log"))
    write(folder, "b.jsonl", lines({"review_id": 2, "rating": 4, "device": "phone"}, {"review_id": 3, "rating": 1}))
    ingest_new_files(spark, settings, dataset, str(tmp_path / "log"))
    table = spark.table("stream_json.reviews")
    assert rows(table, "review_id", "rating", F.col("_rescued")) == [(1, 5, None), (2, 4, {"device": "phone"}), (3, 1, None)]
    write(folder, "c.jsonl", lines({"review_id": 4, "rating": 2, "device": "desk"}))
    ingest_new_files(spark, settings, dataset, str(tmp_path / "log"))
    assert rows(spark.table("stream_json.reviews").where("review_id = 4"), "rating", "device", "_rescued") == [(2, "desk", None)]


def test_parquet_days(spark, tmp_path):
    settings, dataset = settings_of(spark, "stream_days", tmp_path / "raw"), BY_NAME["clickstream"]
    path = f"{settings.raw_root}/{dataset.key}"
    day = lambda d, i: spark.createDataFrame([(f"e{i}", i, d)], "event_id string, user_id long, dt string")
    day("2024-01-01", 1).write.partitionBy("dt").parquet(path)
    ingest_new_files(spark, settings, dataset, str(tmp_path / "log"))
    day("2024-01-02", 2).write.mode("append").partitionBy("dt").parquet(path)
    ingest_new_files(spark, settings, dataset, str(tmp_path / "log"))
    assert rows(spark.table("stream_days.clickstream"), "event_id", F.col("dt").cast("string")) == [("e1", "2024-01-01"), ("e2", "2024-01-02")]


def test_a_stream_needs_a_rescue_column(spark, tmp_path):
    with pytest.raises(ValueError, match="rescue"):
        bronze_stream(spark, Settings(raw_root=str(tmp_path), rescue=None), BY_NAME["orders"])
