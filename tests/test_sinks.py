import pytest
from pyspark.sql import functions as F

from shelfstack.sinks import tables as sinks
from shelfstack.sinks.upsert import latest_per_key, merge_rows, upsert_table
from shelfstack.streaming import ingest
from tests.conftest import rows

SCHEMA = "id long, ts int, v string"


def frame(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def test_replace_and_append(spark):
    sinks.ensure_layers(spark, "sink")
    sinks.save_table(frame(spark, (1, 1, "a")), "sink", "t")
    sinks.save_table(frame(spark, (2, 1, "b")), "sink", "t", mode="append")
    assert rows(spark.table("sink.t"), "id") == [(1,), (2,)]
    sinks.save_table(spark.range(1), "sink", "t")
    assert spark.table("sink.t").columns == ["id"]


def test_partitioned_table(spark):
    sinks.ensure_layers(spark, "sink")
    sinks.save_table(frame(spark, (1, 1, "a"), (2, 2, "b")), "sink", "parts", partition_by="ts")
    assert rows(spark.sql("SHOW PARTITIONS sink.parts")) == [("ts=1",), ("ts=2",)]
    sinks.save_table(spark.range(1), "sink", "parts", partition_by="ts")
    assert spark.table("sink.parts").columns == ["id"]


def test_view_is_replaced(spark):
    sinks.ensure_layers(spark, "sink")
    for value in (1, 2):
        sinks.create_view(spark, "sink", "one", f"SELECT {value} AS v")
        assert spark.table("sink.one").first().v == value


def test_latest_per_key(spark):
    df = frame(spark, (1, 1, "old"), (1, 2, "new"), (1, 2, "newer"), (2, None, "x"), (2, 1, "y"), (None, 1, "a"), (None, 1, "a"))
    assert rows(latest_per_key(df, ["id"], ["ts"])) == [(1, 2, "newer"), (2, 1, "y"), (None, 1, "a"), (None, 1, "a")]
    assert rows(latest_per_key(df.select("id"), ["id"])) == [(1,), (2,), (None,), (None,)]


def test_latest_per_key_shrinks_copies_before_the_shuffle(spark):
    df = spark.range(100_000, numPartitions=4).select(
        F.lit(7).alias("id"), F.col("id").cast("int").alias("ts"), F.lit("v").alias("v")
    )
    newest = latest_per_key(df, ["id"], ["ts"])
    assert rows(newest) == [(7, 99_999, "v")]
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "Window" not in plan


def test_merge_rows(spark):
    existing = frame(spark, (1, 1, "a"), (2, 1, "b"), (None, 1, "n"))
    incoming = frame(spark, (2, 2, "B"), (2, 3, "BB"), (3, 1, "c"), (None, 9, "m"))
    expected = [(1, 1, "a"), (2, 3, "BB"), (3, 1, "c"), (None, 1, "n"), (None, 9, "m")]
    assert rows(merge_rows(existing, incoming, ["id"], ["ts"])) == expected


def test_merge_rows_with_new_and_missing_columns(spark):
    existing = frame(spark, (1, 1, "a"))
    incoming = spark.createDataFrame([(2, 5, "n")], "id long, ts int, extra string")
    assert rows(merge_rows(existing, incoming, ["id"], ["ts"]), "id", "v", "extra") == [(1, "a", None), (2, None, "n")]


def test_upsert_is_idempotent(spark):
    sinks.ensure_layers(spark, "sink")
    first, batch = frame(spark, (1, 1, "a"), (2, 1, "b"), (2, 2, "bb")), frame(spark, (2, 3, "B"), (3, 1, "c"))
    upsert_table(spark, "sink", "u", first, ["id"], ["ts"])
    for _ in range(2):
        upsert_table(spark, "sink", "u", batch, ["id"], ["ts"])
        assert rows(spark.table("sink.u")) == [(1, 1, "a"), (2, 3, "B"), (3, 1, "c")]
    assert not spark.catalog.tableExists("sink.u__next") and not spark.catalog.tableExists("sink.u__prev")


def test_upsert_of_partitions(spark):
    sinks.ensure_layers(spark, "sink")
    start = frame(spark, (1, 1, "a"), (2, 1, "b"), (3, 2, "c"), (4, 3, "d"))
    upsert_table(spark, "sink", "p", start, ["id"], partition_by="ts")
    untouched = [r.f for r in spark.table("sink.p").filter("id = 4").select(F.input_file_name().alias("f")).collect()]
    # 2 changes in place, 3 moves and leaves its partition empty, 5 opens a partition
    batch = frame(spark, (2, 1, "B"), (3, 1, "C"), (5, 9, "e"))
    for _ in range(2):
        upsert_table(spark, "sink", "p", batch, ["id"], partition_by="ts")
        assert rows(spark.table("sink.p"), "id", "ts", "v") == [
            (1, 1, "a"), (2, 1, "B"), (3, 1, "C"), (4, 3, "d"), (5, 9, "e")
        ]
        assert rows(spark.sql("SHOW PARTITIONS sink.p")) == [("ts=1",), ("ts=3",), ("ts=9",)]
    after = [r.f for r in spark.table("sink.p").filter("id = 4").select(F.input_file_name().alias("f")).collect()]
    assert after == untouched
    # a row without a partition value, and a new column, take the whole-table way
    upsert_table(spark, "sink", "p", frame(spark, (5, None, "n")), ["id"], partition_by="ts")
    assert rows(spark.table("sink.p").filter("id = 5"), "id", "ts", "v") == [(5, None, "n")]
    wider = frame(spark, (6, 3, "f")).withColumn("extra", F.lit(1))
    upsert_table(spark, "sink", "p", wider, ["id"], partition_by="ts")
    assert rows(spark.table("sink.p").filter("ts = 3"), "id", "extra") == [(4, None), (6, 1)]


@pytest.mark.parametrize("partition_by", [None, "ts"])
def test_upsert_finishes_a_run_that_died(spark, partition_by):
    name = f"w_{partition_by}"
    sinks.ensure_layers(spark, "sink")
    upsert_table(spark, "sink", name, frame(spark, (1, 1, "a")), ["id"], partition_by=partition_by)
    # died while writing: the rest is dropped
    sinks.save_table(frame(spark, (9, 9, "half")), "sink", f"{name}__next", partition_by=partition_by)
    upsert_table(spark, "sink", name, frame(spark, (2, 1, "b")), ["id"], partition_by=partition_by)
    assert rows(spark.table(f"sink.{name}"), "id", "v") == [(1, "a"), (2, "b")]
    # died after writing, the old table may be gone already: the new one is put in place
    sinks.save_table(frame(spark, (1, 1, "A"), (2, 1, "B")), "sink", f"{name}__next", partition_by=partition_by)
    spark.sql(f"ALTER TABLE sink.{name}__next SET TBLPROPERTIES ('complete' = 'true')")
    spark.sql(f"DROP TABLE sink.{name}")
    upsert_table(spark, "sink", name, frame(spark, (3, 1, "c")), ["id"], partition_by=partition_by)
    assert rows(spark.table(f"sink.{name}"), "id", "v") == [(1, "A"), (2, "B"), (3, "c")]
    assert not spark.catalog.tableExists(f"sink.{name}__next")
    assert not spark.catalog.tableExists(f"sink.{name}__prev")


def test_new_files_are_appended_once(spark, tmp_path):
    sinks.ensure_layers(spark, "sink")
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "ck")
    seen = []
    for day in (1, 2, 2):
        if day not in seen:
            frame(spark, (day, day, "a")).coalesce(1).write.mode("append").parquet(source)
            seen.append(day)
        stream = ingest.new_files(spark, source, frame(spark).schema)
        query = ingest.append_new_files(stream, "sink", "streamed", checkpoint)
        query.awaitTermination(60)
        assert rows(spark.table("sink.streamed"), "id") == [(d,) for d in seen]


@pytest.mark.parametrize("file_format", ["parquet", "csv", "json"])
def test_new_files_are_upserted(spark, tmp_path, file_format):
    sinks.ensure_layers(spark, "sink")
    source, checkpoint = str(tmp_path / "in"), str(tmp_path / "ck")
    for batch in ([(1, 1, "a"), (2, 1, "b")], [(2, 2, "B"), (3, 1, "c")]):
        out = frame(spark, *batch).coalesce(1).write.mode("append")
        (out.option("header", True) if file_format == "csv" else out).format(file_format).save(source)
        stream = ingest.new_files(spark, source, frame(spark).schema, file_format)
        query = ingest.upsert_new_files(stream, "sink", f"up_{file_format}", checkpoint, ["id"], ["ts"])
        query.awaitTermination(60)
        assert query.exception() is None
    assert rows(spark.table(f"sink.up_{file_format}")) == [(1, 1, "a"), (2, 2, "B"), (3, 1, "c")]


def test_merging_twice_with_null_keys_changes_nothing(spark):
    kind = "k long, v string, w double"
    old = spark.createDataFrame([(1, "a", 1.0), (None, "x", None)], kind)
    batch = spark.createDataFrame([(1, "b", 2.0), (None, "x", None), (None, "y", 3.0), (None, "y", 3.0)], kind)
    once = merge_rows(old, batch, ["k"])
    twice = merge_rows(once, batch, ["k"])
    assert rows(once) == rows(twice) == rows(spark.createDataFrame([(1, "b", 2.0), (None, "x", None), (None, "y", 3.0)], kind))


def test_a_settled_batch_is_read_from_where_it_is(spark):
    sinks.ensure_layers(spark, "sink")
    sinks.save_table(frame(spark, (1, 1, "a"), (2, 1, "b"), (None, 1, "n")), "sink", "s")
    sinks.save_table(frame(spark, (2, 0, "c"), (3, 1, "d"), (None, 1, "n")), "sink", "s_new")
    for _ in range(2):
        upsert_table(spark, "sink", "s", spark.table("sink.s_new"), ["id"], settled=True)
        assert sorted(map(str, rows(spark.table("sink.s")))) == sorted(map(str, [(1, 1, "a"), (2, 0, "c"), (3, 1, "d"), (None, 1, "n")]))
    plan = spark.table("sink.s_new")
    assert plan.count() == 3 and not spark.catalog.tableExists("sink.s__batch")
    assert all(".zstd." in path for path in spark.table("sink.s").inputFiles())
