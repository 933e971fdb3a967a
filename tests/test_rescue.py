"""Nothing a source file says is lost on the way to Bronze."""

import json

import pytest

from shelfstack.settings import Settings
from shelfstack.sources import files, schemas
from shelfstack.sources.registry import BY_NAME
from tests.conftest import rows


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_csv_cells_that_do_not_fit_can_be_read_back(spark, tmp_path):
    path = write(tmp_path / "l.csv", (
        "line_item_id,quantity,line_total_usd,_warehouse_id\n"
        "1,KE-1,10.5,W1\n"
        '2,"1,000",abc,W2\n'
        "3,4.5,7,W3\n"
        "4,2.0,NA,W4\n"
        "5,3,8,W5,one too many\n"
        "6,1\n"
    ))
    df = files.read_csv(spark, path, schemas.column_types("order_line_items", temporal=False), rescue="_rescued")
    assert dict(df.dtypes) == {
        "line_item_id": "bigint", "quantity": "bigint", "line_total_usd": "double", "_warehouse_id": "string",
        "_rescued": "map<string,string>"}
    assert rows(df, "line_item_id", "quantity", "line_total_usd", "_rescued") == sorted([
        (1, None, 10.5, {"quantity": "KE-1"}), (2, None, None, {"quantity": "1,000", "line_total_usd": "abc"}),
        (3, None, 7.0, {"quantity": "4.5"}), (4, 2, None, None),
        (5, 3, 8.0, {"_line": "5,3,8,W5,one too many"}), (6, 1, None, {"_line": "6,1"}),
    ], key=repr)
    assert rows(files.rescued_cells(df, "line_item_id"))[0] == (1, "quantity", "KE-1")
    rules = files.rescue_rules(df, schemas.column_types("order_line_items"))
    counts = {name: df.where(rule).count() for name, rule in rules.items()}
    assert counts == {
        "quarantined": 5, "broken_line": 2, "unknown_field": 0, "misfit_line_item_id": 0, "misfit_quantity": 3, "misfit_line_total_usd": 1}


def test_csv_files_with_other_headers_stop_the_read(spark, tmp_path):
    write(tmp_path / "d" / "a.csv", "id,name\n1,x\n")
    write(tmp_path / "d" / "b.csv", "name,id\ny,2\n")
    with pytest.raises(Exception, match="header"):
        files.read_csv(spark, str(tmp_path / "d"), {"id": "bigint"}, rescue="_rescued").collect()


JSON_LINES = [
    {"review_id": 1, "rating": 5, "extra": {"a": [1, 2]}},
    {"review_id": 2, "rating": "KE-1", "body": None},
    {"review_id": "3", "rating": 4.5, "helpful_votes": "1,000"},
    {"review_id": 4, "rating": "4", "shipped": "true"},
]


def json_file(tmp_path, *more):
    return write(tmp_path / "r.jsonl", "\n".join([*map(json.dumps, JSON_LINES), "", "{broken", *more]) + "\n")


def test_json_with_its_own_schema(spark, tmp_path):
    df = files.read_jsonl(spark, json_file(tmp_path), schemas.column_types("reviews"), rescue="_rescued")
    got = {r.review_id: r for r in df.collect()}
    assert [got[i].rating for i in (1, 2, 3, 4)] == [5, None, None, 4]  # mixed with text, so whole numbers as documented
    assert got[1].extra.a == [1, 2] and got[1]._rescued is None
    assert got[2]._rescued == {"rating": "KE-1"}
    assert got[3]._rescued == {"rating": "4.5", "helpful_votes": "1,000"}
    assert got[None]._rescued == {"_line": "{broken"}


def test_json_with_a_kept_schema_is_read_once_and_shows_new_fields(spark, tmp_path):
    types = schemas.column_types("reviews")
    df = files.read_jsonl(spark, json_file(tmp_path), types, "review_id bigint, rating bigint, body string", "_rescued")
    assert df.columns == ["review_id", "rating", "body", "_rescued"]
    got = {r.review_id: r for r in df.collect()}
    assert got[1]._rescued == {"extra": '{"a":[1,2]}'}
    assert got[4]._rescued["shipped"] == "true" and got[None]._rescued["_line"] == "{broken"
    # One scan of the text, and no other job to find the fields.
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan text") == 1
    rules = files.rescue_rules(df, types)
    assert df.where(rules["unknown_field"]).count() == 3
    later = files.kept_schema(df)
    assert {f.name: f.dataType.simpleString() for f in later.fields} == {
        "review_id": "bigint", "rating": "bigint", "body": "string", "extra": "string", "helpful_votes": "string",
        "shipped": "boolean"}
    again = files.read_jsonl(spark, json_file(tmp_path), types, later, "_rescued")
    assert [(r.shipped, r.extra) for r in again.where("review_id in (1, 4)").orderBy("review_id").collect()] == [
        (None, '{"a":[1,2]}'), (True, None)]
    assert again.where(files.rescue_rules(again, types)["unknown_field"]).count() == 0


def test_bronze_keeps_everything_by_default(spark, tmp_path):
    write(tmp_path / "orders/orders.csv", "order_id,status,total_usd\n1,shipped,1e3\nKE-2,shipped,12 USD\n")
    df = files.read_dataset(spark, Settings(raw_root=str(tmp_path)), BY_NAME["orders"])
    assert rows(df, "order_id", "_rescued") == [(1, None), (None, {"order_id": "KE-2", "total_usd": "12 USD"})]
    plain = files.read_dataset(spark, Settings(raw_root=str(tmp_path), rescue=None), BY_NAME["orders"])
    assert "_rescued" not in plain.columns


def test_lines_are_parsed_once_for_their_rescued_cells(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"id": 1, "n": "x", "more": "y"}\n{"id": 2, "n": "5"}\n')
    read = files.read_jsonl(spark, str(tmp_path), {"n": "bigint"}, "id bigint, n bigint", rescue="_rescued")
    cells = files.rescued_cells(read, "id")
    assert sorted(map(tuple, cells.collect())) == [(1, "more", "y"), (1, "n", "x")]
    assert cells._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 2  # as columns, and as a map
