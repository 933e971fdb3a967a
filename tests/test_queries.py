"""Every registered query against its SQL in DuckDB."""

import duckdb
import pytest

from __spark_entry__ import entry
from acceptance.oracle import ORACLE
from acceptance.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
    "pages", "benchmark", "labels", "conversations",
)
TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SMALL}/{table}.parquet'")
    return connection


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, duck, name):
    found = QUERIES[name](spark, SMALL)
    expected = duck.sql(ORACLE[name])
    names = sorted(found.columns)
    assert sorted(expected.columns) == names
    kinds = dict(zip(expected.columns, map(str, expected.types)))
    assert {n: TYPES[k] for n, k in found.dtypes} == kinds
    places = [expected.columns.index(n) for n in names]
    got = sorted(repr(tuple(r)) for r in found.select(*names).collect())
    want = sorted(repr(tuple(r[i] for i in places)) for r in expected.fetchall())
    assert got == want


def test_entry(spark):
    assert entry(spark).count() > 0
