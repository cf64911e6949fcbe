"""Every registered query against the same question asked in SQL elsewhere."""

import duckdb
import pytest

import __spark_entry__ as spark_entry
from entry_queries.derived import TABLES

SF_DIR = "/root/testdata/sf0.001"
TYPES = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.sql("SET timezone = 'UTC'")
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


QUERIES = {name: query for module in spark_entry._MODULES for name, query in module.QUERIES.items()}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    columns = sorted(df.columns)
    want = duck.sql(spark_entry.oracle_sql()[name])
    assert sorted(want.columns) == columns
    types = dict(zip(want.columns, map(str, want.types)))
    assert {c: TYPES[t] for c, t in df.dtypes} == types
    order = [want.columns.index(c) for c in columns]
    expected = sorted((tuple(r[i] for i in order) for r in want.fetchall()), key=repr)
    got = sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
    assert got == expected
    assert got


def test_entry(spark):
    got = spark_entry.entry(spark)
    assert got.count() == 150
    assert set(got.first()["c_name"][1:]) == {"*"}


def test_every_query_has_its_sql():
    assert set(QUERIES) <= set(spark_entry.oracle_sql())
    assert set(QUERIES) <= set(spark_entry.queries())
