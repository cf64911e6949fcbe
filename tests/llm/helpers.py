"""Small tables that hold what is awkward, and plain versions of the operators."""

import itertools
import os

import duckdb

SF_DIR = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def docs_frame(spark, rows, extra=()):
    """A documents table from ``(doc_id, text)``; ``extra`` names added columns that hold text."""
    kind = DOCS + "".join(f", `{name}` string" for name in extra)
    made = [(i, t, None if t is None else "en", "s", None if t is None else len(t), *["x"] * len(extra)) for i, t in rows]
    return spark.createDataFrame(made, kind)


def odd_docs(spark, extra=()):
    """Nulls, empty and very long texts, ties, repeated rows."""
    long = " ".join(f"w{i % 997}" for i in range(60_000))
    rows = [
        (1, "one two three four five"), (1, "one two three four five"), (None, "one two three four five"),
        (None, None), (2, None), (3, ""), (4, " \n\t "), (5, long), (6, long + " end"), (7, "été 日本 \U0001f600 \U000f0001 <x>"),
    ]
    return docs_frame(spark, rows, extra)


def no_docs(spark):
    return spark.createDataFrame([], DOCS)


def duck(sf_dir=SF_DIR):
    """DuckDB with the tables of a folder."""
    connection = duckdb.connect()
    connection.sql("SET timezone = 'UTC'")
    for name in os.listdir(sf_dir):
        connection.sql(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{sf_dir}/{name}'")
    return connection


def same_as_sql(df, sql, connection):
    """Whether all rows of ``df`` are those of the SQL."""
    want = connection.sql(sql)
    columns = sorted(df.columns)
    assert sorted(want.columns) == columns
    order = [want.columns.index(c) for c in columns]
    expected = sorted((tuple(r[i] for i in order) for r in want.fetchall()), key=repr)
    got = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
    return got == expected


def table(spark, name):
    return spark.read.parquet(f"{SF_DIR}/{name}.parquet")


def pairs(items):
    return itertools.combinations(items, 2)
