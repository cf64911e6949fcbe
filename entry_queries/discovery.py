"""Inventories and the classification of columns by name."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colmask import classify_columns, default_rules, discover_frames, excluded_by_suffix
from colmask.operators.audit import count_values
from colmask.session import work_folder
from colmask.sources.inventory import columns_inventory, exclude_namespaces, table_names
from colmask.sources.versions import ControlTable
from entry_queries import derived as d
from entry_queries.derived import TABLE_RULES, TABLES, table


def _frames(spark, sf_dir):
    return {name: table(spark, sf_dir, name) for name in TABLES}


def _value_counts(frames, matches_columns):
    """Stored values of the listed columns, one aggregation per table."""
    counts = [count_values(t, frames[t], columns) for t, columns in matches_columns.items()]
    return reduce(DataFrame.unionByName, counts)


def inventory_columns(spark, sf_dir):
    """Columns and types of every table, with the table's number of rows."""
    frames = _frames(spark, sf_dir)
    sizes = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("TableName"), "n_rows")
        for name, df in frames.items()
    ]
    sizes = reduce(DataFrame.unionByName, sizes)
    return columns_inventory(spark, frames).join(sizes, "TableName")


_SPARK_TYPE = r"""CASE data_type WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int'
    WHEN 'BIGINT' THEN 'bigint' WHEN 'DOUBLE' THEN 'double' WHEN 'BOOLEAN' THEN 'boolean'
    WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'FLOAT[]' THEN 'array<float>' ELSE data_type END"""

_TABLE_LIST = ", ".join(f"'{t}'" for t in TABLES)

_SCHEMA = f"""columns AS (
  SELECT table_name AS TableName, CAST(ordinal_position - 1 AS INTEGER) AS Ordinal,
    column_name AS ColumnName, {_SPARK_TYPE} AS DataType
  FROM information_schema.columns WHERE table_name IN ({_TABLE_LIST}))"""

_SIZES = "sizes AS (" + " UNION ALL ".join(
    f"SELECT '{t}' AS TableName, count(*) AS n_rows FROM {t}" for t in TABLES
) + ")"


def classify_testdata(spark, sf_dir):
    """Sensitive columns of the test tables and how many values each holds."""
    frames = _frames(spark, sf_dir)
    matches = classify_columns(columns_inventory(spark, frames), TABLE_RULES)
    # The names are needed to build the counting query; there are fewer than columns in a schema.
    found = {}
    for row in matches.select("TableName", "ColumnName").orderBy("TableName", "ColumnName").toLocalIterator():
        found.setdefault(row["TableName"], []).append(row["ColumnName"])
    return matches.join(_value_counts(frames, found), ["TableName", "ColumnName"])


_FLAGGED = {
    "region": ["r_name"], "nation": ["n_name"], "customer": ["c_name", "c_acctbal"],
    "supplier": ["s_name", "s_acctbal"], "part": ["p_name", "p_retailprice"],
    "orders": ["o_totalprice", "o_orderdate"], "lineitem": ["l_extendedprice", "l_shipdate"],
    "documents": ["text"], "pages": ["url"], "benchmark": ["text"], "conversations": ["text"],
}
_VALUES = "counts AS (" + " UNION ALL ".join(
    f"SELECT '{t}' AS TableName, '{c}' AS ColumnName, count({c}) AS n_values FROM {t}"
    for t, columns in _FLAGGED.items()
    for c in columns
) + ")"


def classify_words(spark, sf_dir):
    """Every word of every document as a column name of a table per language and source."""
    columns = table(spark, sf_dir, "documents").select(
        F.concat_ws(".", F.lit("corpus"), "lang", "source").alias("TableName"),
        F.posexplode(F.split("text", " ")).alias("Ordinal", "ColumnName"),
        F.lit("string").alias("DataType"),
    )
    return classify_columns(columns)


_WORDS = """columns AS (
  SELECT 'corpus.' || lang || '.' || source AS TableName, 0 AS Ordinal,
    unnest(string_split(text, ' ')) AS ColumnName, 'string' AS DataType
  FROM documents)"""


def discover_one_table(spark, sf_dir):
    """Scan lineitem into an empty control table; its rows with their value counts."""
    frames = {"lineitem": table(spark, sf_dir, "lineitem")}
    control = ControlTable(spark, work_folder(spark, "control"))
    control.create()
    discover_frames(spark, frames, control, TABLE_RULES)
    rows = control.read()
    counts = count_values("lineitem", frames["lineitem"], [c.lower() for c in frames["lineitem"].columns])
    return rows.join(counts, ["TableName", "ColumnName"])


def classify_columns_query(spark, sf_dir):
    return classify_columns(d.patient_columns(spark, sf_dir))


def classify_suffix_excluded(spark, sf_dir):
    return excluded_by_suffix(d.patient_columns(spark, sf_dir))


def inventory_tables(spark, sf_dir):
    return table_names(d.listing(spark, sf_dir))


def inventory_excluded(spark, sf_dir):
    return table_names(exclude_namespaces(d.listing(spark, sf_dir)))


def inventory_catalogs(spark, sf_dir):
    """Distinct catalogs that remain to be scanned."""
    return exclude_namespaces(d.listing(spark, sf_dir)).select("catalog").distinct()


QUERIES = {
    "inventory_columns": inventory_columns,
    "inventory_tables": inventory_tables,
    "inventory_excluded": inventory_excluded,
    "inventory_catalogs": inventory_catalogs,
    "classify_columns": classify_columns_query,
    "classify_suffix_excluded": classify_suffix_excluded,
    "classify_testdata": classify_testdata,
    "classify_words": classify_words,
    "discover_one_table": discover_one_table,
}

_KEPT = """catalog NOT IN ('system', 'samples', 'hive_metastore')
  AND schema NOT IN ('default', 'information_schema', 'test')"""
_NAME = "catalog || '.' || schema || '.' || tableName AS TableName"

ORACLES = {
    "inventory_columns": f"WITH {_SCHEMA}, {_SIZES} SELECT c.*, n_rows FROM columns c JOIN sizes USING (TableName)",
    "inventory_tables": f"WITH {d.LISTING} SELECT {_NAME} FROM listing WHERE NOT isTemporary",
    "inventory_excluded": f"WITH {d.LISTING} SELECT {_NAME} FROM listing WHERE NOT isTemporary AND {_KEPT}",
    "inventory_catalogs": f"WITH {d.LISTING} SELECT DISTINCT catalog FROM listing WHERE {_KEPT}",
    "classify_columns": f"WITH {d.DEFAULT_MATCHES} SELECT * FROM matches",
    "classify_suffix_excluded": f"WITH {d.PATIENTS}, {d.matches_sql(default_rules(), excluded=True)} "
    "SELECT TableName, PIICategory, ColumnName, DataType FROM matches",
    "classify_testdata": f"WITH {_SCHEMA}, {d.matches_sql(TABLE_RULES)}, {_VALUES} "
    "SELECT m.*, n_values FROM matches m JOIN counts USING (TableName, ColumnName)",
    "classify_words": f"WITH {_WORDS}, {d.matches_sql(default_rules())} SELECT * FROM matches",
    "discover_one_table": f"WITH {_SCHEMA}, {d.matches_sql(TABLE_RULES)}, {_VALUES} "
    "SELECT row_number() OVER (ORDER BY md5(m.TableName || chr(31) || ColumnName)) AS Id, m.*, n_values "
    "FROM matches m JOIN counts USING (TableName, ColumnName) WHERE TableName = 'lineitem'",
}
