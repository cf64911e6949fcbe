"""Whole test tables as an unauthorised reader sees them, and what stays visible."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

from colmask import classify_columns, mask_plan, mask_table
from colmask.functions.redact import LOCAL_TIMESTAMP, MASK_FUNCTIONS
from colmask.operators.audit import exposure_audit
from colmask.sources.inventory import columns_inventory
from entry_queries.derived import TABLE_RULES, TABLES, mask_sql, table

# The test tables hold local timestamps, which need their own entry.
FUNCTIONS = MASK_FUNCTIONS | LOCAL_TIMESTAMP

# Columns the rules find and the masks cover, and all others.
MASKED = {
    "region": (["r_name"], ["r_regionkey"]),
    "nation": (["n_name"], ["n_nationkey", "n_regionkey"]),
    "part": (["p_name", "p_retailprice"], ["p_partkey", "p_brand", "p_type", "p_size"]),
    "benchmark": (["text"], ["item_id"]),
    "customer": (["c_name", "c_acctbal"], ["c_custkey", "c_nationkey", "c_mktsegment"]),
    "supplier": (["s_name", "s_acctbal"], ["s_suppkey", "s_nationkey"]),
    "orders": (
        ["o_totalprice", "o_orderdate"],
        ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"],
    ),
    "lineitem": (
        ["l_extendedprice", "l_shipdate"],
        ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount",
         "l_tax", "l_returnflag", "l_linestatus"],
    ),
    "documents": (["text"], ["doc_id", "lang", "source", "n_chars"]),
    "pages": (["url"], ["page_id", "html"]),
    "conversations": (["text"], ["conv_id", "turn", "role"]),
}

# Every column of a type that can be masked, by table.
MASKABLE = {
    "region": "r_regionkey r_name",
    "nation": "n_nationkey n_name n_regionkey",
    "customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment",
    "supplier": "s_suppkey s_name s_nationkey s_acctbal",
    "part": "p_partkey p_name p_brand p_type p_size p_retailprice",
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority",
    "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice "
    "l_discount l_tax l_returnflag l_linestatus l_shipdate",
    "events": "event_id ts user_id event_type value props",
    "documents": "doc_id text lang source n_chars",
    "embeddings": "vec_id label",
    "pages": "page_id url html",
    "benchmark": "item_id text",
    "labels": "doc_id quality toxic",
    "conversations": "conv_id turn role text",
}


def find_columns(spark, name: str, df: DataFrame) -> dict[str, str]:
    """Strategy by column, from the rules; at most one entry per column of the schema."""
    matches = classify_columns(columns_inventory(spark, {name: df}), TABLE_RULES)
    plan = mask_plan(matches, FUNCTIONS).filter("status = 'pending'")
    return {r["ColumnName"]: r["strategy"] for r in plan.collect()}


def masked(spark, sf_dir, name):
    df = table(spark, sf_dir, name)
    return mask_table(df, find_columns(spark, name, df), functions=FUNCTIONS)


def _masked_table(name):
    return lambda spark, sf_dir: masked(spark, sf_dir, name)


def exposure(spark, sf_dir):
    """How many values of every column a mask would leave as they are."""
    audits = [
        exposure_audit(name, table(spark, sf_dir, name), functions=FUNCTIONS) for name in TABLES
    ]
    return reduce(DataFrame.unionByName, audits)


QUERIES = {f"mask_table_{name}": _masked_table(name) for name in MASKED}
QUERIES["exposure_audit"] = exposure

ORACLES = {
    f"mask_table_{name}": "SELECT "
    + ", ".join([f"{mask_sql(c)} AS {c}" for c in hidden] + shown)
    + f" FROM {name}"
    for name, (hidden, shown) in MASKED.items()
}
ORACLES["exposure_audit"] = " UNION ALL ".join(
    f"SELECT '{t}' AS TableName, '{c}' AS ColumnName, count({c}) AS n_values, "
    f"count(*) FILTER (CAST({c} AS VARCHAR) = {mask_sql(c)}) AS n_exposed FROM {t}"
    for t, columns in MASKABLE.items()
    for c in columns.split()
)
