"""What has changed between two inventories of columns.

An inventory has ``TableName, Ordinal, ColumnName, DataType``. Rows without a table or column name are left
out, a row that is there twice counts once. Names are compared as they are written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colmask.operators.joins import skew_join

_KEY = ["TableName", "ColumnName"]


def _columns(inventory: DataFrame) -> DataFrame:
    """Each column once, with its first place and the type there."""
    first = F.min(F.struct("Ordinal", "DataType")).alias("c")
    return inventory.dropna(subset=_KEY).groupBy(*_KEY).agg(first).select(*_KEY, "c.Ordinal", "c.DataType")


def table_digests(inventory: DataFrame) -> DataFrame:
    """(TableName, n_columns, digest), the same for the same columns in whatever order the rows come.

    The digest is a sum and an exclusive-or of the columns' hashes. Rows are shuffled by table and column, and then one
    row a task and table, so a table that holds most of the inventory has no task of its own.
    """
    column = F.struct("ColumnName", "Ordinal", "DataType")
    parts = F.struct(
        F.bit_xor(F.xxhash64(column)).alias("mixed"), F.sum(F.hash(column).cast("bigint")).alias("added")
    )
    return _columns(inventory).groupBy("TableName").agg(F.count(F.lit(1)).alias("n_columns"), parts.alias("digest"))


def changed_tables(now: DataFrame, before: DataFrame) -> DataFrame:
    """(TableName, change): tables that were added, dropped, or have other columns than before."""
    new = table_digests(now).select("TableName", F.struct("n_columns", "digest").alias("_new"))
    old = table_digests(before).select("TableName", F.struct("n_columns", "digest").alias("_old"))
    change = F.when(F.col("_old").isNull(), "added").when(F.col("_new").isNull(), "dropped").otherwise("changed")
    return (
        new.join(old, "TableName", "full_outer")
        .filter(~F.col("_new").eqNullSafe(F.col("_old")))
        .select("TableName", change.alias("change"))
    )


def column_changes(now: DataFrame, before: DataFrame) -> DataFrame:
    """(TableName, ColumnName, change, OldType, NewType): columns that were added, dropped, retyped or moved.

    The join is keyed by table and column, so a table of very many columns spreads over all tasks.
    """
    new = _columns(now).select(*_KEY, F.struct("Ordinal", "DataType").alias("_new"))
    old = _columns(before).select(*_KEY, F.struct("Ordinal", "DataType").alias("_old"))
    change = (
        F.when(F.col("_old").isNull(), "added")
        .when(F.col("_new").isNull(), "dropped")
        .when(~F.col("_new.DataType").eqNullSafe(F.col("_old.DataType")), "retyped")
        .otherwise("moved")
    )
    return (
        new.join(old, _KEY, "full_outer")
        .filter(~F.col("_new").eqNullSafe(F.col("_old")))
        .select(
            *_KEY, change.alias("change"), F.col("_old.DataType").alias("OldType"), F.col("_new.DataType").alias("NewType")
        )
    )


def columns_of(inventory: DataFrame, tables: DataFrame) -> DataFrame:
    """Rows of the inventory whose table is in ``tables``, each of which is there once."""
    return skew_join(inventory, tables.select("TableName"), ["TableName"], "left_semi")


def out_of_reach(tables: DataFrame, failed: DataFrame) -> DataFrame:
    """Those of ``tables`` that a failed unit of a scan covers: the table, its schema or its catalog.

    ``failed`` has the column ``unit`` of a run log.
    """
    quoted = F.expr("regexp_extract_all(TableName, '`(?:[^`]|``)*`|[^.]+', 0)")
    plain = F.transform(
        quoted, lambda p: F.when(p.startswith("`"), F.replace(F.substr(p, F.lit(2), F.length(p) - 2), F.lit("``"), F.lit("`"))).otherwise(p)
    )
    units = F.array_distinct(
        F.array(F.col("TableName"), F.get("_parts", F.lit(0)), F.concat_ws(".", F.slice("_parts", 1, 2)))
    )
    named = tables.select("TableName").withColumn("_parts", plain).select("TableName", F.explode(units).alias("unit"))
    return named.join(failed.select("unit").distinct(), "unit", "left_semi").select("TableName").distinct()
