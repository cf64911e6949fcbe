"""The control table: which columns were found and whether to mask them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colmask.operators.joins import shuffled, skew_join
from colmask.operators.numbering import number_rows
from colmask.session import stored

_KEY = ["_table", "_column"]


def _keyed(df: DataFrame) -> DataFrame:
    return df.withColumn("_table", F.lower("TableName")).withColumn("_column", F.lower("ColumnName"))


def assign_ids(rows: DataFrame, control: DataFrame | None = None, after: int = 0) -> DataFrame:
    """Give ``rows`` the Ids that follow the largest one of ``control``, and follow ``after``."""
    if control is not None:
        after = F.greatest(F.coalesce(control.agg(F.max("Id")).scalar(), F.lit(0)), F.lit(after))
    return number_rows(rows, ["TableName", "ColumnName"], "Id", after=after)


def upsert_control(
    control: DataFrame, matches: DataFrame, keep_flag: bool = True, after: int = 0
) -> DataFrame:
    """``control`` with ``matches`` merged in by table and column name.

    A known column gets the new category and type; its EncryptFlag stays as
    the steward left it, or is taken from ``matches`` with ``keep_flag=False``.
    New columns get the next Ids, above ``after`` and all there are. ``matches`` must have each column once, as
    ``classify_columns`` returns it; it is evaluated once, into the work folder.
    """
    return merge_control(control, stored(matches, "matches"), keep_flag, after)


def merge_control(control: DataFrame, matches: DataFrame, keep_flag: bool = True, after: int = 0) -> DataFrame:
    """``upsert_control`` for matches that are a table already, as they are read twice."""
    new = _keyed(matches).select(
        *_KEY,
        F.col("PIICategory").alias("_category"),
        F.col("DataType").alias("_type"),
        F.col("EncryptFlag").alias("_flag"),
        F.lit(True).alias("_found"),
    )
    found = F.coalesce("_found", F.lit(False))
    flag = F.col("EncryptFlag")
    if not keep_flag:
        flag = F.when(found, F.col("_flag")).otherwise(flag)
    kept = (
        _keyed(control)
        .join(shuffled(new), _KEY, "left")
        .select(
            "Id",
            "TableName",
            F.when(found, F.col("_category")).otherwise(F.col("PIICategory")).alias("PIICategory"),
            "ColumnName",
            F.when(found, F.col("_type")).otherwise(F.col("DataType")).alias("DataType"),
            flag.alias("EncryptFlag"),
        )
    )
    fresh = _keyed(matches).join(shuffled(_keyed(control).select(*_KEY)), _KEY, "left_anti").drop(*_KEY)
    return kept.unionByName(assign_ids(fresh, control, after))


def flagged(control: DataFrame) -> DataFrame:
    """Rows to be masked; an unset flag does not count."""
    return control.filter(F.col("EncryptFlag"))


def flagged_tables(control: DataFrame) -> DataFrame:
    return flagged(control).select("TableName").distinct()


def prune_control(control: DataFrame, dead_tables: DataFrame) -> DataFrame:
    """``control`` without the rows of tables confirmed to be gone."""
    dead = dead_tables.select("TableName").distinct()
    return skew_join(control, dead, ["TableName"], "left_anti")


def duplicate_keys(control: DataFrame) -> DataFrame:
    """Columns listed more than once, names compared without case, with their count; empty when all is well."""
    first = [F.min(c).alias(c) for c in ("TableName", "ColumnName")]
    return (
        _keyed(control)
        .groupBy(*_KEY)
        .agg(*first, F.count(F.lit(1)).alias("n_rows"))
        .filter(F.col("n_rows") > 1)
        .drop(*_KEY)
    )


def stale_columns(control: DataFrame, columns: DataFrame) -> DataFrame:
    """Control rows whose column is no longer in the inventory."""
    known = _keyed(columns).select(*_KEY)
    return _keyed(control).join(shuffled(known), _KEY, "left_anti").select(*control.columns)
