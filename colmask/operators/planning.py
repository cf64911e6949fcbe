"""Which columns still need a mask, and which mask."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colmask.functions.names import base_type_column
from colmask.functions.redact import MASK_FUNCTIONS
from colmask.operators.control import flagged
from colmask.operators.joins import shuffled
from colmask.operators.numbering import number_rows


def masked_columns_from_ddl(ddl: DataFrame, strict: bool = True) -> DataFrame:
    """Columns that table definitions ``(TableName, ddl)`` show with a mask.

    ``strict`` reads column definitions: a quoted or plain name, a type and
    then a MASK clause, outside comments. Without it any line with the text
    MASK counts and its first word is taken for the column.
    """
    lines = ddl.select("TableName", F.explode(F.split("ddl", "\n")).alias("line"))
    if strict:
        bare = F.regexp_replace("line", r"(`(?:[^`]|``)*`)|'(?:[^'\\]|\\.)*'", "$1")
        name = F.regexp_extract(bare, r"^\s*(`(?:[^`]|``)+`|[^\s`(),]+)\s+[A-Za-z].*?\sMASK\s+\S", 1)
        inner = F.replace(F.expr("substring(_name, 2, length(_name) - 2)"), F.lit("``"), F.lit("`"))
        columns = (
            lines.filter(F.col("line").contains("MASK"))
            .select("TableName", name.alias("_name"))
            .filter(F.col("_name") != "")
            .select("TableName", F.when(F.col("_name").startswith("`"), inner)
                    .otherwise(F.col("_name")).alias("ColumnName"))
        )
    else:
        first = F.regexp_extract("line", r"^\s*(\S+)", 1)
        columns = lines.filter(F.col("line").contains("MASK")).select(
            "TableName", F.replace(first, F.lit("`"), F.lit("")).alias("ColumnName")
        )
    return columns.dropDuplicates()


def pending_columns(control: DataFrame, applied: DataFrame) -> DataFrame:
    """Flagged control rows without a mask; names compare without case."""
    table, column = F.lower("TableName"), F.lower("ColumnName")
    done = applied.select(table.alias("_table"), column.alias("_column"))
    return (
        flagged(control)
        .withColumn("_table", table)
        .withColumn("_column", column)
        .join(shuffled(done), ["_table", "_column"], "left_anti")
        .select(*control.columns)
    )


def _lookup(keys: Column, mapping: Mapping[str, str]) -> Column:
    """CASE over a settings dictionary; NULL where nothing matches."""
    value = None
    for key, entry in mapping.items():
        found = keys == key
        value = F.when(found, F.lit(entry)) if value is None else value.when(found, F.lit(entry))
    return F.lit(None).cast("string") if value is None else value


def mask_plan(
    pending: DataFrame,
    functions: Mapping[str, str] = MASK_FUNCTIONS,
    strategies: Mapping[str, str] | None = None,
) -> DataFrame:
    """The mask for every pending column, by type; types without one are unsupported.

    ``strategies`` sets another strategy than ``redact`` for a category.
    """
    function = _lookup(base_type_column(F.col("DataType")), functions)
    strategy = _lookup(F.lower("PIICategory"), strategies or {})
    return pending.select(
        "TableName",
        "ColumnName",
        F.lower("DataType").alias("DataType"),
        function.alias("mask_function"),
        F.coalesce(strategy, F.lit("redact")).alias("strategy"),
        F.when(function.isNull(), "unsupported").otherwise("pending").alias("status"),
    )


def mark_due(plan: DataFrame, applied: DataFrame) -> DataFrame:
    """``plan`` with ``due``: the column has no mask yet, or one of another strategy.

    ``applied`` has (TableName, ColumnName, strategy); a null or absent strategy is a mask that no
    run of ours made and counts as any. Names compare without case.
    """
    if "strategy" not in applied.columns:
        applied = applied.withColumn("strategy", F.lit(None).cast("string"))
    table, column = F.lower("TableName"), F.lower("ColumnName")
    done = applied.select(table.alias("_table"), column.alias("_column"), F.col("strategy").alias("_strategy"))
    done = done.groupBy("_table", "_column").agg(
        F.max(F.col("_strategy").isNull()).alias("_any"), F.max("_strategy").alias("_strategy")
    )
    same = F.coalesce(F.col("_any"), F.lit(False)) | F.col("_strategy").eqNullSafe(F.col("strategy"))
    return (
        plan.withColumn("_table", table)
        .withColumn("_column", column)
        .join(shuffled(done), ["_table", "_column"], "left")
        .select(*plan.columns, (~same).alias("due"))
    )


def unsupported(plan: DataFrame) -> DataFrame:
    return plan.filter(F.col("status") == "unsupported").select(
        "TableName",
        "ColumnName",
        "DataType",
        F.concat(F.lit("Unsupported data type: "), F.col("DataType")).alias("error"),
    )


def unsupported_messages(plan: DataFrame, names_per_line: int = 100) -> DataFrame:
    """All unsupported columns as text, see ``name_lines``."""
    return name_lines(unsupported(plan), names_per_line)


def name_lines(columns: DataFrame, names_per_line: int = 100) -> DataFrame:
    """Columns as text, ``table.column`` joined by ``; ``.

    Lines of at most ``names_per_line`` names, however many columns there are
    and however many of them one table has.
    """
    columns = columns.select("TableName", "ColumnName").distinct()
    numbered = number_rows(columns, ["TableName", "ColumnName"], "_n")
    line = F.floor((F.col("_n") - 1) / names_per_line).cast("bigint")
    name = F.concat_ws(".", "TableName", "ColumnName")
    return (
        numbered.groupBy(line.alias("line"))
        .agg(
            F.count(F.lit(1)).alias("n_columns"),
            F.array_join(F.array_sort(F.collect_list(name)), "; ").alias("message"),
        )
    )
