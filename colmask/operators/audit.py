"""Reports on runs and on what masks leave visible."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colmask.functions.names import base_type, find_column, quote_ident
from colmask.functions.nested import leaves
from colmask.functions.redact import MASK_FUNCTIONS, mask_sql, survives_redaction_sql, text_sql
from colmask.operators.planning import masked_columns_from_ddl


def run_summary(log: DataFrame) -> DataFrame:
    """Totals of a run log: units by outcome, units, columns."""
    status = F.col("status")
    return log.agg(
        F.count_if(status == "success").alias("n_success"),
        F.count_if(status == "skipped").alias("n_skipped"),
        F.count_if(status == "failed").alias("n_failed"),
        F.count(F.lit(1)).alias("n_total"),
        F.coalesce(F.sum("n_columns"), F.lit(0)).alias("n_columns"),
    )


def log_from_plan(plan: DataFrame) -> DataFrame:
    """Run log with one row per table of a mask plan."""
    bad = F.count_if(F.col("status") == "unsupported")
    return plan.groupBy(F.col("TableName").alias("unit")).agg(
        F.when(bad > 0, "failed").otherwise("success").alias("status"),
        F.count_if(F.col("status") == "pending").alias("n_columns"),
        F.when(bad > 0, F.concat(bad.cast("string"), F.lit(" unsupported column(s)"))).alias("error"),
    )


def log_from_columns(mask_log: DataFrame) -> DataFrame:
    """Run log with one row per table of a mask log."""
    bad = F.count_if(F.col("status") != "success")
    return mask_log.groupBy(F.col("TableName").alias("unit")).agg(
        F.when(bad > 0, "failed").otherwise("success").alias("status"),
        F.count_if(F.col("status") == "success").alias("n_columns"),
        F.when(bad > 0, F.concat(bad.cast("string"), F.lit(" failed column(s)"))).alias("error"),
    )


def as_json(log: DataFrame) -> DataFrame:
    """Every row as one JSON text, absent values included."""
    row = F.struct(*[F.col(c) for c in log.columns])
    return log.select(F.to_json(row, {"ignoreNullFields": "false"}).alias("record"))


def masked_count_by_table(ddl: DataFrame, strict: bool = True) -> DataFrame:
    """Number of columns each table definition shows with a mask."""
    return (
        masked_columns_from_ddl(ddl, strict)
        .groupBy("TableName")
        .agg(F.count(F.lit(1)).alias("n_masked"))
    )


def _by_column(name: str, counted: DataFrame, columns: list[str], *counts: str) -> DataFrame:
    """One row per column from one row with ``<count><i>`` for column ``i``."""
    pairs = [
        "struct(" + ", ".join(f"{count}{i} AS {count}" for count in counts) + ")"
        for i in range(len(columns))
    ]
    return counted.selectExpr(f"posexplode(array({', '.join(pairs)})) AS (i, counts)").select(
        F.lit(name).alias("TableName"),
        F.get(F.lit(columns), F.col("i")).alias("ColumnName"),
        *[f"counts.{count}" for count in counts],
    )


def count_values(name: str, df: DataFrame, columns: list[str]) -> DataFrame:
    """Number of stored (not NULL) values of the given columns of one table."""
    counts = [f"count({quote_ident(c)}) AS n_values{i}" for i, c in enumerate(columns)]
    return _by_column(name, df.selectExpr(*counts), columns, "n_values")


def _same_sql(value: str, dtype: str, strategy: str) -> str:
    """Whether a value comes through its mask unchanged."""
    if strategy == "redact":
        return survives_redaction_sql(value, dtype)
    if strategy == "token":
        return f"{text_sql(value)} RLIKE '^tok_[0-9]+$'"
    return f"{mask_sql(value, dtype, strategy, key="''")} = {text_sql(value)}"


def exposure_audit(
    name: str,
    df: DataFrame,
    strategies: Mapping[str, str] | None = None,
    functions: Mapping[str, str] = MASK_FUNCTIONS,
) -> DataFrame:
    """Per column, how many values come through the mask unchanged.

    ``strategies`` maps columns to mask strategies; without it every column
    of a supported type is redacted. Names compare without case. A value that looks like a
    token may come through as one and is counted. One aggregation over the
    columns asked for.
    """
    types = dict(df.dtypes)
    if strategies is None:
        strategies = {c: "redact" for c, t in types.items() if base_type(t) in functions}
    counts = []
    strategies = {find_column(df, c): strategy for c, strategy in strategies.items()}
    for i, (column, strategy) in enumerate(strategies.items()):
        value, dtype = quote_ident(column), types[column]
        same = _same_sql(value, dtype, strategy)
        counts += [f"count({value}) AS n_values{i}", f"count_if({same}) AS n_exposed{i}"]
    return _by_column(name, df.selectExpr(*counts), list(strategies), "n_values", "n_exposed")


def fields_exposure(
    name: str,
    df: DataFrame,
    strategies: Mapping[str, str] | None = None,
    functions: Mapping[str, str] = MASK_FUNCTIONS,
) -> DataFrame:
    """``exposure_audit`` of the fields inside structs, arrays and maps too, by their paths.

    Every value of an array or map counts on its own. ``strategies`` are by path of single fields.
    """
    found = {leaf.path.lower(): leaf for leaf in leaves(df.schema)}
    if strategies is None:
        strategies = {leaf.path: "redact" for leaf in found.values() if base_type(leaf.dtype) in functions}
    missing = [path for path in strategies if path.lower() not in found]
    if missing:
        raise ValueError(f"no such field: {', '.join(missing)}")
    counts = []
    for i, (path, strategy) in enumerate(strategies.items()):
        leaf = found[path.lower()]
        same = _same_sql("_v", leaf.dtype, strategy)
        for count, condition in (("n_values", "_v IS NOT NULL"), ("n_exposed", f"_v IS NOT NULL AND {same}")):
            held = f"filter({leaf.values}, _v -> {condition})"
            counts.append(f"coalesce(sum(coalesce(size({held}), 0)), 0) AS {count}{i}")
    return _by_column(name, df.selectExpr(*counts), [found[p.lower()].path for p in strategies], "n_values", "n_exposed")
