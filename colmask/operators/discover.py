"""Find columns that look sensitive in an inventory of columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colmask.operators.rule_index import classify_indexed
from colmask.operators.rules import (
    Rule,
    default_rules,
    first_keyword,
    has_excluded_suffix,
    rule_position,
    rules_value,
)


def _candidates(
    columns: DataFrame, rules: Sequence[Rule] | DataFrame | None, excluded: bool, also: Sequence[str] = ()
) -> DataFrame:
    """Lowercased columns that a rule matches, with ``hit``: ``prio`` and ``keyword`` of the first such rule.

    The hit goes through ``explode`` so that the filter on it stays above
    the projection. Pushed below, it would lowercase the name once per rule.
    """
    lower = columns.select(
        "TableName",
        "Ordinal",
        F.lower("ColumnName").alias("ColumnName"),
        F.lower("DataType").alias("DataType"),
        *also,
    )
    name, dtype = F.col("ColumnName"), F.col("DataType")
    if isinstance(rules, DataFrame):
        value = first_keyword(name, dtype, F.col("_rules"))
        lower = lower.withColumn("_rules", rules_value(rules))
        hit = F.when(value.isNotNull(), F.struct(value["prio"].alias("prio"), value["keyword"].alias("keyword")))
    else:
        rules = default_rules() if rules is None else list(rules)
        words = F.array(*[F.lit(r.keyword.lower()) for r in rules] or [F.lit("")])
        lower = lower.withColumn("_prio", F.explode(F.array(rule_position(name, dtype, rules))))
        prio = F.col("_prio")
        hit = F.when(prio.isNotNull(), F.struct(prio.alias("prio"), F.get(words, prio).alias("keyword")))
    suffix = has_excluded_suffix(name)
    hit = F.when(suffix if excluded else ~suffix, hit)
    kept = ["TableName", "Ordinal", "ColumnName", "DataType", *also]
    return lower.select(*kept, F.explode(F.array(hit)).alias("hit")).filter(F.col("hit").isNotNull())


def classify_columns(columns: DataFrame, rules: Sequence[Rule] | DataFrame | None = None) -> DataFrame:
    """One row per column that a rule matches, with the first such rule's keyword.

    ``rules`` are a list of rules, which becomes part of the query, or a table
    ``(prio, keyword, mode, string_only)`` of any length, which are looked up by an index and not tried one by one on
    every column. Two columns of a table whose names differ only in case count as one: the
    better rule wins, then the earlier column. That step sees matches only,
    combines them before the shuffle, and is keyed by table and column, so a
    table that holds most of the inventory spreads over all tasks.
    """
    if isinstance(rules, DataFrame):
        return classify_indexed(columns, rules, nulls=True)
    matched = _candidates(columns, rules, excluded=False)
    return (
        matched.groupBy("TableName", "ColumnName")
        .agg(F.min(F.struct("hit", "Ordinal", "DataType")).alias("best"))
        .select(
            "TableName",
            F.col("best.hit.keyword").alias("PIICategory"),
            "ColumnName",
            F.col("best.DataType").alias("DataType"),
            F.lit(True).alias("EncryptFlag"),
        )
    )


def classify_fields(fields: DataFrame, rules: Sequence[Rule] | DataFrame | None = None) -> DataFrame:
    """``classify_columns`` for an inventory that was made with ``nested``: one row per field, by its path.

    A field counts if a rule matches its own name or a name around it, the nearest first: all of
    ``address.line`` and ``ssn_history.element`` are found by their column. A field whose own name ends like one that
    holds no personal data is left out, whatever is around it. Rules for texts look at the type of the field.
    """
    own = F.lower(F.get("Names", F.lit(0)))
    named = fields.filter(~has_excluded_suffix(own)).select(
        "TableName", "Ordinal", "DataType", F.lower("ColumnName").alias("_path"),
        F.posexplode("Names").alias("_depth", "ColumnName"),
    )
    matched = _candidates(named, rules, excluded=False, also=("_path", "_depth"))
    return (
        matched.groupBy("TableName", "_path")
        .agg(F.min(F.struct("_depth", "hit", "Ordinal", "DataType")).alias("best"))
        .select(
            "TableName",
            F.col("best.hit.keyword").alias("PIICategory"),
            F.col("_path").alias("ColumnName"),
            F.col("best.DataType").alias("DataType"),
            F.lit(True).alias("EncryptFlag"),
        )
    )


def excluded_by_suffix(columns: DataFrame, rules: Sequence[Rule] | DataFrame | None = None) -> DataFrame:
    """Columns that a rule matches but whose name ending rules them out."""
    return _candidates(columns, rules, excluded=True).select(
        "TableName",
        F.col("hit.keyword").alias("PIICategory"),
        "ColumnName",
        "DataType",
    )
