"""Find sensitive columns and record them in the control table."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from colmask.functions.names import quote_table
from colmask.operators.discover import classify_columns, classify_fields
from colmask.operators.rules import Rule
from colmask.session import drop_folder, work_folder
from colmask.sources.inventory import (
    catalog_tables,
    columns_inventory,
    write_inventory,
)
from colmask.sources.versions import ControlTable


def discover_table(
    spark: SparkSession,
    name: str,
    control: ControlTable,
    rules: Sequence[Rule] | None = None,
    keep_flag: bool = True,
    nested: bool = False,
) -> DataFrame:
    """Scan one catalog table into the control table; returns its matches."""
    return discover_frames(spark, {name: spark.table(quote_table(name))}, control, rules, keep_flag, nested)


def discover_frames(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    control: ControlTable,
    rules: Sequence[Rule] | None = None,
    keep_flag: bool = True,
    nested: bool = False,
) -> DataFrame:
    """Like ``discover_table`` for tables given as frames, e.g. read from files.

    With ``nested`` the fields of structs, arrays and maps are found as well, by their paths.
    """
    columns = columns_inventory(spark, tables, nested)
    matches = classify_fields(columns, rules) if nested else classify_columns(columns, rules)
    control.add(matches, keep_flag)
    return matches


def discover_catalog(
    spark: SparkSession,
    control: ControlTable,
    rules: Sequence[Rule] | None = None,
    keep_flag: bool = True,
    names: Iterable[str] | None = None,
    nested: bool = False,
) -> DataFrame:
    """Scan every table of the session's catalogs outside the excluded namespaces; returns the run log.

    Definitions are read from the catalog in batches that are written out,
    then all tables are classified and merged in one job. A catalog, schema or table
    that fails is in the log and stops nothing. With ``nested`` the fields of structs, arrays and maps are
    found as well, by their paths.
    """
    if names is None:
        names = catalog_tables(spark)
    path = work_folder(spark, "inventory")
    columns, log = write_inventory(spark, names, path, nested=nested)
    control.add(classify_fields(columns, rules) if nested else classify_columns(columns, rules), keep_flag)
    drop_folder(spark, f"{path}/columns")
    return log
