"""Mask what the control table flags and no run has masked yet."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colmask import schemas
from colmask.functions.names import quote_table
from colmask.functions.redact import MASK_FUNCTIONS
from colmask.functions.sql import ACCESS_GROUP
from colmask.operators.audit import log_from_columns, run_summary
from colmask.operators.control import flagged_tables
from colmask.operators.joins import skew_join
from colmask.operators.planning import mark_due, mask_plan, masked_columns_from_ddl
from colmask.plans.mask import (
    RunLog,
    sort_out,
    applied_columns,
    by_table,
    create_masked_view,
    mask_all,
    raise_failures,
)
from colmask.session import stored, work_area, work_folder
from colmask.sources.ddl import write_definitions
from colmask.sources.versions import ControlTable


def applied_so_far(spark: SparkSession, log_root: str) -> DataFrame:
    """Columns that the logs of earlier runs show as masked."""
    try:
        logs = spark.read.schema(schemas.MASK_LOG).parquet(f"{log_root}/run=*")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        logs = spark.createDataFrame([], schemas.MASK_LOG)
    return applied_columns(logs)


def remaining_plan(
    flagged: DataFrame,
    applied: DataFrame,
    functions: Mapping[str, str] = MASK_FUNCTIONS,
    strategies: Mapping[str, str] | None = None,
) -> DataFrame:
    """Mask plan, with ``due``, for the tables with a due column.

    It lists all flagged columns of such a table: its copy is written anew and
    must not lose the masks it had.
    """
    plan = stored(mark_due(mask_plan(flagged, functions, strategies), applied), "plan")
    tables = plan.filter("due").select("TableName").distinct()
    return skew_join(plan, tables, ["TableName"], "left_semi")


@dataclass(frozen=True)
class ApplyRun:
    """What a run did: ``log`` has a row per column, ``inspection`` one per flagged table."""

    log: DataFrame
    inspection: DataFrame

    def summary(self) -> DataFrame:
        """Totals over tables, those that could not be inspected among them."""
        skipped = self.inspection.filter(F.col("status") != "success")
        return run_summary(log_from_columns(self.log).unionByName(skipped))


def _inspect(spark: SparkSession, control: ControlTable, log_path: str) -> tuple[DataFrame, DataFrame]:
    """Definitions of the flagged tables, and the log of reading them; prunes tables that are gone."""
    names = (r["TableName"] for r in flagged_tables(control.read()).toLocalIterator())
    ddl, log, gone = write_definitions(spark, names, work_folder(spark, "definitions"))
    if not gone.isEmpty():
        control.prune(gone)
    log.write.parquet(log_path)
    return ddl, spark.read.schema(log.schema).parquet(log_path)


def apply_control(
    spark: SparkSession,
    control: ControlTable,
    write: Callable[[str, DataFrame], None],
    log_root: str,
    strategies: Mapping[str, str] | None = None,
    functions: Mapping[str, str] = MASK_FUNCTIONS,
    refresh: bool = False,
    **options,
) -> ApplyRun:
    """Write masked copies of all catalog tables that need one.

    Tables that are gone are pruned from the control table first. Columns
    whose definition shows a mask, and columns masked with the same strategy by an earlier run under
    ``log_root``, count as done, so a repeated run writes nothing, and a changed strategy writes
    the table anew. A copy holds the rows the source had when it was written: pass ``refresh`` to write
    all copies anew after the sources have grown, or use ``apply_views``, which follow the table. Further
    options are those of ``mask_all``.
    """
    number = uuid.uuid4().hex

    def read(name: str) -> DataFrame:
        return spark.table(quote_table(name))

    with work_area(spark):
        ddl, inspection = _inspect(spark, control, f"{log_root}/inspection={number}")
        applied = masked_columns_from_ddl(ddl).withColumn("strategy", F.lit(None).cast("string"))
        if not refresh:
            applied = applied.unionByName(applied_so_far(spark, log_root))
        plan = remaining_plan(control.flagged(), applied, functions, strategies)
        log = mask_all(spark, plan, read, write, f"{log_root}/run={number}", functions=functions, **options)
    return ApplyRun(log, inspection)


def apply_views(
    spark: SparkSession,
    control: ControlTable,
    view: Callable[[str], str],
    grants_table: str,
    log_root: str,
    strategies: Mapping[str, str] | None = None,
    functions: Mapping[str, str] = MASK_FUNCTIONS,
    group: str = ACCESS_GROUP,
    key: str | None = None,
    temporary: bool = False,
    strict: bool = True,
    keep_unsupported: bool = False,
    closure_table: str | None = None,
) -> ApplyRun:
    """Create or replace a masked view for every table with flagged columns.

    ``view`` names the view of a table. What a view shows depends on who reads it and follows the table's rows, so views
    have to be made again only when flags, strategies or columns change. Hashes need
    ``key``, see ``create_masked_view``. Columns of unsupported types are
    left out unless ``keep_unsupported``. Failures are logged and, with ``strict``,
    raised at the end, as in ``mask_all``; a table whose columns are all unsupported or gone gets no view.
    """
    number = uuid.uuid4().hex
    log_path = f"{log_root}/views={number}"
    with work_area(spark):
        _, inspection = _inspect(spark, control, f"{log_root}/inspection={number}")
    log = RunLog(spark, log_path)
    for table, entries in by_table(mask_plan(control.flagged(), functions, strategies)):
        try:
            columns, rows, unmasked = sort_out(spark.table(quote_table(table)), entries, functions, keep_unsupported)
            if columns:
                create_masked_view(
                    spark, view(table), table, columns, grants_table, group, temporary, functions, key,
                    () if keep_unsupported else unmasked, closure_table,
                )
        except Exception as error:
            rows = [(e["ColumnName"], "failed", str(error), e["strategy"]) for e in entries]
        log.add(table, rows)
    frame = log.read()
    if strict:
        raise_failures(frame, log_path)
    return ApplyRun(frame, inspection)
