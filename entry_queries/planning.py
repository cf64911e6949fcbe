"""From table definitions and the control table to a mask plan and its report."""

from __future__ import annotations

from colmask import (
    classify_columns,
    flagged,
    mask_plan,
    masked_columns_from_ddl,
    pending_columns,
    unsupported,
    unsupported_messages,
    upsert_control,
)
from colmask.functions.redact import MASK_FUNCTIONS
from colmask.operators.audit import as_json, log_from_plan, masked_count_by_table, run_summary
from colmask.plans.apply import remaining_plan
from entry_queries import derived as d


def ddl_masked_columns(spark, sf_dir):
    return masked_columns_from_ddl(d.ddl(spark, sf_dir), strict=False)


def ddl_masked_columns_strict(spark, sf_dir):
    return masked_columns_from_ddl(d.ddl(spark, sf_dir))


def masked_count(spark, sf_dir):
    return masked_count_by_table(d.ddl(spark, sf_dir))


def _pending(spark, sf_dir):
    matches = classify_columns(d.patient_columns(spark, sf_dir))
    control = upsert_control(d.control(spark, sf_dir), matches)
    return pending_columns(control, masked_columns_from_ddl(d.ddl(spark, sf_dir)))


def pending(spark, sf_dir):
    return _pending(spark, sf_dir).select("TableName", "PIICategory", "ColumnName", "DataType")


def _plan(spark, sf_dir):
    return mask_plan(_pending(spark, sf_dir), strategies={"ssn": "hash", "mail": "shape"})


def plan_remaining(spark, sf_dir):
    """All flagged columns of the tables that need a new copy."""
    applied = masked_columns_from_ddl(d.ddl(spark, sf_dir))
    return remaining_plan(flagged(d.control(spark, sf_dir)), applied)


def plan_unsupported(spark, sf_dir):
    return unsupported(_plan(spark, sf_dir))


def plan_unsupported_message(spark, sf_dir):
    return unsupported_messages(_plan(spark, sf_dir))


def run_log(spark, sf_dir):
    return log_from_plan(_plan(spark, sf_dir))


def run_summary_query(spark, sf_dir):
    return run_summary(run_log(spark, sf_dir))


def run_log_json(spark, sf_dir):
    return as_json(run_log(spark, sf_dir))


QUERIES = {
    "ddl_masked_columns": ddl_masked_columns,
    "ddl_masked_columns_strict": ddl_masked_columns_strict,
    "masked_count_by_table": masked_count,
    "pending_columns": pending,
    "mask_plan": _plan,
    "plan_remaining": plan_remaining,
    "plan_unsupported": plan_unsupported,
    "plan_unsupported_message": plan_unsupported_message,
    "run_log": run_log,
    "run_summary": run_summary_query,
    "run_log_json": run_log_json,
}

_MAP = ", ".join(f"('{t}', '{f}')" for t, f in MASK_FUNCTIONS.items())
_PENDING = f"""WITH {d.CONTROL}, {d.DEFAULT_MATCHES}, {d.merged_sql(d.KEEP_FLAG)}, {d.DDL}, {d.STRICT_COLUMNS},
pending AS (
  SELECT * FROM merged m WHERE EncryptFlag AND NOT EXISTS (SELECT 1 FROM applied a
    WHERE lower(a.TableName) = lower(m.TableName) AND lower(a.ColumnName) = lower(m.ColumnName)))"""
_PLAN = f"""{_PENDING},
functions(dtype, mask_function) AS (VALUES {_MAP}),
plan AS (
  SELECT TableName, ColumnName, lower(DataType) AS DataType, mask_function,
    CASE PIICategory WHEN 'ssn' THEN 'hash' WHEN 'mail' THEN 'shape' ELSE 'redact' END AS strategy,
    CASE WHEN mask_function IS NULL THEN 'unsupported' ELSE 'pending' END AS status
  FROM pending LEFT JOIN functions ON dtype =
    CASE WHEN starts_with(lower(DataType), 'decimal') THEN 'decimal' ELSE lower(DataType) END)"""
_LOG = f"""{_PLAN},
tally AS (
  SELECT TableName AS unit, count(*) FILTER (status = 'unsupported') AS bad,
    count(*) FILTER (status = 'pending') AS n_columns
  FROM plan GROUP BY TableName),
log AS (
  SELECT unit, CASE WHEN bad > 0 THEN 'failed' ELSE 'success' END AS status, n_columns,
    CASE WHEN bad > 0 THEN bad || ' unsupported column(s)' END AS error
  FROM tally)"""

ORACLES = {
    "ddl_masked_columns": f"WITH {d.DDL}, {d.LOOSE_COLUMNS} SELECT * FROM applied",
    "ddl_masked_columns_strict": f"WITH {d.DDL}, {d.STRICT_COLUMNS} SELECT * FROM applied",
    "masked_count_by_table": f"WITH {d.DDL}, {d.STRICT_COLUMNS} "
    "SELECT TableName, count(*) AS n_masked FROM applied GROUP BY TableName",
    "pending_columns": f"{_PENDING} SELECT TableName, PIICategory, ColumnName, DataType FROM pending",
    "mask_plan": f"{_PLAN} SELECT * FROM plan",
    "plan_remaining": f"""WITH {d.CONTROL}, {d.DDL}, {d.STRICT_COLUMNS},
functions(dtype, mask_function) AS (VALUES {_MAP}),
open AS (
  SELECT DISTINCT TableName FROM control c WHERE EncryptFlag AND NOT EXISTS (SELECT 1 FROM applied a
    WHERE lower(a.TableName) = lower(c.TableName) AND lower(a.ColumnName) = lower(c.ColumnName)))
SELECT TableName, ColumnName, DataType, mask_function, 'redact' AS strategy, 'pending' AS status,
  NOT EXISTS (SELECT 1 FROM applied a WHERE lower(a.TableName) = lower(control.TableName)
    AND lower(a.ColumnName) = lower(control.ColumnName)) AS due
FROM control JOIN open USING (TableName) JOIN functions ON dtype = DataType WHERE EncryptFlag""",
    "plan_unsupported": f"{_PLAN} SELECT TableName, ColumnName, DataType, "
    "'Unsupported data type: ' || DataType AS error FROM plan WHERE status = 'unsupported'",
    "plan_unsupported_message": f"""{_PLAN},
numbered AS (
  SELECT TableName || '.' || ColumnName AS name, row_number() OVER (
    ORDER BY md5(TableName || chr(31) || ColumnName), TableName, ColumnName) AS n
  FROM plan WHERE status = 'unsupported')
SELECT (n - 1) // 100 AS line, count(*) AS n_columns, string_agg(name, '; ' ORDER BY name) AS message
FROM numbered GROUP BY 1""",
    "run_log": f"{_LOG} SELECT * FROM log",
    "run_summary": f"{_LOG} SELECT count(*) FILTER (status = 'success') AS n_success, "
    "count(*) FILTER (status = 'skipped') AS n_skipped, count(*) FILTER (status = 'failed') AS n_failed, "
    "count(*) AS n_total, CAST(sum(n_columns) AS BIGINT) AS n_columns FROM log",
    "run_log_json": f"""{_LOG} SELECT '{{"unit":"' || unit || '","status":"' || status
|| '","n_columns":' || n_columns || ',"error":' || coalesce('"' || error || '"', 'null') || '}}'
AS record FROM log""",
}
