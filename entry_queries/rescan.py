"""Scans by difference: what changed between two inventories, and the control table after both."""

from __future__ import annotations

from pyspark.sql import functions as F

from colmask import ControlTable, Snapshot, default_rules, discover_changes
from colmask.session import stored, work_folder
from entry_queries import derived as d


def _inventories(spark, sf_dir):
    """The tenants' tables at two times: a tenth came, a tenth went, and a tenth has other columns."""
    columns = d.patient_columns(spark, sf_dir)
    turn = F.pmod(F.regexp_extract("TableName", "([0-9]+)$", 1).cast("bigint"), F.lit(10))
    added = F.struct(F.lit(35).alias("Ordinal"), F.lit("second_ssn").alias("ColumnName"), F.lit("string").alias("DataType"))
    kept = columns.filter((turn != 1) & ((turn != 0) | (F.col("ColumnName") != "ssn_history"))).withColumn(
        "DataType", F.when((turn == 0) & (F.col("ColumnName") == "zip_code"), "string").otherwise(F.col("DataType"))
    )
    fresh = columns.filter((turn == 0) & (F.col("Ordinal") == 0)).select("TableName", F.inline(F.array(added)))
    return stored(columns.filter(turn != 2), "first"), stored(kept.unionByName(fresh), "second")


def _scanned(spark, sf_dir):
    control = ControlTable(spark, work_folder(spark, "control"))
    control.create()
    snapshot = Snapshot(spark, work_folder(spark, "snapshot"))
    runs = [discover_changes(spark, control, snapshot, columns) for columns in _inventories(spark, sf_dir)]
    return control, runs[-1]


def rescan_changes(spark, sf_dir):
    """Every column that the second scan found changed, with the number of tables it classified."""
    _, run = _scanned(spark, sf_dir)
    return run.changes.withColumn("n_tables", F.lit(run.n_tables).cast("bigint"))


def rescan_control(spark, sf_dir):
    """The control table after the first scan and the second, which classified the changed tables alone."""
    return _scanned(spark, sf_dir)[0].read()


QUERIES = {"rescan_changes": rescan_changes, "rescan_control": rescan_control}

_TURN = "CAST(regexp_extract(TableName, '([0-9]+)$', 1) AS BIGINT) % 10"
_TIMES = f"""WITH {d.PATIENTS},
first AS (SELECT * FROM columns WHERE {_TURN} <> 2),
second AS (
  SELECT TableName, Ordinal, ColumnName,
    CASE WHEN {_TURN} = 0 AND ColumnName = 'zip_code' THEN 'string' ELSE DataType END AS DataType
  FROM columns WHERE {_TURN} <> 1 AND ({_TURN} <> 0 OR ColumnName <> 'ssn_history')
  UNION ALL SELECT TableName, 35, 'second_ssn', 'string' FROM columns WHERE {_TURN} = 0 AND Ordinal = 0)"""

ORACLES = {
    "rescan_changes": f"""{_TIMES},
changed AS (
  SELECT TableName, ColumnName, a.DataType AS OldType, b.DataType AS NewType,
    CASE WHEN a.Ordinal IS NULL THEN 'added' WHEN b.Ordinal IS NULL THEN 'dropped'
      WHEN a.DataType <> b.DataType THEN 'retyped' WHEN a.Ordinal <> b.Ordinal THEN 'moved' END AS change
  FROM first a FULL OUTER JOIN second b USING (TableName, ColumnName))
SELECT *, (SELECT count(DISTINCT TableName) FROM changed WHERE change IS NOT NULL AND TableName IN (SELECT TableName FROM second)) AS n_tables
FROM changed WHERE change IS NOT NULL""",
    "rescan_control": f"""{_TIMES},
control AS (
  WITH columns AS (SELECT * FROM first), {d.matches_sql(default_rules())}
  SELECT row_number() OVER (ORDER BY md5(TableName || chr(31) || ColumnName), TableName, ColumnName) AS Id, * FROM matches),
matches AS (
  WITH columns AS (SELECT * FROM second), {d.matches_sql(default_rules())} SELECT * FROM matches),
{d.merged_sql(d.KEEP_FLAG)}
SELECT * FROM merged""",
}
