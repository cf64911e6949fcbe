"""The control table: reading, merging, pruning, checking."""

from __future__ import annotations

from pyspark.sql import functions as F

from colmask import (
    classify_columns,
    duplicate_keys,
    flagged_tables,
    prune_control,
    stale_columns,
    upsert_control,
)
from colmask.operators.control import assign_ids
from colmask.session import work_folder
from colmask.sources.versions import ControlTable
from entry_queries import derived as d
from entry_queries.derived import table


def _stored(spark, sf_dir) -> ControlTable:
    """The derived control rows, written as the first version of a control table."""
    control = ControlTable(spark, work_folder(spark, "control"))
    control.create()
    control.write(d.control(spark, sf_dir))
    return control


def _matches(spark, sf_dir):
    return classify_columns(d.patient_columns(spark, sf_dir))


def control_read(spark, sf_dir):
    """Merge a scan into a stored control table and read the new version."""
    control = _stored(spark, sf_dir)
    control.add(_matches(spark, sf_dir))
    return control.read()


def control_flagged(spark, sf_dir):
    """Flagged rows, read again after tables that are gone were pruned."""
    control = _stored(spark, sf_dir)
    control.prune(d.dead_tables(spark, sf_dir))
    return control.flagged()


def flagged_tables_query(spark, sf_dir):
    return flagged_tables(d.control(spark, sf_dir))


def control_ids(spark, sf_dir):
    """Ids of a control table filled from scratch."""
    return assign_ids(_matches(spark, sf_dir))


def control_upsert_keep_flag(spark, sf_dir):
    return upsert_control(d.control(spark, sf_dir), _matches(spark, sf_dir))


def control_upsert_overwrite(spark, sf_dir):
    return upsert_control(d.control(spark, sf_dir), _matches(spark, sf_dir), keep_flag=False)


def control_prune(spark, sf_dir):
    return prune_control(d.control(spark, sf_dir), d.dead_tables(spark, sf_dir))


def control_duplicates(spark, sf_dir):
    """Event types logged more than once per user, as columns listed twice."""
    rows = table(spark, sf_dir, "events").select(
        F.concat(F.lit("app.events.user_"), F.col("user_id").cast("string")).alias("TableName"),
        F.col("event_type").alias("ColumnName"),
    )
    return duplicate_keys(rows)


def control_stale(spark, sf_dir):
    return stale_columns(d.control(spark, sf_dir), d.patient_columns(spark, sf_dir))


QUERIES = {
    "control_read": control_read,
    "control_flagged": control_flagged,
    "flagged_tables": flagged_tables_query,
    "control_ids": control_ids,
    "control_upsert_keep_flag": control_upsert_keep_flag,
    "control_upsert_overwrite": control_upsert_overwrite,
    "control_prune": control_prune,
    "control_duplicates": control_duplicates,
    "control_stale": control_stale,
}

_MERGED = "WITH {0}, {1}, {2} SELECT * FROM merged"
_NOT_DEAD = "NOT EXISTS (SELECT 1 FROM dead WHERE dead.TableName = control.TableName)"

ORACLES = {
    "control_read": _MERGED.format(d.CONTROL, d.DEFAULT_MATCHES, d.merged_sql(d.KEEP_FLAG)),
    "control_flagged": f"WITH {d.CONTROL}, {d.DEAD} SELECT * FROM control WHERE EncryptFlag AND {_NOT_DEAD}",
    "flagged_tables": f"WITH {d.CONTROL} SELECT DISTINCT TableName FROM control WHERE EncryptFlag",
    "control_ids": f"WITH {d.DEFAULT_MATCHES} SELECT m.*, row_number() OVER ("
    "ORDER BY md5(TableName || chr(31) || ColumnName), TableName, ColumnName) AS Id FROM matches m",
    "control_upsert_keep_flag": _MERGED.format(
        d.CONTROL, d.DEFAULT_MATCHES, d.merged_sql(d.KEEP_FLAG)
    ),
    "control_upsert_overwrite": _MERGED.format(
        d.CONTROL, d.DEFAULT_MATCHES, d.merged_sql(d.OVERWRITE_FLAG)
    ),
    "control_prune": f"WITH {d.CONTROL}, {d.DEAD} SELECT * FROM control WHERE {_NOT_DEAD}",
    "control_duplicates": "SELECT 'app.events.user_' || CAST(user_id AS VARCHAR) AS TableName, "
    "event_type AS ColumnName, count(*) AS n_rows FROM events GROUP BY ALL HAVING count(*) > 1",
    "control_stale": f"WITH {d.CONTROL}, {d.PATIENTS} SELECT * FROM control c WHERE NOT EXISTS ("
    "SELECT 1 FROM columns p WHERE lower(p.TableName) = lower(c.TableName) "
    "AND lower(p.ColumnName) = lower(c.ColumnName))",
}
