"""Table definitions as text."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from colmask import schemas
from colmask.functions.names import quote_table

_MISSING = ("TABLE_OR_VIEW_NOT_FOUND", "SCHEMA_NOT_FOUND")
_PARTS = {"ddl": schemas.DDL, "log": schemas.RUN_LOG, "gone": "TableName string"}


def write_definitions(
    spark: SparkSession, names: Iterable[str], path: str, batch: int = 1000
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Definitions, run log, and the tables that are confirmed to be gone.

    They are written under ``path``, ``batch`` tables at a time. Only a table
    the catalog does not know counts as gone; any other error is logged as
    skipped and leaves the control table alone.
    """
    rows: dict[str, list[tuple]] = {part: [] for part in _PARTS}

    def save(mode):
        for part, schema in _PARTS.items():
            frame = spark.createDataFrame(rows[part], schema)
            frame.coalesce(1).write.mode(mode).parquet(f"{path}/{part}")
            rows[part].clear()

    save("overwrite")
    for name in names:
        try:
            text = spark.sql(f"SHOW CREATE TABLE {quote_table(name)}").first()[0]
        except Exception as error:
            rows["log"].append((name, "skipped", 0, str(error)))
            if isinstance(error, AnalysisException) and error.getCondition() in _MISSING:
                rows["gone"].append((name,))
        else:
            rows["ddl"].append((name, text))
            rows["log"].append((name, "success", 0, None))
        if len(rows["log"]) == batch:
            save("append")
    if rows["log"]:
        save("append")
    ddl, log, gone = (
        spark.read.schema(schema).parquet(f"{path}/{part}") for part, schema in _PARTS.items()
    )
    return ddl, log, gone
