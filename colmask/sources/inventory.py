"""What tables and columns there are."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from colmask import schemas
from colmask.functions.names import qualified_name, quote_ident, quote_table
from colmask.functions.nested import leaves

# Namespaces that are never scanned, by their exact names. A
# deployment adds its platform's internal catalogs.
EXCLUDED_CATALOGS = ("system", "samples", "hive_metastore")
EXCLUDED_SCHEMAS = ("default", "information_schema", "test")


def _rows(table: str, schema: StructType, nested: bool) -> list[tuple]:
    if nested:
        return [(table, i, leaf.path, leaf.dtype, list(leaf.names)) for i, leaf in enumerate(leaves(schema))]
    return [(table, i, field.name, field.dataType.simpleString()) for i, field in enumerate(schema.fields)]


def columns_inventory(spark: SparkSession, tables: Mapping[str, DataFrame], nested: bool = False) -> DataFrame:
    """Name and type of every top-level column of the given tables.

    With ``nested``, of every field that holds no other fields: its path, its type and the names on its path.
    """
    rows = [row for table, df in tables.items() for row in _rows(table, df.schema, nested)]
    return spark.createDataFrame(rows, schemas.FIELDS if nested else schemas.COLUMNS)


def scan_tables(
    spark: SparkSession, names: Iterable[str | tuple[str, str]], batch: int = 1000, nested: bool = False
) -> Iterator[tuple[DataFrame, DataFrame]]:
    """Inventory and run log of catalog tables, ``batch`` tables at a time.

    ``nested`` is that of ``columns_inventory``. A table that cannot be read is logged as failed and stops nothing. A pair
    (unit, error) among the names is logged as a failure as it is.
    """
    columns, log = [], []

    def frames():
        return (
            spark.createDataFrame(columns, schemas.FIELDS if nested else schemas.COLUMNS),
            spark.createDataFrame(log, schemas.RUN_LOG),
        )

    for name in names:
        if isinstance(name, tuple):
            log.append((name[0], "failed", 0, name[1]))
        else:
            try:
                rows = _rows(name, spark.table(quote_table(name)).schema, nested)
            except Exception as error:
                log.append((name, "failed", 0, str(error)))
            else:
                columns += rows
                log.append((name, "success", len(rows), None))
        if len(log) == batch:
            yield frames()
            columns, log = [], []
    if log:
        yield frames()


def write_inventory(
    spark: SparkSession, names: Iterable[str | tuple[str, str]], path: str, batch: int = 1000, nested: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Scan catalog tables into two written tables; returns (inventory, run log)."""
    columns_schema = schemas.FIELDS if nested else schemas.COLUMNS
    spark.createDataFrame([], columns_schema).write.mode("overwrite").parquet(f"{path}/columns")
    spark.createDataFrame([], schemas.RUN_LOG).write.mode("overwrite").parquet(f"{path}/log")
    for columns, log in scan_tables(spark, names, batch, nested):
        columns.coalesce(1).write.mode("append").parquet(f"{path}/columns")
        log.coalesce(1).write.mode("append").parquet(f"{path}/log")
    return (
        spark.read.schema(columns_schema).parquet(f"{path}/columns"),
        spark.read.schema(schemas.RUN_LOG).parquet(f"{path}/log"),
    )


def stored_tables(spark: SparkSession, namespaces: DataFrame) -> Iterator[str | tuple[str, str]]:
    """Names of all tables of the given schemas, one schema at a time.

    A schema that cannot be listed comes out as the pair (schema, error).
    """
    for row in namespaces.toLocalIterator():
        yield from _tables_of(spark, row["catalog"], row["schema"])


_CATALOG_SETTING = "spark.sql.catalog."


def configured_catalogs(spark: SparkSession) -> list[str]:
    """Every catalog of the session: those in use and those that its settings name, which load when they are first asked."""
    named = (key.removeprefix(_CATALOG_SETTING) for key in spark.conf.getAll if key.startswith(_CATALOG_SETTING))
    # Longer keys are settings of a catalog.
    return sorted({*(c.name for c in spark.catalog.listCatalogs()), *(n for n in named if "." not in n)})


def namespace_rows(
    spark: SparkSession, catalogs: Iterable[str] | None = None
) -> Iterator[tuple[str, str | None, str | None]]:
    """(catalog, schema, None) of every schema, catalog by catalog; (catalog, None, error) of one that cannot be listed."""
    for catalog in configured_catalogs(spark) if catalogs is None else catalogs:
        try:
            listed = spark.sql(f"SHOW SCHEMAS IN {quote_ident(catalog)}").select("namespace").toLocalIterator()
            yield from ((catalog, row["namespace"], None) for row in listed)
        except Exception as error:
            yield catalog, None, str(error)


def list_namespaces(spark: SparkSession) -> DataFrame:
    """(catalog, schema) of every schema of the session's catalogs; those that cannot be listed are left out."""
    rows = [(catalog, schema) for catalog, schema, error in namespace_rows(spark) if error is None]
    return spark.createDataFrame(rows, schemas.NAMESPACES)


def catalog_tables(
    spark: SparkSession,
    catalogs: Sequence[str] = EXCLUDED_CATALOGS,
    schemas: Sequence[str] = EXCLUDED_SCHEMAS,
) -> Iterator[str | tuple[str, str]]:
    """Names of all tables outside the excluded catalogs and schemas, for ``scan_tables``.

    A catalog or schema that cannot be listed comes out as a pair (its name, error), and the others follow. Excluded
    catalogs are not even loaded.
    """
    wanted = [c for c in configured_catalogs(spark) if c not in catalogs]
    for catalog, schema, error in namespace_rows(spark, wanted):
        if error is not None:
            yield catalog, error
        elif schema not in schemas:
            yield from _tables_of(spark, catalog, schema)


def _tables_of(spark: SparkSession, catalog: str, schema: str) -> Iterator[str | tuple[str, str]]:
    try:
        names = table_names(list_tables(spark, catalog, schema)).toLocalIterator()
        yield from (name["TableName"] for name in names)
    except Exception as error:
        yield f"{catalog}.{schema}", str(error)


def list_tables(spark: SparkSession, catalog: str, schema: str) -> DataFrame:
    """(catalog, schema, tableName, isTemporary) of one schema."""
    return spark.sql(f"SHOW TABLES IN {quote_ident(catalog)}.{quote_ident(schema)}").select(
        F.lit(catalog).alias("catalog"), F.lit(schema).alias("schema"), "tableName", "isTemporary"
    )


def exclude_namespaces(
    listing: DataFrame,
    catalogs: Sequence[str] = EXCLUDED_CATALOGS,
    schemas: Sequence[str] = EXCLUDED_SCHEMAS,
) -> DataFrame:
    """``listing`` without the given catalogs and schemas, by exact name."""
    return listing.filter(~F.col("catalog").isin(*catalogs) & ~F.col("schema").isin(*schemas))


def table_names(tables: DataFrame) -> DataFrame:
    """Qualified names of the tables that are not temporary."""
    name = qualified_name(F.col("catalog"), F.col("schema"), F.col("tableName"))
    return tables.filter(~F.col("isTemporary")).select(name.alias("TableName"))
