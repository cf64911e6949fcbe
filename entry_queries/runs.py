"""Whole runs over the test tables, registered as external tables of a catalog."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colmask import (
    ControlTable,
    MaskedCopy,
    MaskRunError,
    Rule,
    apply_control,
    apply_views,
    classify_columns,
    discover_catalog,
    follow_control,
    mask_table,
)
from colmask.operators.audit import count_values, masked_count_by_table
from colmask.session import drop_folder, work_folder
from colmask.sources.ddl import write_definitions
from colmask.sources.inventory import exclude_namespaces, list_namespaces, stored_tables
from entry_queries.derived import TABLE_RULES, TABLES, mask_sql, table
from entry_queries.tables import FUNCTIONS, MASKED

SCHEMA = "colmask_tables"
PREFIX = f"spark_catalog.{SCHEMA}"
# Tables of the shorter queries; those named ..._all take every given table.
DISCOVERED = ("nation", "customer", "orders", "lineitem", "embeddings", "labels")


def register(spark, sf_dir, names=TABLES) -> None:
    """The given tables as external tables, and the schema without others."""
    spark.sql(f"DROP SCHEMA IF EXISTS {SCHEMA} CASCADE")
    spark.sql(f"CREATE SCHEMA {SCHEMA}")
    for name in names:
        path = f"{sf_dir}/{name}.parquet"
        spark.sql(f"CREATE TABLE {SCHEMA}.{name} USING parquet OPTIONS (path '{path}')")


def _namespaces(spark) -> DataFrame:
    return exclude_namespaces(list_namespaces(spark)).filter(F.col("schema") == SCHEMA)


def _discovered(spark, sf_dir, names) -> ControlTable:
    register(spark, sf_dir, names)
    control = ControlTable(spark, work_folder(spark, "control"))
    control.create()
    discover_catalog(spark, control, TABLE_RULES, names=stored_tables(spark, _namespaces(spark)))
    return control


def namespace_tables(spark, sf_dir, tables=DISCOVERED):
    """The schema's tables as the catalog lists them, with their numbers of rows."""
    register(spark, sf_dir, tables)
    rows = []
    for name in stored_tables(spark, _namespaces(spark)):
        n_rows = F.count(F.lit(1)).alias("n_rows")
        rows.append(spark.table(name).agg(n_rows).select(F.lit(name).alias("TableName"), "n_rows"))
    return reduce(DataFrame.unionByName, rows)


def namespace_tables_all(spark, sf_dir):
    """As ``namespace_tables``, of every given table."""
    return namespace_tables(spark, sf_dir, TABLES)


def discover_catalog_run(spark, sf_dir, tables=DISCOVERED):
    """Control rows after a scan of the catalog, with the values each column holds."""
    found = _discovered(spark, sf_dir, tables).read()
    columns: dict[str, list[str]] = {}
    for row in found.orderBy("TableName", "ColumnName").toLocalIterator():
        columns.setdefault(row["TableName"], []).append(row["ColumnName"])
    counts = [count_values(t, spark.table(t), c) for t, c in columns.items()]
    return found.join(reduce(DataFrame.unionByName, counts), ["TableName", "ColumnName"])


def discover_catalog_all(spark, sf_dir):
    """As ``discover_catalog_run``, of every given table."""
    return discover_catalog_run(spark, sf_dir, TABLES)


def catalog_scan_log(spark, sf_dir):
    """What a scan of all the session's catalogs logs, one of which cannot be loaded, with the tables' rows."""
    register(spark, sf_dir)
    spark.conf.set("spark.sql.catalog.unreachable", "no.such.Catalog")
    try:
        control = ControlTable(spark, work_folder(spark, "control"))
        log = discover_catalog(spark, control, TABLE_RULES)
    finally:
        spark.conf.unset("spark.sql.catalog.unreachable")
    ours = log.filter(F.col("unit").startswith(f"{PREFIX}.") | (F.col("unit") == "unreachable"))
    counts = [
        spark.table(f"{PREFIX}.{t}").agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(f"{PREFIX}.{t}").alias("unit"), "n_rows")
        for t in TABLES
    ]
    return ours.select("unit", "status", "n_columns").join(reduce(DataFrame.unionByName, counts), "unit", "left")


def _copies(name):
    def query(spark, sf_dir):
        """A table masked by a run over the control table, read back from its copy."""
        control = _discovered(spark, sf_dir, [name])
        root = work_folder(spark, "copies")
        apply_control(
            spark, control, lambda t, df: df.write.parquet(f"{root}/{t}"), f"{root}/logs", functions=FUNCTIONS
        )
        return spark.read.parquet(f"{root}/{PREFIX}.{name}")

    return query


def apply_copies_incremental(spark, sf_dir):
    """A masked copy of lineitem that followed its files: two parts came, one went, and one came later."""
    root = work_folder(spark, "followed")
    lines = table(spark, sf_dir, "lineitem")
    for part in range(2):
        lines.filter(F.pmod("l_orderkey", F.lit(3)) == part).write.parquet(f"{root}/source/part={part}")
    spark.sql(f"DROP SCHEMA IF EXISTS {SCHEMA} CASCADE")
    spark.sql(f"CREATE SCHEMA {SCHEMA}")
    spark.sql(f"CREATE TABLE {SCHEMA}.lineitem ({lines.schema.toDDL()}, part INT) USING parquet PARTITIONED BY (part) LOCATION '{root}/source'")
    spark.sql(f"MSCK REPAIR TABLE {SCHEMA}.lineitem")
    control = ControlTable(spark, f"{root}/control")
    control.create()
    discover_catalog(spark, control, TABLE_RULES, names=stored_tables(spark, _namespaces(spark)))

    def follow():
        follow_control(spark, control, lambda t: f"{root}/{t}", f"{root}/logs", functions=FUNCTIONS)

    follow()
    drop_folder(spark, f"{root}/source/part=0")
    lines.filter(F.pmod("l_orderkey", F.lit(3)) == 2).write.parquet(f"{root}/source/part=2")
    follow()
    return MaskedCopy(spark, f"{root}/{PREFIX}.lineitem").read()


def apply_views_orders(spark, sf_dir):
    """Orders through views that a run made: for a group the reader is in, and for one the reader is not in."""
    control = _discovered(spark, sf_dir, ["orders"])
    root = work_folder(spark, "grants")
    grants = table(spark, sf_dir, "supplier").select(
        F.when(F.col("s_acctbal") > 0, F.current_user()).otherwise(F.col("s_name")).alias("principal"),
        F.when(F.col("s_acctbal") > 0, "open").otherwise("closed").alias("grp"),
    )
    grants.write.parquet(f"{root}/grants")
    spark.sql(f"CREATE TABLE {SCHEMA}.grants USING parquet OPTIONS (path '{root}/grants')")
    seen = []
    for group in ("open", "closed"):
        apply_views(
            spark, control, lambda t: f"{t}_{group}", f"{PREFIX}.grants", f"{root}/logs-{group}",
            strategies={"price": "hash"}, functions=FUNCTIONS, group=group, key="(SELECT 'a key')",
        )
        shown = spark.table(f"{PREFIX}.orders_{group}").select("o_orderkey", "o_totalprice", "o_orderdate")
        seen.append(shown.select(F.lit(group).alias("reader_group"), "*"))
    return seen[0].unionByName(seen[1])


def definitions_run(spark, sf_dir, tables=DISCOVERED):
    """Definitions of catalog tables: how often each names its columns, and its masks."""
    register(spark, sf_dir, tables)
    names = stored_tables(spark, _namespaces(spark))
    ddl, log, _ = write_definitions(spark, names, work_folder(spark, "definitions"))
    rows = [
        spark.table(f"{PREFIX}.{t}").agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(f"{PREFIX}.{t}").alias("TableName"), "n_rows")
        for t in tables
    ]
    shown = ddl.select("TableName", F.startswith("ddl", F.lit("CREATE TABLE")).alias("is_definition"))
    return (
        shown.join(log.select(F.col("unit").alias("TableName"), "status"), "TableName")
        .join(masked_count_by_table(ddl), "TableName", "left")
        .join(reduce(DataFrame.unionByName, rows), "TableName")
        .fillna(0, ["n_masked"])
    )


def definitions_all(spark, sf_dir):
    """As ``definitions_run``, of every given table."""
    return definitions_run(spark, sf_dir, TABLES)


def apply_failures(spark, sf_dir):
    """What a strict run says of a column of an unsupported type, and of one that went after it was found.

    With the rows of the table whose other column was masked all the same.
    """
    register(spark, sf_dir, ["embeddings", "orders"])
    control = ControlTable(spark, work_folder(spark, "control"))
    control.create()
    rules = [*TABLE_RULES, Rule("embedding")]
    discover_catalog(spark, control, rules, names=stored_tables(spark, _namespaces(spark)))
    rest = table(spark, sf_dir, "orders").drop("o_orderdate").schema.toDDL()
    spark.sql(f"DROP TABLE {SCHEMA}.orders")
    spark.sql(f"CREATE TABLE {SCHEMA}.orders ({rest}) USING parquet OPTIONS (path '{sf_dir}/orders.parquet')")
    root = work_folder(spark, "failures")
    try:
        apply_control(spark, control, lambda t, df: df.write.parquet(f"{root}/{t}"), f"{root}/logs", functions=FUNCTIONS)
    except MaskRunError as error:
        written = spark.read.parquet(f"{root}/{PREFIX}.orders")
        counted = F.count(F.lit(1)).alias("n_written"), F.count_if(F.col("o_totalprice").endswith("*")).alias("n_masked")
        return spark.read.parquet(error.messages).crossJoin(written.agg(*counted))
    raise AssertionError("a strict run with failures must raise")


def mask_decimal_wide(spark, sf_dir):
    """A decimal of more digits than the SQL functions take."""
    wide = F.col("o_totalprice").cast("decimal(12,4)").alias("amount")
    return mask_table(table(spark, sf_dir, "orders").select("o_orderkey", wide), ["amount"])


def classify_rules_table(spark, sf_dir):
    """Words of documents by rules that come from a table: the first words of the benchmark items."""
    first = F.regexp_extract(F.lower("text"), "^([a-z]{2,4})", 1)
    rules = (
        table(spark, sf_dir, "benchmark")
        .select("item_id", first.alias("keyword"))
        .filter("keyword <> ''")
        .groupBy("keyword")
        .agg(F.min("item_id").cast("int").alias("prio"))
        .select(
            "prio", "keyword", F.when(F.col("prio") % 2 == 0, "edge").otherwise("contains").alias("mode"),
            (F.col("prio") % 3 == 0).alias("string_only"),
        )
    )
    columns = table(spark, sf_dir, "documents").select(
        F.concat_ws(".", F.lit("corpus"), "lang", "source").alias("TableName"),
        F.posexplode(F.split("text", " ")).alias("Ordinal", "ColumnName"),
        F.lit("string").alias("DataType"),
    )
    return classify_columns(columns, rules)


QUERIES = {
    "namespace_tables": namespace_tables,
    "namespace_tables_all": namespace_tables_all,
    "discover_catalog_run": discover_catalog_run,
    "discover_catalog_all": discover_catalog_all,
    "catalog_scan_log": catalog_scan_log,
    "apply_copies_orders": _copies("orders"),
    "apply_copies_lineitem": _copies("lineitem"),
    "apply_copies_incremental": apply_copies_incremental,
    "apply_views_orders": apply_views_orders,
    "definitions_run": definitions_run,
    "definitions_all": definitions_all,
    "apply_failures": apply_failures,
    "mask_decimal_wide": mask_decimal_wide,
    "classify_rules_table": classify_rules_table,
}

_COUNTS = " UNION ALL ".join(f"SELECT '{PREFIX}.{t}' AS TableName, count(*) AS n_rows FROM {t}" for t in DISCOVERED)
_FOUND = {t: MASKED[t][0] for t in ("nation", "customer", "orders", "lineitem")}
_RULE_OF = {
    "n_name": "name", "c_name": "name", "c_acctbal": "acctbal", "o_totalprice": "price", "o_orderdate": "date",
    "l_extendedprice": "price", "l_shipdate": "date",
}
_KIND_OF = {"name": "string", "acctbal": "double", "price": "double", "date": "timestamp_ntz"}
_VALUES = " UNION ALL ".join(
    f"SELECT '{PREFIX}.{t}' AS TableName, '{c}' AS ColumnName, '{_RULE_OF[c]}' AS PIICategory, "
    f"'{_KIND_OF[_RULE_OF[c]]}' AS DataType, true AS EncryptFlag, count({c}) AS n_values FROM {t}"
    for t, columns in _FOUND.items()
    for c in columns
)
_COUNTS_ALL = " UNION ALL ".join(f"SELECT '{PREFIX}.{t}' AS TableName, count(*) AS n_rows FROM {t}" for t in TABLES)
_RULE_OF_ALL = _RULE_OF | {
    "r_name": "name", "s_name": "name", "s_acctbal": "acctbal", "p_name": "name", "p_retailprice": "price",
    "text": "text", "url": "url",
}
_KIND_OF_ALL = _KIND_OF | {"text": "string", "url": "string"}
_VALUES_ALL = " UNION ALL ".join(
    f"SELECT '{PREFIX}.{t}' AS TableName, '{c}' AS ColumnName, '{_RULE_OF_ALL[c]}' AS PIICategory, "
    f"'{_KIND_OF_ALL[_RULE_OF_ALL[c]]}' AS DataType, true AS EncryptFlag, count({c}) AS n_values FROM {t}"
    for t, (columns, _) in MASKED.items()
    for c in columns
)
_HASHED = "sha256('a key' || sha256('a key' || CAST(o_totalprice AS VARCHAR)))"


def _masked(name):
    hidden, shown = MASKED[name]
    return "SELECT " + ", ".join([f"{mask_sql(c)} AS {c}" for c in hidden] + shown) + f" FROM {name}"


ORACLES = {
    "namespace_tables": _COUNTS,
    "discover_catalog_run": f"SELECT row_number() OVER (ORDER BY md5(TableName || chr(31) || ColumnName)) AS Id, * FROM ({_VALUES})",
    "namespace_tables_all": _COUNTS_ALL,
    "discover_catalog_all": f"SELECT row_number() OVER (ORDER BY md5(TableName || chr(31) || ColumnName)) AS Id, * FROM ({_VALUES_ALL})",
    "definitions_all": f"SELECT TableName, true AS is_definition, 'success' AS status, 0::BIGINT AS n_masked, n_rows FROM ({_COUNTS_ALL})",
    "catalog_scan_log": "SELECT 'unreachable' AS unit, 'failed' AS status, 0::BIGINT AS n_columns, NULL::BIGINT AS n_rows UNION ALL "
    + " UNION ALL ".join(
        f"SELECT '{PREFIX}.{t}', 'success', (SELECT count(*) FROM (DESCRIBE {t})), (SELECT count(*) FROM {t})" for t in TABLES
    ),
    "apply_copies_orders": _masked("orders"),
    "apply_copies_lineitem": _masked("lineitem"),
    "apply_copies_incremental": _masked("lineitem").replace(" FROM", ", (l_orderkey % 3)::INTEGER AS part FROM") + " WHERE l_orderkey % 3 <> 0",
    "apply_views_orders": "SELECT 'open' AS reader_group, o_orderkey, CAST(o_totalprice AS VARCHAR) AS o_totalprice, "
    "CAST(o_orderdate AS VARCHAR) AS o_orderdate FROM orders "
    f"UNION ALL SELECT 'closed', o_orderkey, {_HASHED}, {mask_sql('o_orderdate')} FROM orders",
    "definitions_run": f"SELECT TableName, true AS is_definition, 'success' AS status, 0::BIGINT AS n_masked, n_rows FROM ({_COUNTS})",
    "apply_failures": f"""SELECT kind, 0::BIGINT AS line, 1::BIGINT AS n_columns, message, n_written, n_masked
FROM (VALUES ('Unsupported data type(s) encountered for', '{PREFIX}.embeddings.embedding'),
  ('Failed for other reasons', '{PREFIX}.orders.o_orderdate')) AS v(kind, message),
  (SELECT count(*) AS n_written, count(*) FILTER (WHERE length(CAST(o_totalprice AS VARCHAR)) > 1) AS n_masked FROM orders)""",
    "mask_decimal_wide": f"SELECT o_orderkey, {mask_sql('CAST(o_totalprice AS DECIMAL(12,4))')} AS amount FROM orders",
    "classify_rules_table": """WITH rules AS (
  SELECT keyword, min(item_id)::INTEGER AS prio
  FROM (SELECT item_id, regexp_extract(lower(text), '^([a-z]{2,4})', 1) AS keyword FROM benchmark)
  WHERE keyword <> '' GROUP BY keyword),
words AS (
  SELECT DISTINCT 'corpus.' || lang || '.' || source AS TableName, lower(unnest(string_split(text, ' '))) AS ColumnName
  FROM documents),
hits AS (
  SELECT TableName, ColumnName, arg_min(keyword, prio) AS PIICategory FROM words, rules
  WHERE CASE WHEN prio % 2 = 0 THEN starts_with(ColumnName, keyword) OR ends_with(ColumnName, keyword)
    ELSE contains(ColumnName, keyword) END
    AND NOT (ends_with(ColumnName, 'id') OR ends_with(ColumnName, 'flag') OR ends_with(ColumnName, 'yn'))
  GROUP BY ALL)
SELECT TableName, PIICategory, ColumnName, 'string' AS DataType, true AS EncryptFlag FROM hits""",
}
