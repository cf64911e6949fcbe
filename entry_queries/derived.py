"""Relations that Spark derives from the test tables, and the same in SQL.

The control operators work on catalogs of many tables. Here every customer
stands for a tenant with an own set of tables, and every order for an entry
of a table listing, so these relations grow with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colmask.operators.rules import Rule, default_rules

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

# A patient table with names that hit and miss every rule.
PATIENT_COLUMNS = (
    ("FirstName", "string"), ("first_name", "string"), ("DOB", "date"), ("ssn", "string"),
    ("is_ssn_verified_flag", "boolean"), ("medicaid", "string"), ("medicaid_number", "string"),
    ("telephone", "string"), ("faxphone", "string"), ("email", "string"),
    ("email_verified", "boolean"), ("email_address", "string"), ("home_city", "string"),
    ("velocity", "string"), ("facility", "string"), ("city_code", "int"), ("state", "string"),
    ("statement", "string"), ("state_code", "int"), ("real_estate_tax", "string"),
    ("fax", "string"), ("fax_count", "int"), ("office_fax_no", "string"), ("zip_code", "int"),
    ("trace_ts", "timestamp"), ("doa", "timestamp_ntz"), ("npi", "bigint"), ("npi_id", "bigint"),
    ("license_yn", "string"), ("street_address", "string"), ("mail_state", "string"),
    ("mail_state_x", "string"), ("city_state", "string"), ("gross_charges", "decimal(12,4)"),
    ("ssn_history", "array<string>"),
)

# Rules that match columns of the test tables; the default keywords match none.
TABLE_RULES = [Rule(word) for word in ("name", "acctbal", "price", "date", "text", "url")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as people, with all nine maskable types."""
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS subject_id",
        "c_name AS lastname",
        "lpad(CAST(c_custkey AS STRING), 9, '0') AS ssn",
        "c_mktsegment AS home_city",
        "CAST(10000 + c_nationkey AS INT) AS zip_code",
        "CAST(1000000000 + c_custkey AS BIGINT) AS npi",
        "c_acctbal AS county_rate",
        "CAST(c_acctbal AS FLOAT) AS race_score",
        "CAST(c_acctbal AS DECIMAL(10,2)) AS medicare_amt",
        "date_add(DATE'1940-01-01', CAST(c_custkey % 20000 AS INT)) AS dob",
        "timestampadd(SECOND, CAST(c_custkey AS BIGINT) * 3601, TIMESTAMP'2020-01-01 00:00:00') AS doa",
        "c_acctbal > 0 AS license_active",
        "c_nationkey = 3 AS ssn_flag",
    )


SUBJECTS = """subjects AS (
  SELECT c_custkey AS subject_id, c_name AS lastname,
    lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS ssn, c_mktsegment AS home_city,
    CAST(10000 + c_nationkey AS INTEGER) AS zip_code,
    CAST(1000000000 + c_custkey AS BIGINT) AS npi, c_acctbal AS county_rate,
    CAST(c_acctbal AS FLOAT) AS race_score,
    CAST(c_acctbal AS DECIMAL(10,2)) AS medicare_amt,
    DATE '1940-01-01' + CAST(c_custkey % 20000 AS INTEGER) AS dob,
    TIMESTAMP '2020-01-01 00:00:00' + to_seconds(CAST(c_custkey AS BIGINT) * 3601) AS doa,
    c_acctbal > 0 AS license_active, c_nationkey = 3 AS ssn_flag
  FROM customer)"""


def tenants(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Columns of the customers, dealt out by key, for steps that do much with every row.

    A file of customers may be a single row group, which one task reads however many customers it holds.
    """
    customers = table(spark, sf_dir, "customer").select("c_custkey", *columns)
    return customers.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "c_custkey")


def tenant_table(key: str = "c_custkey", segment: str = "c_mktsegment"):
    return F.concat(
        F.lit("clinic."), F.lower(segment), F.lit(".patients_"), F.col(key).cast("string")
    )


TENANT = "'clinic.' || lower(c_mktsegment) || '.patients_' || CAST(c_custkey AS VARCHAR)"


def patient_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inventory in which every customer has one patient table."""
    columns = F.array(
        *[
            F.struct(
                F.lit(i).alias("Ordinal"), F.lit(n).alias("ColumnName"), F.lit(t).alias("DataType")
            )
            for i, (n, t) in enumerate(PATIENT_COLUMNS)
        ]
    )
    return tenants(spark, sf_dir, "c_mktsegment").select(tenant_table().alias("TableName"), F.inline(columns))


PATIENTS = (
    "columns AS (\n  SELECT "
    + TENANT
    + " AS TableName, c.Ordinal, c.ColumnName, c.DataType\n  FROM customer, (VALUES "
    + ", ".join(f"({i}, '{n}', '{t}')" for i, (n, t) in enumerate(PATIENT_COLUMNS))
    + ") c(Ordinal, ColumnName, DataType))"
)


def rules_sql(rules: list[Rule]) -> str:
    rows = ", ".join(
        f"({i}, '{r.keyword}', '{r.mode}', {str(r.string_only).lower()})"
        for i, r in enumerate(rules)
    )
    return f"rules(prio, keyword, mode, string_only) AS (VALUES {rows})"


def candidates_sql(rules: list[Rule]) -> str:
    """CTEs: every pair of a column and a rule that its name and type satisfy."""
    return rules_sql(rules) + """,
lowered AS (
  SELECT DISTINCT TableName, Ordinal, lower(ColumnName) AS ColumnName, lower(DataType) AS DataType
  FROM columns),
candidates AS (
  SELECT l.*, r.prio, r.keyword,
    ends_with(ColumnName, 'id') OR ends_with(ColumnName, 'flag') OR ends_with(ColumnName, 'yn')
      AS excluded
  FROM lowered l JOIN rules r ON contains(ColumnName, keyword)
    AND (mode = 'contains' OR starts_with(ColumnName, keyword) OR ends_with(ColumnName, keyword))
    AND (NOT string_only OR DataType = 'string'))"""


def matches_sql(rules: list[Rule], excluded: bool = False) -> str:
    """CTEs ending in ``matches``, over a CTE ``columns``."""
    return candidates_sql(rules) + f""",
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY TableName, ColumnName ORDER BY prio, Ordinal) AS rn
  FROM candidates WHERE {'' if excluded else 'NOT '}excluded),
matches AS (
  SELECT TableName, keyword AS PIICategory, ColumnName, DataType, true AS EncryptFlag
  FROM ranked WHERE rn = 1)"""


DEFAULT_MATCHES = PATIENTS + ",\n" + matches_sql(default_rules())


def control(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Control rows of an earlier run: two per tenant, some switched off by a steward."""
    entries = F.array(
        F.struct(
            (F.col("c_custkey") * 2 + 1).alias("Id"),
            F.lit("ssn").alias("PIICategory"),
            F.lit("ssn").alias("ColumnName"),
            F.lit("int").alias("DataType"),
            F.when(F.col("c_nationkey") == 0, F.lit(None).cast("boolean"))
            .otherwise(F.col("c_acctbal") >= 0)
            .alias("EncryptFlag"),
        ),
        F.struct(
            (F.col("c_custkey") * 2 + 2).alias("Id"),
            F.lit("zip").alias("PIICategory"),
            F.lit("gone").alias("ColumnName"),
            F.lit("int").alias("DataType"),
            F.lit(True).alias("EncryptFlag"),
        ),
    )
    customers = tenants(spark, sf_dir, "c_mktsegment", "c_nationkey", "c_acctbal")
    rows = customers.select(tenant_table().alias("TableName"), F.inline(entries))
    return rows.select("Id", "TableName", "PIICategory", "ColumnName", "DataType", "EncryptFlag")


CONTROL = f"""control AS (
  SELECT c_custkey * 2 + 1 AS Id, {TENANT} AS TableName, 'ssn' AS PIICategory,
    'ssn' AS ColumnName, 'int' AS DataType,
    CASE WHEN c_nationkey = 0 THEN NULL ELSE c_acctbal >= 0 END AS EncryptFlag
  FROM customer
  UNION ALL
  SELECT c_custkey * 2 + 2, {TENANT}, 'zip', 'gone', 'int', true FROM customer)"""


def merged_sql(flag: str) -> str:
    """CTE ``merged``: control with matches upserted; ``flag`` is an expression on o and n."""
    return f"""fresh AS (
  SELECT m.*, row_number() OVER (
      ORDER BY md5(TableName || chr(31) || ColumnName), TableName, ColumnName)
    + (SELECT coalesce(max(Id), 0) FROM control) AS Id
  FROM matches m WHERE NOT EXISTS (SELECT 1 FROM control c
    WHERE lower(c.TableName) = lower(m.TableName) AND lower(c.ColumnName) = lower(m.ColumnName))),
merged AS (
  SELECT coalesce(o.Id, f.Id) AS Id, coalesce(o.TableName, n.TableName) AS TableName,
    coalesce(n.PIICategory, o.PIICategory) AS PIICategory,
    coalesce(o.ColumnName, n.ColumnName) AS ColumnName,
    coalesce(n.DataType, o.DataType) AS DataType,
    {flag} AS EncryptFlag
  FROM control o
  FULL OUTER JOIN matches n ON lower(o.TableName) = lower(n.TableName)
    AND lower(o.ColumnName) = lower(n.ColumnName)
  LEFT JOIN fresh f ON f.TableName = n.TableName AND f.ColumnName = n.ColumnName)"""


# A steward's unset flag stays unset, so the old row decides wherever there is one.
KEEP_FLAG = "CASE WHEN o.Id IS NULL THEN n.EncryptFlag ELSE o.EncryptFlag END"
OVERWRITE_FLAG = "coalesce(n.EncryptFlag, o.EncryptFlag)"


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Table listing with one entry per order, six catalogs and three schemas."""
    priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    return table(spark, sf_dir, "orders").select(
        F.when((priority == "1-URGENT") & (F.col("o_totalprice") > 400000), "__clinical")
        .when(priority == "1-URGENT", "main")
        .when(priority == "2-HIGH", "system")
        .when(priority == "3-MEDIUM", "samples")
        .when(priority == "4-NOT SPECIFIED", "hive_metastore")
        .otherwise("dev")
        .alias("catalog"),
        F.when(status == "F", "clinic").when(status == "O", "default").otherwise("test").alias("schema"),
        F.concat(F.lit("order_"), F.col("o_orderkey").cast("string")).alias("tableName"),
        (F.col("o_totalprice") < 50000).alias("isTemporary"),
    )


LISTING = """listing AS (
  SELECT CASE o_orderpriority WHEN '1-URGENT' THEN
      CASE WHEN o_totalprice > 400000 THEN '__clinical' ELSE 'main' END WHEN '2-HIGH' THEN 'system'
      WHEN '3-MEDIUM' THEN 'samples' WHEN '4-NOT SPECIFIED' THEN 'hive_metastore'
      ELSE 'dev' END AS catalog,
    CASE o_orderstatus WHEN 'F' THEN 'clinic' WHEN 'O' THEN 'default' ELSE 'test' END AS schema,
    'order_' || CAST(o_orderkey AS VARCHAR) AS tableName,
    o_totalprice < 50000 AS isTemporary
  FROM orders)"""

_DDL_HEAD = "CREATE TABLE "
_DDL_SSN = " (\n  id BIGINT,\n  `ssn` STRING"
_DDL_MASK = " MASK clinic.fn.string_mask"
_DDL_GONE = ",\n  gone INT MASK clinic.fn.int_mask"
_DDL_REST = (
    ",\n  `home_city` STRING MASK clinic.fn.string_mask"
    ",\n  `full name` STRING MASK clinic.fn.string_mask"
    ",\n  note STRING COMMENT 'MASK me',\n  MASKED_AT DATE)\nUSING parquet"
)


def ddl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table definition per tenant; those in the black already mask ssn, the rich also gone."""
    name = tenant_table()
    mask = F.when(F.col("c_acctbal") > 0, _DDL_MASK).otherwise("")
    gone = F.when(F.col("c_acctbal") > 5000, _DDL_GONE).otherwise("")
    text = F.concat(F.lit(_DDL_HEAD), name, F.lit(_DDL_SSN), mask, gone, F.lit(_DDL_REST))
    return tenants(spark, sf_dir, "c_mktsegment", "c_acctbal").select(name.alias("TableName"), text.alias("ddl"))


def _sql_text(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


DDL = f"""ddl AS (
  SELECT {TENANT} AS TableName,
    {_sql_text(_DDL_HEAD)} || {TENANT} || {_sql_text(_DDL_SSN)}
    || CASE WHEN c_acctbal > 0 THEN {_sql_text(_DDL_MASK)} ELSE '' END
    || CASE WHEN c_acctbal > 5000 THEN {_sql_text(_DDL_GONE)} ELSE '' END
    || {_sql_text(_DDL_REST)} AS ddl
  FROM customer),
lines AS (SELECT TableName, unnest(string_split(ddl, chr(10))) AS line FROM ddl)"""

LOOSE_COLUMNS = r"""applied AS (
  SELECT DISTINCT TableName,
    replace(regexp_extract(line, '^\s*(\S+)', 1), '`', '') AS ColumnName
  FROM lines WHERE contains(line, 'MASK'))"""

STRICT_COLUMNS = r"""applied AS (
  SELECT DISTINCT TableName, trim(regexp_extract(
      line, '^\s*(`[^`]+`|\w+)\s+[A-Z]+\s+MASK\s', 1), '`') AS ColumnName
  FROM lines WHERE regexp_matches(line, '^\s*(`[^`]+`|\w+)\s+[A-Z]+\s+MASK\s'))"""


def dead_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tenants without a finished urgent order: their tables are gone."""
    active = table(spark, sf_dir, "orders").filter(
        (F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "1-URGENT")
    )
    active = active.select(F.col("o_custkey").alias("c_custkey")).distinct()
    gone = table(spark, sf_dir, "customer").join(active, "c_custkey", "left_anti")
    return gone.select(tenant_table().alias("TableName"))


DEAD = f"""dead AS (
  SELECT {TENANT} AS TableName FROM customer
  WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey
    AND o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'))"""


def mask_sql(value: str) -> str:
    text = f"CAST({value} AS VARCHAR)"
    return f"left({text}, 1) || repeat('*', greatest(length({text}) - 1, 0))"


def nested_patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as patients whose data stand inside structs, arrays and maps, some of them null."""
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS patient",
        "CASE WHEN o_orderstatus <> 'P' THEN named_struct('lastname', o_orderpriority, 'home', "
        "named_struct('home_city', o_orderstatus, 'zip_code', CAST(10000 + o_custkey AS INT), 'visits', 1)) END AS person",
        "CASE WHEN o_custkey % 5 > 0 THEN array(CAST(o_custkey AS STRING), NULL, CAST(o_orderkey AS STRING)) END AS ssn_history",
        "array(named_struct('kind', 'work', 'number', 100000 + o_custkey, 'row_id', 1), "
        "named_struct('kind', o_orderstatus, 'number', o_orderkey, 'row_id', 2)) AS phones",
        "map(o_orderpriority, o_totalprice, 'none', NULL) AS license_by_state",
    )
