"""Masks by type, by reader and by strategy."""

from __future__ import annotations

from pyspark.sql import functions as F

from colmask import Vault, has_grant, mask_expr, mask_table, register_mask_functions, tokenize
from colmask.functions.preserve import restore_expr
from colmask.functions.redact import MASK_FUNCTIONS
from colmask.functions.sql import ACCESS_GROUP
from colmask.session import work_folder
from colmask.sources.versions import StreamedCopy
from colmask.streaming.masked_stream import write_masked_stream, write_tokenized_stream
from entry_queries import derived as d
from entry_queries.derived import mask_sql, table

# The column of ``subjects`` that shows each type.
TYPE_COLUMNS = {
    "int": "zip_code",
    "bigint": "npi",
    "string": "ssn",
    "decimal": "medicare_amt",
    "double": "county_rate",
    "float": "race_score",
    "date": "dob",
    "timestamp": "doa",
    "boolean": "license_active",
}

HASH_KEY = "a key for the test tables"


def _by_type(dtype, column):
    def query(spark, sf_dir):
        masked = mask_expr(column, dtype).alias("masked")
        return d.subjects(spark, sf_dir).select("subject_id", masked)

    hidden = "'****'" if dtype == "boolean" else mask_sql(column)
    return query, f"WITH {d.SUBJECTS} SELECT subject_id, {hidden} AS masked FROM subjects"


def mask_authorized(spark, sf_dir):
    columns = ["subject_id", *TYPE_COLUMNS.values()]
    people = d.subjects(spark, sf_dir).select(*columns)
    return mask_table(people, list(TYPE_COLUMNS.values()), authorized=True)


def _grants(spark, sf_dir):
    """Suppliers as readers; those in the black are in the access group."""
    group = F.when(F.col("s_acctbal") > 0, ACCESS_GROUP).otherwise("public")
    return table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("principal"), group.alias("grp")
    )


def _by_reader(column):
    """The first supplier by name with, or without, money as the reader."""

    def query(spark, sf_dir):
        suppliers = table(spark, sf_dir, "supplier")
        rich = F.col("s_acctbal") > 0
        reader = suppliers.filter(rich if column == "granted" else ~rich)
        principal = reader.agg(F.min("s_name")).scalar()
        authorized = has_grant(_grants(spark, sf_dir), principal=principal)
        people = d.subjects(spark, sf_dir).select("subject_id", "lastname", "dob", "county_rate")
        return mask_table(people, ["lastname", "dob", "county_rate"], authorized=authorized)

    condition = "s_acctbal > 0" if column == "granted" else "NOT s_acctbal > 0"
    shown = ", ".join(
        f"CASE WHEN ok THEN CAST({c} AS VARCHAR) ELSE {mask_sql(c)} END AS {c}"
        for c in ("lastname", "dob", "county_rate")
    )
    sql = f"""WITH {d.SUBJECTS},
reader AS (SELECT min(s_name) AS name FROM supplier WHERE {condition}),
granted AS (SELECT count(*) > 0 AS ok FROM supplier, reader WHERE s_name = name AND s_acctbal > 0)
SELECT subject_id, {shown} FROM subjects, granted"""
    return query, sql


def mask_sql_functions(spark, sf_dir):
    """The nine SQL functions, called by a reader without a grant."""
    _grants(spark, sf_dir).createOrReplaceTempView("colmask_grants")
    register_mask_functions(spark, "colmask_grants")
    masked = [f"{MASK_FUNCTIONS[t]}({c}) AS {c}" for t, c in TYPE_COLUMNS.items()]
    return d.subjects(spark, sf_dir).selectExpr("subject_id", *masked)


def mask_full(spark, sf_dir):
    people = d.subjects(spark, sf_dir).select("subject_id", "lastname", "ssn", "npi")
    return mask_table(people, {"lastname": "full", "ssn": "full", "npi": "full"})


def mask_preserve(spark, sf_dir):
    """Names, dates and numbers of orders and customers in their own form, and taken back with the key."""
    people = d.tenants(spark, sf_dir, "c_name", "c_acctbal").withColumnRenamed("c_acctbal", "balance")
    masked = mask_table(people, {"c_name": "preserve", "balance": "preserve"}, key=HASH_KEY)
    return masked.withColumn("restored", restore_expr("c_name", f"'{HASH_KEY}'"))


def mask_hash(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return mask_table(orders, {"o_custkey": "hash", "o_totalprice": "hash"}, key=HASH_KEY)


def mask_shape(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return mask_table(documents, {"text": "shape"})


def mask_token(spark, sf_dir):
    """Part keys as tokens; the vault knows customer keys from an earlier run."""
    vault = Vault(spark, work_folder(spark, "vault"))
    vault.add(table(spark, sf_dir, "customer"), "c_custkey")
    vault.add(table(spark, sf_dir, "lineitem"), "l_partkey")
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_partkey"
    )
    return tokenize(lines, "l_partkey", vault.read())


MASK_TOKEN_SQL = """WITH first AS (
  SELECT value, row_number() OVER (ORDER BY md5(value), value) AS token
  FROM (SELECT DISTINCT CAST(c_custkey AS VARCHAR) AS value FROM customer)),
more AS (
  SELECT value, row_number() OVER (ORDER BY md5(value), value)
    + (SELECT max(token) FROM first) AS token
  FROM (SELECT DISTINCT CAST(l_partkey AS VARCHAR) AS value FROM lineitem)
  WHERE value NOT IN (SELECT value FROM first)),
vault AS (SELECT * FROM first UNION ALL SELECT * FROM more)
SELECT l_orderkey, l_linenumber, l_quantity, 'tok_' || CAST(token AS VARCHAR) AS l_partkey
FROM lineitem JOIN vault ON value = CAST(l_partkey AS VARCHAR)"""


def mask_token_skewed(spark, sf_dir):
    """Part and supplier keys of lines as tokens, a third of the lines with one part, another without."""
    part = F.when(F.col("l_linenumber") <= 2, F.lit(1)).when(F.col("l_linenumber") <= 4, F.col("l_partkey"))
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", part.cast("bigint").alias("l_partkey"), "l_suppkey"
    )
    vault = Vault(spark, work_folder(spark, "vault"))
    vault.add(lines, ["l_partkey", "l_suppkey"])
    return tokenize(lines, ["L_PartKey", "l_suppkey"], vault.read())


MASK_TOKEN_SKEWED_SQL = """WITH lines AS (
  SELECT l_orderkey, l_linenumber, l_suppkey,
    CASE WHEN l_linenumber <= 2 THEN 1 WHEN l_linenumber <= 4 THEN l_partkey END AS l_partkey FROM lineitem),
vault AS (
  SELECT value, 'tok_' || row_number() OVER (ORDER BY md5(value), value) AS token
  FROM (SELECT CAST(l_partkey AS VARCHAR) AS value FROM lines UNION SELECT CAST(l_suppkey AS VARCHAR) FROM lines)
  WHERE value IS NOT NULL)
SELECT l_orderkey, l_linenumber, p.token AS l_partkey, s.token AS l_suppkey
FROM lines LEFT JOIN vault p ON p.value = CAST(l_partkey AS VARCHAR) LEFT JOIN vault s ON s.value = CAST(l_suppkey AS VARCHAR)"""


def mask_by_category(spark, sf_dir):
    """Another strategy per kind of data: hashed numbers, shaped names, no text at all."""
    people = d.subjects(spark, sf_dir).select("subject_id", "lastname", "ssn", "home_city", "dob")
    columns = {"lastname": "shape", "ssn": "hash", "home_city": "full", "dob": "redact"}
    return mask_table(people, columns, key=HASH_KEY)


def mask_stream(spark, sf_dir):
    """Events through a stream that masks them, read back from its sink."""
    source = table(spark, sf_dir, "events")
    stream = (
        spark.readStream.schema(source.schema)
        .option("pathGlobFilter", "events.parquet")
        .parquet(sf_dir)
    )
    folder = work_folder(spark, "masked-stream")
    columns = ["user_id", "event_type", "value", "props"]
    write_masked_stream(stream, columns, f"{folder}/rows", f"{folder}/state").awaitTermination()
    return spark.read.schema(mask_table(source, columns).schema).parquet(f"{folder}/rows")


def mask_stream_token(spark, sf_dir):
    """Events through a stream that gives users tokens as they come, in two runs; read back from its copy."""
    events = table(spark, sf_dir, "events")
    root = work_folder(spark, "tokenized-stream")
    columns = {"user_id": "token", "value": "token", "props": "redact"}
    for part in (0, 1):
        events.filter(F.pmod("event_id", F.lit(2)) == part).write.mode("append").parquet(f"{root}/source")
        stream = spark.readStream.schema(events.schema).parquet(f"{root}/source")
        write_tokenized_stream(
            stream, columns, f"{root}/copy", f"{root}/state", Vault(spark, f"{root}/vault")
        ).awaitTermination()
    return StreamedCopy(spark, f"{root}/copy").read()


MASK_STREAM_TOKEN_SQL = f"""WITH held AS (
  SELECT event_id % 2 AS part, unnest([CAST(user_id AS VARCHAR), CAST(value AS VARCHAR)]) AS value FROM events),
first AS (
  SELECT value, row_number() OVER (ORDER BY md5(value), value) AS token
  FROM (SELECT DISTINCT value FROM held WHERE part = 0 AND value IS NOT NULL)),
more AS (
  SELECT value, row_number() OVER (ORDER BY md5(value), value) + (SELECT max(token) FROM first) AS token
  FROM (SELECT DISTINCT value FROM held WHERE part = 1 AND value IS NOT NULL AND value NOT IN (SELECT value FROM first))),
vault AS (SELECT value, 'tok_' || token AS token FROM first UNION ALL SELECT value, 'tok_' || token FROM more)
SELECT event_id, ts, u.token AS user_id, event_type, v.token AS value, {mask_sql("props")} AS props
FROM events LEFT JOIN vault u ON u.value = CAST(user_id AS VARCHAR) LEFT JOIN vault v ON v.value = CAST(events.value AS VARCHAR)"""


def _shape_sql(value):
    upper = rf"regexp_replace({value}, '\p{{Lu}}', 'X', 'g')"
    lower = rf"regexp_replace({upper}, '\p{{Ll}}', 'x', 'g')"
    return rf"regexp_replace({lower}, '\p{{Nd}}', 'n', 'g')"


def _preserved_sql(value):
    """The network round by round: position lists of the two halves, and the other half's digest."""
    key = HASH_KEY
    digest = (
        f"sha256('{key}' || sha256('{key}' || concat_ws('|', r, d, form, array_to_string(b, ''))))"
    )
    return f"""WITH RECURSIVE net AS (
  SELECT c_custkey, 0 AS r, list_filter(k, lambda c, i: i % 2 = 1) AS a, list_filter(k, lambda c, i: i % 2 = 0) AS b, form, parts
  FROM (SELECT c_custkey, regexp_extract_all(v, '[0-9A-Za-z]') AS k, string_split_regex(v, '[0-9A-Za-z]') AS parts,
    translate(v, '0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz', '{"n" * 10}{"X" * 26}{"x" * 26}') AS form
    FROM (SELECT c_custkey, {value} AS v FROM customer))
  UNION ALL
  SELECT c_custkey, r + 1, b, list_transform(a, lambda c, i: CASE
      WHEN c <= '9' THEN chr((48 + (ascii(c) - 48 + f[i]) % 10)::INTEGER)
      WHEN c <= 'Z' THEN chr((65 + (ascii(c) - 65 + f[i]) % 26)::INTEGER)
      ELSE chr((97 + (ascii(c) - 97 + f[i]) % 26)::INTEGER) END), form, parts
  FROM (SELECT *, list_transform(range(0, len(a)), lambda i:
      ('0x' || substr(h[(i // 8 + 1)::INTEGER], ((i % 8) * 8 + 1)::INTEGER, 8))::BIGINT) AS f
    FROM (SELECT *, list_transform(range(0, greatest(len(a) - 1, 0) // 8 + 1), lambda d: {digest}) AS h FROM net WHERE r < 10)))
SELECT c_custkey, array_to_string(list_transform(parts, lambda p, i: p || coalesce(
  CASE WHEN i % 2 = 1 THEN a[((i + 1) // 2)::INTEGER] ELSE b[(i // 2)::INTEGER] END, '')), '') AS masked FROM net WHERE r = 10"""


def _hash_sql(value):
    return f"sha256('{HASH_KEY}' || sha256('{HASH_KEY}' || {value}))"


QUERIES = {}
ORACLES = {}
for _dtype, _column in TYPE_COLUMNS.items():
    QUERIES[f"mask_{_dtype}"], ORACLES[f"mask_{_dtype}"] = _by_type(_dtype, _column)
QUERIES["mask_by_grant"], ORACLES["mask_by_grant"] = _by_reader("granted")
QUERIES["mask_by_grant_denied"], ORACLES["mask_by_grant_denied"] = _by_reader("denied")
QUERIES |= {
    "mask_authorized": mask_authorized,
    "mask_sql_functions": mask_sql_functions,
    "mask_full": mask_full,
    "mask_preserve": mask_preserve,
    "mask_hash": mask_hash,
    "mask_shape": mask_shape,
    "mask_token": mask_token,
    "mask_token_skewed": mask_token_skewed,
    "mask_by_category": mask_by_category,
    "mask_stream": mask_stream,
    "mask_stream_token": mask_stream_token,
}

_ALL = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in TYPE_COLUMNS.values())
_HIDDEN = ", ".join(
    f"{mask_sql(c)} AS {c}" if t != "boolean" else f"'****' AS {c}"
    for t, c in TYPE_COLUMNS.items()
)
ORACLES |= {
    "mask_authorized": f"WITH {d.SUBJECTS} SELECT subject_id, {_ALL} FROM subjects",
    "mask_sql_functions": f"WITH {d.SUBJECTS} SELECT subject_id, {_HIDDEN} FROM subjects",
    "mask_full": "SELECT c_custkey AS subject_id, '****' AS lastname, '****' AS ssn, '****' AS npi FROM customer",
    "mask_preserve": f"""SELECT c_custkey, n.masked AS c_name, b.masked AS balance, c_name AS restored FROM customer
JOIN ({_preserved_sql("c_name")}) AS n USING (c_custkey) JOIN ({_preserved_sql("CAST(c_acctbal AS VARCHAR)")}) AS b USING (c_custkey)""",
    "mask_hash": f"""SELECT o_orderkey, {_hash_sql('CAST(o_custkey AS VARCHAR)')} AS o_custkey,
{_hash_sql('CAST(o_totalprice AS VARCHAR)')} AS o_totalprice FROM orders""",
    "mask_shape": f"SELECT doc_id, {_shape_sql('text')} AS text FROM documents",
    "mask_token": MASK_TOKEN_SQL,
    "mask_token_skewed": MASK_TOKEN_SKEWED_SQL,
    "mask_by_category": f"""WITH {d.SUBJECTS} SELECT subject_id, {_shape_sql('lastname')} AS lastname,
{_hash_sql('ssn')} AS ssn, '****' AS home_city, {mask_sql('dob')} AS dob FROM subjects""",
    "mask_stream_token": MASK_STREAM_TOKEN_SQL,
    "mask_stream": "SELECT event_id, ts, "
    + ", ".join(f"{mask_sql(c)} AS {c}" for c in ("user_id", "event_type", "value", "props"))
    + " FROM events",
}
