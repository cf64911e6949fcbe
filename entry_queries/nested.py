"""Fields inside structs, arrays and maps; rules by the table; groups inside groups."""

from __future__ import annotations

from pyspark.sql import functions as F

from colmask import classify_fields, classify_indexed, group_closure, has_grant, mask_plan, mask_table
from colmask.functions.sql import ACCESS_GROUP
from colmask.operators.audit import fields_exposure
from colmask.sources.inventory import columns_inventory
from entry_queries import derived as d
from entry_queries.derived import mask_sql, table

KEY = "a key for nested fields"
STRATEGIES = {"state": "hash", "lastname": "shape"}


def _found(spark, patients):
    """Matches, and the strategy by path."""
    matches = classify_fields(columns_inventory(spark, {"patients": patients}, nested=True))
    plan = mask_plan(matches, strategies=STRATEGIES).filter("status = 'pending'")
    # At most one entry per field of the schema.
    return matches, {r["ColumnName"]: r["strategy"] for r in plan.orderBy("ColumnName").collect()}


def mask_nested(spark, sf_dir):
    """Patients with the sensitive fields masked where they are, then laid out flat."""
    patients = d.nested_patients(spark, sf_dir)
    masked = mask_table(patients, _found(spark, patients)[1], key=KEY)
    return masked.selectExpr(
        "patient",
        "person.lastname AS lastname",
        "person.home.home_city AS home_city",
        "person.home.zip_code AS zip_code",
        "person.home.visits AS visits",
        "array_join(ssn_history, '|', '-') AS ssn_history",
        "array_join(transform(phones, p -> p.kind || ',' || p.number || ',' || p.row_id), '|') AS phones",
        "array_join(map_keys(license_by_state), '|') AS states",
        "array_join(map_values(license_by_state), '|', '-') AS licenses",
    )


def exposure_nested(spark, sf_dir):
    """The sensitive fields that a scan finds in patients, their values, and those a mask would leave as they are."""
    patients = d.nested_patients(spark, sf_dir)
    matches, strategies = _found(spark, patients)
    audit = fields_exposure("patients", patients, strategies).withColumn("ColumnName", F.lower("ColumnName"))
    return matches.select("TableName", "ColumnName", "PIICategory", "DataType").join(audit, ["TableName", "ColumnName"])


def classify_rules_indexed(spark, sf_dir):
    """Words of documents by rules from a table: every word of the benchmark items with four letters or more."""
    words = F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{4,}"), F.lit(0)))
    rules = (
        table(spark, sf_dir, "benchmark")
        .select("item_id", words.alias("keyword"))
        .groupBy("keyword")
        .agg(F.min("item_id").cast("int").alias("prio"))
        .select(
            "prio", "keyword", F.when(F.length("keyword") % 2 == 0, "edge").otherwise("contains").alias("mode"),
            (F.length("keyword") % 3 == 0).alias("string_only"),
        )
    )
    columns = table(spark, sf_dir, "documents").select(
        F.concat_ws(".", F.lit("corpus"), "lang", "source").alias("TableName"),
        F.posexplode(F.split("text", " ")).alias("Ordinal", "ColumnName"),
        F.when(F.col("lang") == "en", "string").otherwise("int").alias("DataType"),
    )
    return classify_indexed(columns, rules)


def _nested_grants(spark, sf_dir):
    """Suppliers in nations, nations in regions, regions in nations of their own number, two regions in the access group."""
    nation = F.concat(F.lit("nation_"), F.col("n_nationkey"))
    region = F.concat(F.lit("region_"), F.col("r_regionkey"))
    return (
        table(spark, sf_dir, "supplier")
        .select(F.col("s_name").alias("principal"), F.concat(F.lit("nation_"), F.col("s_nationkey")).alias("grp"))
        .unionByName(
            table(spark, sf_dir, "nation").select(
                nation.alias("principal"), F.concat(F.lit("region_"), F.col("n_regionkey")).alias("grp")
            )
        )
        .unionByName(
            table(spark, sf_dir, "region").select(region.alias("principal"), F.concat(F.lit("nation_"), F.col("r_regionkey")).alias("grp"))
        )
        .unionByName(
            table(spark, sf_dir, "region").filter("r_regionkey < 2").select(region.alias("principal"), F.lit(ACCESS_GROUP).alias("grp"))
        )
    )


def mask_by_nested_grant(spark, sf_dir):
    """Patients as three readers see them who are in the access group, if at all, through groups inside groups."""
    grants = _nested_grants(spark, sf_dir)
    closure = group_closure(grants)
    suppliers = table(spark, sf_dir, "supplier")
    people = d.subjects(spark, sf_dir).select("subject_id", "lastname", "dob")
    seen = None
    for region in (0, 3, 4):
        there = suppliers.join(table(spark, sf_dir, "nation").filter(F.col("n_regionkey") == region), suppliers.s_nationkey == F.col("n_nationkey"))
        reader = there.agg(F.min("s_name")).scalar()
        shown = mask_table(people, ["lastname", "dob"], authorized=has_grant(grants, principal=reader, closure=closure))
        shown = shown.withColumn("reader_region", F.lit(region))
        seen = shown if seen is None else seen.unionByName(shown)
    return seen


QUERIES = {
    "mask_nested": mask_nested,
    "exposure_nested": exposure_nested,
    "classify_rules_indexed": classify_rules_indexed,
    "mask_by_nested_grant": mask_by_nested_grant,
}


def _hashed(value):
    return f"sha256('{KEY}' || sha256('{KEY}' || {value}))"


_SHAPED = "regexp_replace(regexp_replace(regexp_replace(o_orderpriority, '[A-Z]', 'X', 'g'), '[a-z]', 'x', 'g'), '[0-9]', 'n', 'g')"
_CUST, _ORDER = mask_sql("o_custkey"), mask_sql("o_orderkey")
_PHONE, _KIND = mask_sql("100000 + o_custkey"), mask_sql("o_orderstatus")


def _counted(path, category, dtype, values, exposed):
    return (
        f"SELECT 'patients' AS TableName, '{path}' AS ColumnName, '{category}' AS PIICategory, '{dtype}' AS DataType, "
        f"CAST({values} AS BIGINT) AS n_values, CAST({exposed} AS BIGINT) AS n_exposed FROM orders"
    )


def _same(value):
    return f"count(*) FILTER (CAST({value} AS VARCHAR) = {mask_sql(value)})"


_PEOPLE = "count(*) FILTER (o_orderstatus <> 'P')"
ORACLES = {
    "mask_nested": f"""SELECT o_orderkey AS patient,
  CASE WHEN o_orderstatus <> 'P' THEN {_SHAPED} END AS lastname,
  CASE WHEN o_orderstatus <> 'P' THEN {_KIND} END AS home_city,
  CASE WHEN o_orderstatus <> 'P' THEN {mask_sql("10000 + o_custkey")} END AS zip_code,
  CASE WHEN o_orderstatus <> 'P' THEN 1 END AS visits,
  CASE WHEN o_custkey % 5 > 0 THEN {_CUST} || '|-|' || {_ORDER} END AS ssn_history,
  'w***,' || {_PHONE} || ',1|' || {_KIND} || ',' || {_ORDER} || ',2' AS phones,
  {_hashed("o_orderpriority")} || '|' || {_hashed("'none'")} AS states,
  {mask_sql("o_totalprice")} || '|-' AS licenses
FROM orders""",
    "exposure_nested": " UNION ALL ".join(
        [
            _counted("person.lastname", "lastname", "string", _PEOPLE, 0),
            _counted("person.home.home_city", "city", "string", _PEOPLE, _PEOPLE),
            _counted("person.home.zip_code", "zip", "int", _PEOPLE, 0),
            _counted(
                "ssn_history.element", "ssn", "string", "2 * count(*) FILTER (o_custkey % 5 > 0)",
                "count(*) FILTER (o_custkey % 5 > 0 AND o_custkey < 10) + count(*) FILTER (o_custkey % 5 > 0 AND o_orderkey < 10)",
            ),
            _counted("phones.element.kind", "phone", "string", "2 * count(*)", _same("o_orderstatus")),
            _counted("phones.element.number", "phone", "bigint", "2 * count(*)", f"{_same('100000 + o_custkey')} + {_same('o_orderkey')}"),
            _counted("license_by_state.key", "state", "string", "2 * count(*)", 0),
            _counted("license_by_state.value", "license", "double", "count(o_totalprice)", _same("o_totalprice")),
        ]
    ),
    "classify_rules_indexed": """WITH rules AS (
  SELECT keyword, min(item_id)::INTEGER AS prio
  FROM (SELECT item_id, unnest(regexp_extract_all(lower(text), '[a-z]{4,}')) AS keyword FROM benchmark) GROUP BY keyword),
words AS (
  SELECT DISTINCT lang, source, lower(unnest(string_split(text, ' '))) AS ColumnName FROM documents),
names AS (
  SELECT DISTINCT ColumnName, lang = 'en' AS is_text FROM words
  WHERE NOT (ends_with(ColumnName, 'id') OR ends_with(ColumnName, 'flag') OR ends_with(ColumnName, 'yn'))),
hits AS (
  SELECT ColumnName, is_text, arg_min(keyword, (prio, keyword)) AS PIICategory FROM names, rules
  WHERE CASE WHEN length(keyword) % 2 = 0 THEN starts_with(ColumnName, keyword) OR ends_with(ColumnName, keyword)
    ELSE contains(ColumnName, keyword) END AND (length(keyword) % 3 <> 0 OR is_text)
  GROUP BY ALL)
SELECT 'corpus.' || lang || '.' || source AS TableName, PIICategory, ColumnName,
  CASE WHEN lang = 'en' THEN 'string' ELSE 'int' END AS DataType, true AS EncryptFlag
FROM words JOIN hits USING (ColumnName) WHERE is_text = (lang = 'en')""",
    "mask_by_nested_grant": f"""WITH RECURSIVE {d.SUBJECTS},
grants AS (
  SELECT s_name AS principal, 'nation_' || s_nationkey AS grp FROM supplier
  UNION ALL SELECT 'nation_' || n_nationkey, 'region_' || n_regionkey FROM nation
  UNION ALL SELECT 'region_' || r_regionkey, 'nation_' || r_regionkey FROM region
  UNION ALL SELECT 'region_' || r_regionkey, '{ACCESS_GROUP}' FROM region WHERE r_regionkey < 2),
readers AS (
  SELECT n_regionkey::INTEGER AS reader_region, min(s_name) AS name FROM supplier JOIN nation ON s_nationkey = n_nationkey
  WHERE n_regionkey IN (0, 3, 4) GROUP BY ALL),
reach AS (
  SELECT reader_region, name AS grp FROM readers
  UNION SELECT reader_region, g.grp FROM reach JOIN grants g ON g.principal = reach.grp),
ok AS (SELECT reader_region, max(CASE WHEN grp = '{ACCESS_GROUP}' THEN 1 ELSE 0 END) = 1 AS ok FROM reach GROUP BY ALL)
SELECT subject_id, CASE WHEN ok THEN lastname ELSE {mask_sql("lastname")} END AS lastname,
  CASE WHEN ok THEN CAST(dob AS VARCHAR) ELSE {mask_sql("dob")} END AS dob, reader_region FROM subjects, ok""",
}
