"""Whole runs over catalog tables."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__
from colmask import (
    ControlTable,
    MaskRunError,
    Vault,
    apply_control,
    apply_views,
    create_masked_view,
    discover_catalog,
    discover_table,
    has_grant,
    mask_all,
    mask_plan,
    masked_columns_from_ddl,
    pending_columns,
    prune_control,
    register_mask_functions,
    mask_table,
)
from colmask.functions.redact import MASK_FUNCTIONS
from colmask.functions.names import qualified_name, quote_table
from colmask.operators.audit import exposure_audit, log_from_columns, run_summary
from colmask.plans import mask as mask_module
from colmask.plans.mask import applied_columns
from colmask.session import drop_work_folders, work_folder, work_root
from colmask.schemas import APPLIED, CONTROL, GRANTS, NAMESPACES, TABLES
from colmask.sources.ddl import write_definitions
from colmask.sources.inventory import (
    exclude_namespaces,
    catalog_tables,
    configured_catalogs,
    list_namespaces,
    list_tables,
    scan_tables,
    stored_tables,
    table_names,
)
from tests.conftest import rows
from entry_queries.derived import TABLES as GIVEN
from entry_queries.tables import MASKED

PATIENTS = "spark_catalog.clinic.patients"
VISITS = "spark_catalog.clinic.visits"


@pytest.fixture(scope="module")
def clinic(spark):
    spark.sql("CREATE SCHEMA IF NOT EXISTS clinic")
    spark.sql("CREATE SCHEMA IF NOT EXISTS test")
    spark.sql(
        "CREATE OR REPLACE TEMPORARY VIEW patient_rows AS SELECT * FROM VALUES "
        "(1, 'Smith', '123-45-6789', DATE'1980-02-03', array('a'), true), "
        "(2, 'Li', NULL, NULL, NULL, false) "
        "AS t(patient_id, LastName, ssn, dob, ssn_history, is_ssn_flag)"
    )
    spark.table("patient_rows").write.mode("overwrite").saveAsTable("clinic.patients")
    spark.sql("SELECT 1 AS visit_id, 'Main St' AS street, 5 AS n").write.mode("overwrite").saveAsTable(
        "clinic.visits"
    )
    spark.sql("SELECT 'x' AS ssn").write.mode("overwrite").saveAsTable("test.hidden")
    return "clinic"


def test_listing(spark, clinic):
    namespaces = list_namespaces(spark)
    assert ("spark_catalog", "clinic") in rows(namespaces)
    kept = exclude_namespaces(namespaces)
    assert not {"default", "test"} & {r["schema"] for r in kept.collect()}
    tables = list_tables(spark, "spark_catalog", "clinic")
    assert tables.filter("isTemporary").count() >= 1
    assert rows(table_names(tables)) == [(PATIENTS,), (VISITS,)]


@pytest.fixture
def broken_catalogs(spark):
    names = ("broken", "system", "other")
    for name in names:
        spark.conf.set(f"spark.sql.catalog.{name}", "no.such.Catalog")
    spark.conf.set("spark.sql.catalog.broken.url", "x")
    yield
    spark.conf.unset("spark.sql.catalog.broken.url")
    for name in names:
        spark.conf.unset(f"spark.sql.catalog.{name}")


def test_a_catalog_that_fails_stops_nothing(spark, clinic, broken_catalogs, tmp_path):
    assert {"broken", "other", "spark_catalog", "system"} <= set(configured_catalogs(spark))
    assert "broken.url" not in configured_catalogs(spark)
    control = ControlTable(spark, str(tmp_path / "control"))
    log = discover_catalog(spark, control)
    assert rows(log, "unit", "status") == [
        ("broken", "failed"), ("other", "failed"), (PATIENTS, "success"), (VISITS, "success"),
    ]
    assert all("no.such.Catalog" in r["error"] for r in log.filter("status = 'failed'").collect())
    assert rows(control.read().select("TableName").distinct()) == [(PATIENTS,), (VISITS,)]
    assert {r["catalog"] for r in list_namespaces(spark).collect()} == {"spark_catalog"}


def test_a_catalog_that_fails_half_way(spark, clinic, monkeypatch):
    """Other catalogs are scanned as the first is, and what was listed before a failure counts."""
    def listed(session, catalogs=None):
        yield "one", None, "no access"
        yield "spark_catalog", "clinic", None
        yield "spark_catalog", "no_such_schema", None
        yield "spark_catalog", None, "gone"

    monkeypatch.setattr("colmask.sources.inventory.namespace_rows", listed)
    found = list(catalog_tables(spark))
    assert found[0] == ("one", "no access") and found[1:3] == [PATIENTS, VISITS]
    assert found[3][0] == "spark_catalog.no_such_schema" and found[4] == ("spark_catalog", "gone")


def test_exclusions(spark):
    data = [
        ("main", "clinic", "patients", False), ("main", "clinic", "tmp_x", True),
        ("main", "default", "a", False), ("system", "access", "b", False),
        ("samples", "tpch", "c", False), ("hive_metastore", "old", "d", False),
        ("dev", "test", "e", False), ("__clinical", "clinic", "f", False), ("sys.x", "a`b", "c-d", False),
    ]
    listing = spark.createDataFrame(data, TABLES)
    kept = exclude_namespaces(listing)
    assert rows(table_names(kept)) == [("__clinical.clinic.f",), ("`sys.x`.`a``b`.c-d",), ("main.clinic.patients",)]
    assert exclude_namespaces(listing, catalogs=["__clinical", "sys.x"]).filter("catalog LIKE '\\_\\_%'").count() == 0
    assert exclude_namespaces(spark.createDataFrame([], NAMESPACES)).count() == 0


def test_a_table_that_fails_stops_nothing(spark, clinic):
    batches = list(scan_tables(spark, [PATIENTS, "clinic.nowhere", VISITS], batch=2))
    assert len(batches) == 2
    log = batches[0][1].union(batches[1][1])
    assert rows(log, "unit", "status", "n_columns") == [
        ("clinic.nowhere", "failed", 0), (PATIENTS, "success", 6), (VISITS, "success", 3),
    ]
    assert rows(run_summary(log)) == [(2, 0, 1, 3, 9)]


def test_from_discovery_to_masked_copies(spark, clinic, tmp_path):
    control = ControlTable(spark, str(tmp_path / "control"))
    log = discover_catalog(spark, control)
    assert rows(log, "unit", "status") == [(PATIENTS, "success"), (VISITS, "success")]
    assert rows(control.read(), "TableName", "ColumnName") == [
        (PATIENTS, "dob"), (PATIENTS, "lastname"), (PATIENTS, "ssn"), (PATIENTS, "ssn_history"),
        (VISITS, "street"),
    ]

    nothing = spark.createDataFrame([], APPLIED)
    plan = mask_plan(pending_columns(control.flagged(), nothing))

    def read(name):
        return spark.table(name)

    def write(name, df):
        df.write.mode("overwrite").parquet(f"{tmp_path}/masked/{name}")

    with pytest.raises(MaskRunError, match="1 column.* 0 other") as raised:
        mask_all(spark, plan, read, write, f"{tmp_path}/log")
    log = raised.value.log
    assert rows(spark.read.parquet(raised.value.messages), "message") == [(f"{PATIENTS}.ssn_history",)]
    assert rows(log.filter("status = 'success'"), "ColumnName") == [
        ("dob",), ("lastname",), ("ssn",), ("street",),
    ]
    copy = spark.read.parquet(f"{tmp_path}/masked/{PATIENTS}")
    assert rows(copy, "patient_id", "LastName", "ssn", "dob") == [
        (1, "S****", "1**********", "1*********"), (2, "L*", None, None),
    ]
    assert rows(log_from_columns(log), "unit", "status", "n_columns") == [
        (PATIENTS, "failed", 3), (VISITS, "success", 1),
    ]
    assert "ssn_history" not in copy.columns
    left = pending_columns(control.flagged(), applied_columns(log))
    assert rows(left, "ColumnName") == [("ssn_history",)]
    mask_all(spark, plan, read, write, f"{tmp_path}/kept", strict=False, keep_unsupported=True)
    copy = spark.read.parquet(f"{tmp_path}/masked/{PATIENTS}")
    assert rows(copy, "patient_id", "ssn_history") == [(1, ["a"]), (2, None)]

    steward = control.read().withColumn(
        "EncryptFlag", F.col("EncryptFlag") & (F.col("ColumnName") != "ssn_history")
    )
    control.write(steward)
    discover_catalog(spark, control)
    assert pending_columns(control.flagged(), applied_columns(log)).count() == 0


def test_repeated_runs_mask_what_is_new_and_keep_what_was(spark, clinic, tmp_path):
    control = ControlTable(spark, str(tmp_path / "control"))
    control.replace(
        spark.createDataFrame(
            [(0, PATIENTS, "ssn", "ssn", "string", True), (0, PATIENTS, "dob", "dob", "date", False),
             (0, VISITS, "street", "street", "string", True),
             (0, "spark_catalog.clinic.nowhere", "x", "x", "int", True)],
            CONTROL,
        )
    )
    written = []

    def write(name, df):
        written.append(name)
        df.write.mode("overwrite").parquet(f"{tmp_path}/copies/{name}")

    def run():
        written.clear()
        vault = Vault(spark, f"{tmp_path}/vault")
        apply_control(spark, control, write, f"{tmp_path}/logs", {"street": "token"}, vault=vault)
        return sorted(written)

    assert run() == [PATIENTS, VISITS]
    assert rows(control.read(), "TableName").count(("spark_catalog.clinic.nowhere",)) == 0
    assert rows(spark.read.parquet(f"{tmp_path}/copies/{VISITS}"), "street") == [("tok_1",)]
    assert run() == []
    control.write(control.read().withColumn("EncryptFlag", F.lit(True)))
    assert run() == [PATIENTS]
    copy = spark.read.parquet(f"{tmp_path}/copies/{PATIENTS}")
    assert rows(copy, "patient_id", "ssn", "dob") == [
        (1, "1**********", "1*********"), (2, None, None),
    ]
    assert run() == []


def test_other_failures_are_logged_and_raised_last(spark, clinic, tmp_path):
    control = spark.createDataFrame(
        [("clinic.nowhere", "x", "ssn", "string", True), (PATIENTS, "x", "ssn", "string", True),
         (PATIENTS, "x", "dropped", "string", True), (VISITS, "x", "street", "string", True)],
        "TableName string, PIICategory string, ColumnName string, DataType string, EncryptFlag boolean",
    )
    plan = mask_plan(control)

    def write(name, df):
        if name == VISITS:
            raise OSError("no space")
        df.write.mode("overwrite").parquet(f"{tmp_path}/{name}")

    log = mask_all(spark, plan, spark.table, write, f"{tmp_path}/log", strict=False, batch=1)
    assert rows(log, "TableName", "ColumnName", "status") == [
        ("clinic.nowhere", "ssn", "failed"), (PATIENTS, "dropped", "failed"),
        (PATIENTS, "ssn", "success"), (VISITS, "street", "failed"),
    ]
    with pytest.raises(MaskRunError, match="0 column.* 3 other"):
        mask_all(spark, plan, spark.table, write, f"{tmp_path}/log2")


@pytest.mark.parametrize("n", [1, 10_001])
def test_failures_are_listed_in_one_way_however_many(spark, tmp_path, n):
    log = spark.range(n).selectExpr(
        "'t' AS TableName", "concat('c', id) AS ColumnName", "'failed' AS status", "'Unsupported data type: x' AS error"
    )
    other = spark.createDataFrame([("t", "b", "failed", "boom"), ("t", "ok", "success", None)], "TableName string, ColumnName string, status string, error string")
    with pytest.raises(MaskRunError, match=f"^{n} column.* 1 other failure.* listed in {tmp_path}/messages-log") as raised:
        mask_module.raise_failures(log.union(other), f"{tmp_path}/log")
    lists = spark.read.parquet(raised.value.messages)
    assert rows(lists.groupBy("kind").agg(F.sum("n_columns"))) == [
        ("Failed for other reasons", 1), ("Unsupported data type(s) encountered for", n),
    ]
    assert lists.agg(F.max("n_columns")).first()[0] <= 100


def test_definitions_and_dead_tables(spark, clinic, tmp_path):
    names = [PATIENTS, "spark_catalog.clinic.nowhere"]
    ddl, log, gone = write_definitions(spark, names, str(tmp_path), batch=1)
    assert rows(ddl, "TableName") == [(PATIENTS,)]
    assert "CREATE TABLE" in ddl.first()["ddl"]
    assert masked_columns_from_ddl(ddl).count() == 0
    assert rows(log, "unit", "status") == [
        ("spark_catalog.clinic.nowhere", "skipped"), (PATIENTS, "success"),
    ]
    assert rows(gone) == [("spark_catalog.clinic.nowhere",)]
    control = log.select(F.col("unit").alias("TableName"))
    assert rows(prune_control(control, gone)) == [(PATIENTS,)]


def test_discover_one_table(spark, clinic, tmp_path):
    control = ControlTable(spark, str(tmp_path / "control"))
    matches = discover_table(spark, VISITS, control)
    assert rows(matches, "ColumnName") == [("street",)]
    assert rows(control.read(), "Id", "ColumnName") == [(1, "street")]


def test_view_follows_the_grants(spark, clinic, tmp_path):
    me = spark.sql("SELECT current_user()").first()[0]
    path = str(tmp_path / "grants")
    spark.createDataFrame([("someone", "pii_access"), (me, "other")], GRANTS).write.parquet(path)
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW grants USING parquet OPTIONS (path '{path}')")
    names = register_mask_functions(spark, "grants")
    assert names == [f"`{f}`" for f in MASK_FUNCTIONS.values()]
    create_masked_view(
        spark, "patients_view", "clinic.patients", ["lastname", "ssn", "dob"], "grants"
    )
    by_function = "SELECT tc_string_mask(LastName), tc_date_mask(dob) FROM clinic.patients"
    assert rows(spark.sql(by_function)) == [("L*", None), ("S****", "1*********")]
    shown = ("patient_id", "LastName", "ssn", "dob")
    assert rows(spark.table("patients_view"), *shown) == [
        (1, "S****", "1**********", "1*********"), (2, "L*", None, None),
    ]
    frame = mask_table(spark.table("clinic.patients"), ["LastName"], has_grant(spark.table("grants")))
    assert rows(frame, "LastName") == [("L*",), ("S****",)]

    spark.createDataFrame([(me, "pii_access")], GRANTS).write.mode("append").parquet(path)
    spark.catalog.refreshTable("grants")
    assert rows(spark.table("patients_view"), *shown) == [
        (1, "Smith", "123-45-6789", "1980-02-03"), (2, "Li", None, None),
    ]
    assert rows(spark.sql(by_function)) == [("Li", None), ("Smith", "1980-02-03")]
    assert rows(mask_table(spark.table("clinic.patients"), ["LastName"],
                           has_grant(spark.table("grants"))), "LastName") == [("Li",), ("Smith",)]
    with pytest.raises(ValueError, match="ssn_history"):
        create_masked_view(spark, "v", "clinic.patients", ["ssn_history"], "grants")
    with pytest.raises(ValueError, match="no such column: nope"):
        create_masked_view(spark, "v", "clinic.patients", ["nope"], "grants")


def test_stored_functions_and_view(spark, clinic):
    spark.createDataFrame([], GRANTS).write.mode("overwrite").saveAsTable("clinic.grants")
    register_mask_functions(spark, "spark_catalog.clinic.grants", schema="clinic")
    register_mask_functions(spark, "spark_catalog.clinic.grants", schema="clinic")
    by_function = spark.sql("SELECT clinic.tc_string_mask(street) FROM clinic.visits")
    assert rows(by_function) == [("M******",)]
    assert "Python" not in by_function._jdf.queryExecution().toString()
    columns = {"street": "shape", "n": "redact"}
    create_masked_view(
        spark, "clinic.visits_view", "clinic.visits", columns, "spark_catalog.clinic.grants", temporary=False
    )
    assert rows(spark.table("clinic.visits_view")) == [(1, "Xxxx Xx", "5")]
    spark.sql("DROP VIEW clinic.visits_view")


def test_one_grant_lookup_for_all_columns(spark, clinic):
    grants = spark.createDataFrame([("x", "y")], GRANTS)
    df = mask_table(spark.table("clinic.patients"), ["LastName", "ssn", "dob"], has_grant(grants))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("scalar-subquery") == 1


def test_a_schema_that_cannot_be_listed_is_logged(spark, clinic, tmp_path):
    pairs = [("spark_catalog", "nowhere"), ("spark_catalog", "clinic")]
    names = list(stored_tables(spark, spark.createDataFrame(pairs, NAMESPACES)))
    assert ("spark_catalog.nowhere", True) in [(n[0], True) for n in names if isinstance(n, tuple)]
    control = ControlTable(spark, str(tmp_path / "control"))
    log = discover_catalog(spark, control, names=names)
    assert ("spark_catalog.nowhere", "failed") in rows(log, "unit", "status")
    assert (PATIENTS, "success") in rows(log, "unit", "status")


def test_any_decimal_precision_in_a_view(spark, clinic):
    spark.sql("SELECT CAST(1234.5 AS DECIMAL(12,4)) AS m").createOrReplaceTempView("money")
    spark.createDataFrame([], GRANTS).createOrReplaceTempView("no_grants")
    create_masked_view(spark, "money_view", "money", ["m"], "no_grants")
    assert rows(spark.table("money_view")) == [("1********",)]


def test_runs_write_only_what_is_due(spark, clinic, tmp_path):
    """An unsupported and a dropped column never rewrite a table; a changed strategy and a refresh do."""
    control = ControlTable(spark, str(tmp_path / "control"))
    control.replace(
        spark.createDataFrame(
            [(0, PATIENTS, "lastname", "LastName", "string", True), (0, PATIENTS, "ssn", "ssn_history", "array<string>", True),
             (0, PATIENTS, "x", "dropped", "string", True), (0, VISITS, "street", "street", "string", True)],
            CONTROL,
        )
    )
    written = []

    def write(name, df):
        written.append(name)
        df.write.mode("overwrite").parquet(f"{tmp_path}/copies/{name}")

    def run(strategies=None, **options):
        written.clear()
        done = apply_control(spark, control, write, f"{tmp_path}/logs", strategies, strict=False, **options)
        return sorted(written), rows(done.log, "ColumnName", "status"), done

    failed = [("dropped", "failed"), ("ssn_history", "failed")]
    def folders():
        return set(os.listdir(work_root(spark))) if os.path.exists(work_root(spark)) else set()

    before = folders()
    first = run()
    assert first[0] == [PATIENTS, VISITS]
    assert folders() == before
    assert first[1] == sorted([*failed, ("LastName", "success"), ("street", "success")], key=repr)
    assert rows(first[2].inspection, "status") == [("success",)] * 2
    assert rows(first[2].summary(), "n_success", "n_skipped", "n_failed") == [(1, 0, 1)]
    assert run()[:2] == ([], failed)
    assert run()[:2] == ([], failed)
    assert run({"lastname": "full"})[0] == [PATIENTS]
    assert rows(spark.read.parquet(f"{tmp_path}/copies/{PATIENTS}"), "LastName") == [("****",), ("****",)]
    assert run({"lastname": "full"})[0] == []
    assert run()[0] == [PATIENTS]
    # A mask that an earlier copy had and the latest does not have is due again.
    flags = control.read()
    control.write(flags.withColumn("EncryptFlag", F.col("ColumnName") != "LastName"))
    assert run(refresh=True)[0] == [VISITS]
    control.write(flags.withColumn("ColumnName", F.when(F.col("ColumnName") == "dropped", "ssn").otherwise(F.col("ColumnName")))
                  .withColumn("EncryptFlag", F.col("ColumnName") != "LastName"))
    assert run()[0] == [PATIENTS]
    assert rows(spark.read.parquet(f"{tmp_path}/copies/{PATIENTS}"), "LastName") == [("Li",), ("Smith",)]
    control.write(flags)
    assert run()[0] == [PATIENTS]
    assert rows(spark.read.parquet(f"{tmp_path}/copies/{PATIENTS}"), "LastName") == [("L*",), ("S****",)]
    spark.sql("INSERT INTO clinic.visits VALUES (2, 'Side St', 6)")
    assert run()[0] == []
    assert run(refresh=True)[0] == [PATIENTS, VISITS]
    assert rows(spark.read.parquet(f"{tmp_path}/copies/{VISITS}"), "street") == [("M******",), ("S******",)]


def test_views_from_the_control_table_follow_table_and_reader(spark, clinic, tmp_path):
    me = spark.sql("SELECT current_user()").first()[0]
    spark.sql("SELECT 1 AS id, 'Main St' AS street, 's1' AS ssn, array('x') AS ssn_list, 1 AS _key, 2 AS _authorized").write.mode(
        "overwrite"
    ).saveAsTable("clinic.homes")
    homes = "spark_catalog.clinic.homes"
    spark.createDataFrame([("someone", "o'neil")], GRANTS).write.mode("overwrite").saveAsTable("clinic.may_read")
    control = ControlTable(spark, str(tmp_path / "control"))
    control.replace(
        spark.createDataFrame(
            [(0, homes, "street", "street", "string", True), (0, homes, "ssn", "SSN", "string", True),
             (0, homes, "ssn", "ssn_list", "array<string>", True)],
            CONTROL,
        )
    )

    def views(**options):
        return apply_views(
            spark, control, lambda t: f"{t}_masked", "spark_catalog.clinic.may_read", f"{tmp_path}/logs", {"ssn": "hash"},
            group="o'neil", key="(SELECT 'k')", **options,
        )

    done = views(strict=False)
    assert rows(done.log, "ColumnName", "status") == [("SSN", "success"), ("ssn_list", "failed"), ("street", "success")]
    shown = spark.table("clinic.homes_masked")
    assert shown.columns == ["id", "street", "ssn", "_key", "_authorized"]
    hashed = spark.sql("SELECT sha2('k' || sha2('ks1', 256), 256)").first()[0]
    assert rows(shown) == [(1, "M******", hashed, 1, 2)]
    spark.sql("INSERT INTO clinic.homes VALUES (2, 'Oak', 's2', NULL, 3, 4)")
    assert spark.table("clinic.homes_masked").count() == 2
    spark.createDataFrame([(me, "o'neil")], GRANTS).write.mode("append").saveAsTable("clinic.may_read")
    assert rows(spark.table("clinic.homes_masked"), "street", "ssn") == [("Main St", "s1"), ("Oak", "s2")]
    with pytest.raises(MaskRunError, match="1 column"):
        views()
    spark.sql("DROP VIEW clinic.homes_masked")
    spark.sql("DROP TABLE clinic.homes")
    spark.sql("DROP TABLE clinic.may_read")


def test_names_that_need_quoting(spark, tmp_path):
    assert quote_table("a.b.c") == "`a`.`b`.`c`"
    assert quote_table("a.`b.c`.`d``e`") == "`a`.`b.c`.`d``e`"
    parts = spark.createDataFrame([("a", "b.c", "d`e"), ("a", "b", "my-table")], "a string, b string, c string")
    names = [r[0] for r in parts.select(qualified_name(F.col("a"), F.col("b"), F.col("c"))).collect()]
    assert names == ["a.`b.c`.`d``e`", "a.b.my-table"]
    spark.sql("CREATE SCHEMA IF NOT EXISTS `2024`")
    spark.sql("SELECT 'x' AS ssn").write.mode("overwrite").saveAsTable("`2024`.`2025`")
    name = "spark_catalog.2024.2025"
    control = ControlTable(spark, str(tmp_path / "control"))
    discover_catalog(spark, control, names=[name])
    apply_control(spark, control, lambda t, df: df.write.parquet(f"{tmp_path}/copy"), f"{tmp_path}/logs")
    assert rows(spark.read.parquet(f"{tmp_path}/copy")) == [("x",)]
    assert rows(discover_table(spark, name, control), "ColumnName") == [("ssn",)]


def test_audit_takes_names_in_any_case_and_tokens(spark):
    df = spark.createDataFrame([("a", "tok_1"), ("bb", "x")], "SSN string, t string")
    got = exposure_audit("t", df, {"ssn": "redact", "T": "token"})
    assert rows(got, "ColumnName", "n_exposed") == [("SSN", 1), ("t", 1)]


def test_work_folders_are_dropped_on_request(spark, tmp_path):
    spark.range(3).write.parquet(work_folder(spark, "some"))
    assert any(f.startswith("some-") for f in os.listdir(work_root(spark)))
    keep = work_root(spark)
    drop_work_folders(spark)
    assert not os.path.exists(keep)


def test_the_queries_over_all_tables_reach_each_of_them(spark):
    sf = "/root/testdata/sf0.001"
    queries = __spark_entry__.queries()
    for name in ("namespace_tables_all", "definitions_all"):
        assert {r["TableName"].split(".")[-1] for r in queries[name](spark, sf).collect()} == set(GIVEN)
    found = {(r["TableName"].split(".")[-1], r["ColumnName"]) for r in queries["discover_catalog_all"](spark, sf).collect()}
    assert found == {(t, c) for t, (columns, _) in MASKED.items() for c in columns}
    assert {("documents", "text"), ("pages", "url"), ("region", "r_name"), ("part", "p_retailprice")} <= found
