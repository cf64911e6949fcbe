import pytest
from pyspark.sql import functions as F

from colmask import ControlTable, Rule, Snapshot, classify_columns, discover_changes, rescan_catalog
from colmask.operators.changes import changed_tables, column_changes, out_of_reach
from colmask.schemas import COLUMNS
from tests.conftest import rows


def _frame(spark, *found):
    return spark.createDataFrame(found, COLUMNS)


def _tables(spark, path, n, changed):
    """``n`` tables of four columns; every ``changed``-th has another type, another column and one less."""
    odd = F.lit(False) if changed is None else F.pmod("id", F.lit(changed)) == 0
    base = F.array(
        *[F.struct(F.lit(i).alias("Ordinal"), F.lit(c).alias("ColumnName"), F.lit(t).alias("DataType"))
          for i, (c, t) in enumerate((("id", "int"), ("ssn", "string"), ("zip_code", "int"), ("note", "string")))]
    )
    other = F.array(
        *[F.struct(F.lit(i).alias("Ordinal"), F.lit(c).alias("ColumnName"), F.lit(t).alias("DataType"))
          for i, (c, t) in enumerate((("id", "int"), ("ssn", "bigint"), ("zip_code", "int"), ("dob", "date")))]
    )
    spark.range(n).select(
        F.concat(F.lit("c.s.t"), F.col("id")).alias("TableName"), F.inline(F.when(odd, other).otherwise(base))
    ).write.parquet(path)
    return spark.read.schema(COLUMNS).parquet(path)


def test_only_changed_tables_are_classified(spark, tmp_path):
    first, second = _tables(spark, f"{tmp_path}/first", 20_000, None), _tables(spark, f"{tmp_path}/second", 20_100, 100)
    control, whole = ControlTable(spark, f"{tmp_path}/control"), ControlTable(spark, f"{tmp_path}/whole")
    for table in (control, whole):
        table.create()
    snapshot = Snapshot(spark, f"{tmp_path}/snapshot")
    assert discover_changes(spark, control, snapshot, first).n_tables == 20_000
    run = discover_changes(spark, control, snapshot, second)
    assert run.n_tables == 300  # 200 of the old ones, 100 new
    kinds = {(r["ColumnName"], r["change"]): r["count"] for r in run.changes.groupBy("ColumnName", "change").count().collect()}
    assert kinds == {
        ("ssn", "retyped"): 200, ("dob", "added"): 201, ("note", "dropped"): 200, ("id", "added"): 100,
        ("ssn", "added"): 100, ("zip_code", "added"): 100, ("note", "added"): 99,
    }
    whole.add(classify_columns(first))
    whole.add(classify_columns(second))
    assert control.read().exceptAll(whole.read()).isEmpty() and control.read().count() == whole.read().count()
    version = snapshot.version()
    again = discover_changes(spark, control, snapshot, second)
    assert again.n_tables == 0 and again.changes.isEmpty() and snapshot.version() == version
    # Other rules, or another control table, look at everything.
    assert discover_changes(spark, control, snapshot, second, [Rule("note")]).n_tables == 20_100
    assert control.read().filter("PIICategory = 'note'").count() == 19_899


def test_kinds_of_changes(spark):
    before = _frame(spark, ("t", 0, "a", "int"), ("t", 1, "b", "int"), ("same", 0, "a", "int"), ("gone", 0, "x", "int"))
    now = _frame(
        spark, ("t", 0, "b", "int"), ("t", 1, "a", "string"), ("same", 0, "a", "int"), ("same", 0, "a", "int"), ("new", 0, "y", None),
        (None, 0, "z", "int"), ("same", 1, None, "int"),
    )
    assert rows(changed_tables(now, before)) == [("gone", "dropped"), ("new", "added"), ("t", "changed")]
    assert rows(column_changes(now, before)) == sorted(
        [("t", "a", "retyped", "int", "string"), ("t", "b", "moved", "int", "int"), ("new", "y", "added", None, None),
         ("gone", "x", "dropped", "int", None)], key=repr
    )
    empty = _frame(spark)
    assert changed_tables(empty, empty).isEmpty() and column_changes(empty, empty).isEmpty()


def test_one_table_with_most_columns(spark):
    before = spark.range(30_000).selectExpr("if(id % 3 = 0, 'hot', concat('t', id)) AS TableName", "int(id) AS Ordinal",
                                            "concat('c', id) AS ColumnName", "'int' AS DataType")
    now = before.withColumn("DataType", F.when(F.col("Ordinal") == 3, "date").otherwise(F.col("DataType")))
    assert rows(changed_tables(now, before)) == [("hot", "changed")]
    assert rows(column_changes(now, before)) == [("hot", "c3", "retyped", "int", "date")]


def test_what_could_not_be_read_is_not_dropped(spark, tmp_path):
    tables = spark.createDataFrame([("c.s.t",), ("c.s.u",), ("c.`s.2`.t",), ("`d``x`.s.t",), ("cs.s.t",)], "TableName string")
    failed = spark.createDataFrame([("c.s.u",), ("c.s.2",), ("d`x",)], "unit string")
    assert rows(out_of_reach(tables, failed)) == [("`d``x`.s.t",), ("c.`s.2`.t",), ("c.s.u",)]
    control = ControlTable(spark, f"{tmp_path}/control")
    control.create()
    snapshot = Snapshot(spark, f"{tmp_path}/snapshot")
    first = _frame(spark, ("c.s.t", 0, "ssn", "string"), ("c.s.u", 0, "dob", "date"), ("d.s.t", 0, "zip", "int"))
    discover_changes(spark, control, snapshot, first)
    now = _frame(spark, ("c.s.t", 0, "ssn", "string"))
    run = discover_changes(spark, control, snapshot, now, failed=spark.createDataFrame([("d",)], "unit string"))
    assert rows(run.changes) == [("c.s.u", "dob", "dropped", "date", None)] and run.n_tables == 0
    assert rows(snapshot.read(), "TableName") == [("c.s.t",), ("d.s.t",)]
    assert discover_changes(spark, control, snapshot, first).n_tables == 1


def test_a_run_that_died_is_made_good(spark, tmp_path, monkeypatch):
    control = ControlTable(spark, f"{tmp_path}/control")
    control.create()
    snapshot = Snapshot(spark, f"{tmp_path}/snapshot")
    first = _frame(spark, ("c.s.t", 0, "ssn", "string"))

    def dies(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(Snapshot, "replace", dies)
        with pytest.raises(RuntimeError):
            discover_changes(spark, control, snapshot, first)
    before = rows(control.read())
    assert len(before) == 1
    assert discover_changes(spark, control, snapshot, first).n_tables == 1
    assert rows(control.read()) == before


def test_rescan_of_catalog_tables_with_fields(spark, tmp_path):
    spark.sql("DROP SCHEMA IF EXISTS rescan_test CASCADE")
    spark.sql("CREATE SCHEMA rescan_test")
    for name, ddl in (("a", "id INT, home STRUCT<zip: STRING>"), ("b", "ssn STRING")):
        spark.sql(f"CREATE TABLE rescan_test.{name} ({ddl}) USING parquet")
    names = [f"spark_catalog.rescan_test.{n}" for n in "ab"]
    control = ControlTable(spark, f"{tmp_path}/control")
    control.create()
    snapshot = Snapshot(spark, f"{tmp_path}/snapshot", nested=True)
    assert rescan_catalog(spark, control, snapshot, names=names).n_tables == 2
    spark.sql("ALTER TABLE rescan_test.a ADD COLUMNS (dob DATE)")
    run = rescan_catalog(spark, control, snapshot, names=[*names, "spark_catalog.rescan_test.none"])
    assert run.n_tables == 1 and rows(run.changes, "ColumnName", "change") == [("dob", "added")]
    assert rows(run.log, "status") == [("failed",), ("success",), ("success",)]
    assert rows(control.read(), "ColumnName") == [("dob",), ("home.zip",), ("ssn",)]
    with pytest.raises(ValueError, match="nested"):
        Snapshot(spark, f"{tmp_path}/snapshot")
