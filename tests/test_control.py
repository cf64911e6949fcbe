import os
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from colmask import session
from colmask import (
    ControlTable,
    Vault,
    duplicate_keys,
    flagged,
    flagged_tables,
    prune_control,
    stale_columns,
    upsert_control,
)
from colmask.operators.planning import masked_columns_from_ddl, pending_columns
from colmask.schemas import COLUMNS, CONTROL
from colmask.sources import versions
from colmask.sources.commits import CommitConflict, CommitLog
from entry_queries import derived
from tests.conftest import rows

MATCHES = "TableName string, PIICategory string, ColumnName string, DataType string, EncryptFlag boolean"
SHOWN = ("TableName", "ColumnName", "PIICategory", "DataType", "EncryptFlag")
GONE = ("a.b.t1", "gone", "zip", "int", True)
DOB = ("a.b.t2", "dob", "dob", "date", True)


@pytest.fixture
def existing(spark):
    return spark.createDataFrame(
        [(1, "a.b.t1", "ssn", "ssn", "string", False), (2, "a.b.t1", "zip", "gone", "int", True)], CONTROL
    )


@pytest.fixture
def incoming(spark):
    return spark.createDataFrame(
        [("a.b.t1", "ssn", "ssn", "bigint", True), ("a.b.t2", "dob", "dob", "date", True)], MATCHES
    )


def test_upsert_overwrites_the_flag(existing, incoming):
    got = upsert_control(existing, incoming, keep_flag=False)
    assert rows(got, *SHOWN) == [GONE, ("a.b.t1", "ssn", "ssn", "bigint", True), DOB]
    assert rows(got, "Id") == [(1,), (2,), (3,)]


def test_upsert_keeps_the_steward_flag(existing, incoming):
    got = upsert_control(existing, incoming)
    assert rows(got, *SHOWN) == [GONE, ("a.b.t1", "ssn", "ssn", "bigint", False), DOB]


def test_upsert_twice_is_upsert_once(existing, incoming):
    for keep in (True, False):
        once = upsert_control(existing, incoming, keep)
        assert rows(upsert_control(once, incoming, keep)) == rows(once)


def test_upsert_with_empty_sides(spark, existing, incoming):
    nothing = spark.createDataFrame([], MATCHES)
    assert rows(upsert_control(existing, nothing)) == rows(existing)
    fresh = upsert_control(spark.createDataFrame([], CONTROL), incoming)
    assert sorted(r["Id"] for r in fresh.collect()) == [1, 2]


def test_upsert_matches_names_without_case(spark, existing):
    shout = spark.createDataFrame([("A.B.T1", "ssn", "SSN", "date", True)], MATCHES)
    got = upsert_control(existing, shout)
    assert rows(got, *SHOWN) == [GONE, ("a.b.t1", "ssn", "ssn", "date", False)]


def test_an_unset_flag_stays_unset_and_does_not_count(spark, incoming):
    unset = spark.createDataFrame([(1, "a.b.t1", "ssn", "ssn", "string", None)], CONTROL)
    got = upsert_control(unset, incoming)
    assert rows(flagged(got), "ColumnName") == [("dob",)]
    assert rows(flagged_tables(got)) == [("a.b.t2",)]


def test_duplicates_in_the_control_table(spark, existing, incoming):
    twice = existing.union(existing)
    assert rows(duplicate_keys(twice)) == [("a.b.t1", "gone", 2), ("a.b.t1", "ssn", 2)]
    assert duplicate_keys(existing).count() == 0
    assert upsert_control(twice, incoming).filter("DataType = 'bigint'").count() == 2


def test_prune(spark):
    data = [(i, "hot" if i % 3 else f"t{i}", "c", f"c{i}", "int", True) for i in range(300)]
    data.append((300, None, "c", "c", "int", True))
    control = spark.createDataFrame(data, CONTROL)
    dead = spark.createDataFrame([("hot",), ("hot",), ("t3",)], "TableName string")
    got = prune_control(control, dead)
    want = [r for r in data if r[1] not in ("hot", "t3")]
    assert rows(got) == sorted(want, key=repr)


def test_stale_columns(spark, existing):
    now = spark.createDataFrame([("a.b.t1", 0, "SSN", "string")], COLUMNS)
    assert rows(stale_columns(existing, now), "ColumnName") == [("gone",)]


def test_versions(spark, tmp_path, existing, incoming):
    control = ControlTable(spark, str(tmp_path / "control"))
    assert control.version() is None and control.read().count() == 0
    control.create()
    control.create()
    assert control.version() == 0
    control.write(existing)
    control.add(incoming)
    assert control.version() == 2
    assert control.add(incoming.limit(0)) == 2
    assert rows(control.read(1)) == rows(existing.select(*control.read(1).columns))
    assert rows(control.flagged(), "ColumnName") == [("dob",), ("gone",)]
    plan = control.flagged()._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(EncryptFlag,true)" in plan
    control.prune(spark.createDataFrame([("a.b.t1",)], "TableName string"))
    assert rows(control.read(), "TableName") == [("a.b.t2",)]
    with pytest.raises(ValueError, match="listed twice: a.b.t"):
        control.add(incoming.union(incoming))
    assert control.version() == 3
    control.replace(incoming.withColumn("Id", F.lit(9)))
    assert rows(control.read(), "Id") == [(4,), (5,)]


def test_a_broken_write_leaves_the_old_version(spark, tmp_path, existing):
    control = ControlTable(spark, str(tmp_path / "control"))
    control.write(existing)
    broken = existing.withColumn("Id", F.raise_error(F.lit("disk on fire")).cast("bigint"))
    with pytest.raises(Exception, match="disk on fire"):
        control.write(broken)
    assert control.version() == 0
    assert rows(control.read()) == rows(existing)
    assert control.write(existing) == 1


def test_names_that_differ_in_case_are_one_column(spark, tmp_path):
    control = ControlTable(spark, str(tmp_path / "control"))
    twins = spark.createDataFrame([("a.b.T", "ssn", "ssn", "string", True), ("a.b.t", "ssn", "SSN", "string", True)], MATCHES)
    assert rows(duplicate_keys(twins), "n_rows") == [(2,)]
    with pytest.raises(ValueError, match="listed twice"):
        control.add(twins)


def test_ids_of_pruned_rows_are_not_given_out_again(spark, tmp_path, incoming):
    control = ControlTable(spark, str(tmp_path / "control"))
    control.add(incoming)
    assert rows(control.read(), "Id") == [(1,), (2,)]
    control.prune(control.read().select("TableName"))
    assert control.read().count() == 0
    control.add(incoming)
    assert rows(control.read(), "Id") == [(3,), (4,)]


def test_a_change_is_made_anew_on_what_another_writer_committed(spark, tmp_path, existing, incoming):
    control = ControlTable(spark, str(tmp_path / "control"))
    control.write(existing)
    others = iter([lambda: control.add(incoming), lambda: control.prune(existing.select("TableName").limit(0))])

    class Slow(ControlTable):
        def _highest(self, folder):
            next(others, lambda: None)()
            return super()._highest(folder)

    more = incoming.withColumn("TableName", F.lit("a.b.later"))
    slow = Slow(spark, control.path)
    assert slow.add(more) == 3
    names = {r["TableName"] for r in control.read().collect()}
    assert "a.b.later" in names and {r["TableName"] for r in incoming.collect()} <= names
    ids = [r["Id"] for r in control.read().collect()]
    assert len(ids) == len(set(ids))
    # Rows of the changes that were made anew are gone.
    assert len(os.listdir(tmp_path / "control" / "rows")) == 4


def test_of_two_whole_writes_the_later_fails(spark, tmp_path, existing, incoming):
    control = ControlTable(spark, str(tmp_path / "control"))
    control.write(existing)

    class Slow(ControlTable):
        def _highest(self, folder):
            control.add(incoming)
            return super()._highest(folder)

    with pytest.raises(CommitConflict):
        Slow(spark, control.path).write(existing.limit(0))
    assert control.version() == 1
    assert control.read().count() > 2


def test_simultaneous_writers_lose_nothing(spark, tmp_path):
    control = ControlTable(spark, str(tmp_path / "control"))

    def add(i):
        return control.add(spark.createDataFrame([(f"a.b.t{i}", "ssn", "ssn", "string", True)], MATCHES))

    with ThreadPoolExecutor(8) as pool:
        versions = list(pool.map(add, range(8)))
    assert sorted(versions) == list(range(8))
    found = control.read().collect()
    assert sorted(r["TableName"] for r in found) == sorted(f"a.b.t{i}" for i in range(8))
    assert sorted(r["Id"] for r in found) == list(range(1, 9))


@pytest.mark.parametrize("scheme", ["", "viewfs"])
def test_a_number_is_taken_once(spark, tmp_path, scheme):
    path = str(tmp_path / "log")
    if scheme:
        spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.commits.link./data", f"file:{tmp_path}")
        path = "viewfs://commits/data/log"
    logs = [CommitLog(spark, path) for _ in range(8)]

    def take(log):
        try:
            log.add(0, {"by": id(log)})
            return id(log)
        except CommitConflict:
            return None

    assert logs[0].last() is None
    if scheme:
        won = [take(log) for log in logs]
    else:
        with ThreadPoolExecutor(8) as pool:
            won = list(pool.map(take, logs))
    winners = [w for w in won if w]
    assert len(winners) == 1 and logs[3].last() == {"by": winners[0], "version": 0}
    logs[1].add(1, {})
    assert logs[2].numbers() == [0, 1]


def test_a_vault_of_many_versions_reads_few_folders(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("colmask.sources.versions.MOST_FOLDERS", 3)
    vault = Vault(spark, str(tmp_path / "vault"))
    for i in range(7):
        vault.add(spark.createDataFrame([(f"v{j}",) for j in range(2 * i + 2)], "value string"), "value")
        assert len(vault.log.last()["folders"]) <= 3
    found = vault.read().collect()
    assert sorted(r["value"] for r in found) == sorted(f"v{j}" for j in range(14))
    assert len({r["token"] for r in found}) == 14
    old = {r["value"]: r["token"] for r in vault.read(1).collect()}
    assert len(old) == 4 and old.items() <= {r["value"]: r["token"] for r in found}.items()


def test_inventories_are_shuffled_and_dealt_out_before_they_grow(spark, tmp_path):
    """The size of a file of customers says nothing of the rows of the inventory made of it."""
    customer = "c_custkey long, c_nationkey int, c_acctbal double, c_mktsegment string"
    people = spark.range(400).selectExpr("id", "CAST(id % 3 AS INT)", "CAST(id % 2 AS DOUBLE)", "'x'").toDF(*[c.split()[0] for c in customer.split(", ")])
    people.coalesce(1).write.parquet(f"{tmp_path}/customer.parquet")
    columns = derived.patient_columns(spark, str(tmp_path))
    assert columns.rdd.getNumPartitions() == 4
    assert columns.count() == 400 * len(derived.PATIENT_COLUMNS)
    control = derived.control(spark, str(tmp_path))
    ddl = masked_columns_from_ddl(derived.ddl(spark, str(tmp_path)))
    matches = columns.limit(0).selectExpr("TableName", "'ssn' AS PIICategory", "ColumnName", "DataType", "true AS EncryptFlag")
    for df in (stale_columns(control, columns), pending_columns(control, ddl), upsert_control(control, matches).filter("Id < 0")):
        plan = df._jdf.queryExecution().sparkPlan().toString()
        assert "SortMergeJoin [_table" in plan and "BroadcastHashJoin [_table" not in plan
    assert stale_columns(control, columns).count() == 400


def test_written_tables_are_read_in_bounded_numbers_of_rows(spark, tmp_path, monkeypatch):
    """Names compress so well that files, dealt out by their bytes, would give a task any number of rows."""
    for module in (session, versions):
        monkeypatch.setattr(module, "ROWS_PER_FILE", 100, raising=False)

    def longest(df):
        return df.groupBy(F.input_file_name()).count().agg(F.max("count"), F.sum("count")).first()

    names = spark.range(0, 1000, 1, 1).selectExpr("id AS Id", "'t' AS TableName", "concat('c', id) AS ColumnName")
    assert tuple(longest(session.stored(names, "names"))) == (100, 1000)
    table = ControlTable(spark, str(tmp_path / "control"))
    table.create()
    table.write(names.selectExpr("Id", "TableName", "'ssn' AS PIICategory", "ColumnName", "'int' AS DataType", "true AS EncryptFlag"))
    assert tuple(longest(table.read())) == (100, 1000)
