"""Masked copies that follow the files of their source."""

import os

import pytest

from colmask import ControlTable, MaskedCopy, discover_table, follow_control, mask_table
from colmask.session import drop_folder
from colmask.sources.commits import CommitConflict, CommitLog
from tests.conftest import rows

SCHEMA = "id bigint, ssn string, _file string, day string"


def put(spark, root, name, values):
    frame = spark.createDataFrame([(i, f"s{i}", "f") for i in values], "id bigint, ssn string, _file string")
    frame.coalesce(1).write.parquet(f"{root}/{name}")


def whole(spark, root, columns):
    return mask_table(spark.read.schema(SCHEMA).option("basePath", root).parquet(root), columns)


def written(copy, version=None):
    """Rows that are in the folders of a version, by folder."""
    commit = copy.log.last() if version is None else copy.log.read(version)
    return {f: copy.spark.read.parquet(f"{copy.path}/rows/{f}").count() for f in commit["folders"]}


@pytest.fixture
def source(spark, tmp_path):
    root = str(tmp_path / "the source")
    put(spark, root, "day=mon", range(10))
    put(spark, root, "day=tue", range(10, 14))
    return root


def test_only_new_files_are_masked(spark, tmp_path, source):
    copy = MaskedCopy(spark, str(tmp_path / "copy"))
    with pytest.raises(ValueError, match="nothing was copied"):
        copy.read()
    first = copy.follow(source, SCHEMA, {"ssn": "redact"}, files_at_once=1)
    assert (first.version, first.n_new, first.n_gone, first.n_kept) == (0, 2, 0, 0)
    assert copy.read().columns == ["id", "ssn", "_file", "day"]
    assert rows(copy.read()) == rows(whole(spark, source, {"ssn": "redact"}))
    same = copy.follow(source, SCHEMA, {"SSN": "redact"})
    assert (same.version, same.n_new, same.n_kept) == (0, 0, 2)

    put(spark, source, "day=wed", range(20, 25))
    more = copy.follow(source, SCHEMA, {"ssn": "redact"})
    assert (more.version, more.n_new, more.n_kept) == (1, 1, 2)
    assert rows(copy.read()) == rows(whole(spark, source, {"ssn": "redact"}))
    old, new = written(copy, 0), written(copy)
    assert old.items() <= new.items() and sorted(new.values()) == [5, 14]
    assert copy.read(0).count() == 14


def test_rows_of_gone_and_replaced_files_are_dropped(spark, tmp_path, source):
    copy = MaskedCopy(spark, str(tmp_path / "copy"))
    copy.follow(source, SCHEMA, {"ssn": "redact"})
    put(spark, source, "day=wed", range(20, 25))
    copy.follow(source, SCHEMA, {"ssn": "redact"})
    untouched = copy.log.last()["folders"][1]
    drop_folder(spark, f"{source}/day=tue")
    put(spark, source, "day=tue", [77])
    run = copy.follow(source, SCHEMA, {"ssn": "redact"})
    assert (run.n_new, run.n_gone, run.n_kept) == (1, 1, 2)
    assert rows(copy.read()) == rows(whole(spark, source, {"ssn": "redact"}))
    assert untouched in copy.log.last()["folders"]
    for day in ("mon", "tue", "wed"):
        drop_folder(spark, f"{source}/day={day}")
    assert copy.follow(source, SCHEMA, {"ssn": "redact"}).n_gone == 3
    assert copy.read().count() == 0
    assert copy.drop_unused() > 3
    assert copy.read().count() == 0


def test_other_masks_start_anew(spark, tmp_path, source):
    copy = MaskedCopy(spark, str(tmp_path / "copy"))
    copy.follow(source, SCHEMA, {"ssn": "redact"})
    assert copy.follow(source, SCHEMA, {"ssn": "full"}).n_new == 2
    assert rows(copy.read()) == rows(whole(spark, source, {"ssn": "full"}))
    assert copy.follow(source, SCHEMA, {"ssn": "full"}, refresh=True).n_new == 2
    assert copy.follow(source, SCHEMA, {"ssn": "full"}, left_out=["ID"]).n_new == 2
    assert copy.read().columns == ["ssn", "_file", "day"]


def test_a_run_that_dies_before_its_commit(spark, tmp_path, source, monkeypatch):
    copy = MaskedCopy(spark, str(tmp_path / "copy"))
    copy.follow(source, SCHEMA, {"ssn": "redact"})
    before = rows(copy.read())
    put(spark, source, "day=wed", range(20, 25))
    drop_folder(spark, f"{source}/day=tue")

    def die(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as broken:
        broken.setattr(CommitLog, "add", die)
        with pytest.raises(KeyboardInterrupt):
            copy.follow(source, SCHEMA, {"ssn": "redact"})
    again = MaskedCopy(spark, copy.path)
    assert rows(again.read()) == before
    run = again.follow(source, SCHEMA, {"ssn": "redact"})
    assert (run.version, run.n_new, run.n_gone) == (1, 1, 1)
    assert rows(again.read()) == rows(whole(spark, source, {"ssn": "redact"}))
    assert len(os.listdir(f"{copy.path}/rows")) > len(again.log.last()["folders"])
    again.drop_unused()
    assert set(os.listdir(f"{copy.path}/rows")) == set(again.log.last()["folders"])


def test_of_two_runs_one_fails(spark, tmp_path, source, monkeypatch):
    copy = MaskedCopy(spark, str(tmp_path / "copy"))
    add = CommitLog.add

    def late(self, number, content):
        monkeypatch.setattr(CommitLog, "add", add)
        copy.follow(source, SCHEMA, {"ssn": "redact"})
        add(self, number, content)

    monkeypatch.setattr(CommitLog, "add", late)
    with pytest.raises(CommitConflict):
        copy.follow(source, SCHEMA, {"ssn": "redact"})
    assert copy.read().count() == 14


def test_empty_source(spark, tmp_path):
    root = str(tmp_path / "none")
    spark.createDataFrame([], "id bigint, ssn string").write.parquet(root)
    copy = MaskedCopy(spark, str(tmp_path / "copy"))
    copy.follow(root, "id bigint, ssn string", {"ssn": "redact"})
    assert copy.read().count() == 0 and copy.read().columns == ["id", "ssn"]


def test_flagged_tables_follow_their_sources(spark, tmp_path, source):
    spark.sql("DROP SCHEMA IF EXISTS followed CASCADE")
    spark.sql("CREATE SCHEMA followed")
    spark.sql(f"CREATE TABLE followed.t (id BIGINT, ssn STRING, _file STRING, day STRING) USING parquet PARTITIONED BY (day) LOCATION '{source}'")
    spark.sql("MSCK REPAIR TABLE followed.t")
    spark.sql("CREATE VIEW followed.v AS SELECT * FROM followed.t")
    control = ControlTable(spark, str(tmp_path / "control"))
    for name in ("t", "v"):
        discover_table(spark, f"spark_catalog.followed.{name}", control)

    def follow():
        return follow_control(spark, control, lambda t: str(tmp_path / t), str(tmp_path / "logs"), strict=False)

    run = follow()
    assert {(r["TableName"][-1], r["status"]) for r in run.log.collect()} == {("t", "success"), ("v", "failed")}
    assert run.runs["spark_catalog.followed.t"].n_new == 2
    put(spark, source, "day=wed", [5])
    assert follow().runs["spark_catalog.followed.t"].n_new == 1
    copy = MaskedCopy(spark, str(tmp_path / "spark_catalog.followed.t"))
    assert rows(copy.read()) == rows(whole(spark, source, {"ssn": "redact"}))
    spark.sql("DROP SCHEMA followed CASCADE")
