import pytest

from colmask import StreamedCopy, Vault, mask_table, write_masked_stream, write_tokenized_stream
from colmask.sources.versions import merge_from
from tests.conftest import rows


def test_stream_masks_each_row_once(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    spark.sql("SELECT * FROM VALUES (1, 'Smith'), (2, 'Li') AS t(id, lastname)").write.parquet(source)
    schema = spark.read.parquet(source).schema

    def run():
        stream = spark.readStream.schema(schema).parquet(source)
        write_masked_stream(stream, ["lastname"], out, state).awaitTermination()
        return rows(spark.read.parquet(out))

    assert run() == [(1, "S****"), (2, "L*")]
    assert run() == [(1, "S****"), (2, "L*")]
    spark.sql("SELECT 3 AS id, 'Ng' AS lastname").write.mode("append").parquet(source)
    assert run() == [(1, "S****"), (2, "L*"), (3, "N*")]


def test_masked_stream_stays_a_stream(spark):
    stream = spark.readStream.format("rate").load()
    assert mask_table(stream, ["value"]).isStreaming


SCHEMA = "id int, ssn string, `odd.name` string"


def _tokens(spark, root, state="state"):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    query = write_tokenized_stream(
        stream, {"ssn": "token", "`odd.name`": "full"}, f"{root}/out", f"{root}/{state}", Vault(spark, f"{root}/vault")
    )
    query.awaitTermination()


def _source(spark, root, *values):
    df = spark.createDataFrame([(i, v, "x") for i, v in values], SCHEMA)
    df.coalesce(1).write.mode("append").parquet(f"{root}/in")


def test_values_that_come_with_a_stream_get_tokens(spark, tmp_path):
    root = str(tmp_path)
    _source(spark, root, (1, "a"), (2, "b"), (3, None), (4, "a"))
    _tokens(spark, root)
    _source(spark, root, (5, "c"), (6, "b"))
    _source(spark, root, (7, "c"))
    _tokens(spark, root)
    copy = StreamedCopy(spark, f"{root}/out")
    token = {r["value"]: f"tok_{r['token']}" for r in Vault(spark, f"{root}/vault").read().collect()}
    assert sorted(token) == ["a", "b", "c"] and len(set(token.values())) == 3
    assert rows(copy.read(), "id", "ssn") == sorted(
        [(1, token["a"]), (2, token["b"]), (3, None), (4, token["a"]), (5, token["c"]), (6, token["b"]), (7, token["c"])], key=repr
    )
    assert {r["odd.name"] for r in copy.read().collect()} == {"****"}
    n = copy.version()
    _tokens(spark, root)
    assert copy.version() == n
    # Another stream over the same files has batches of its own.
    _tokens(spark, root, "other")
    assert copy.read().count() == 14 and Vault(spark, f"{root}/vault").read().count() == 3
    with pytest.raises(ValueError, match="other columns"):
        StreamedCopy(spark, f"{root}/out", "id int")


@pytest.mark.parametrize("step", ["before the copy", "after the copy"])
def test_a_batch_that_died_comes_once(spark, tmp_path, monkeypatch, step):
    root = str(tmp_path)
    _source(spark, root, (1, "a"), (2, "b"))
    _tokens(spark, root)
    _source(spark, root, (3, "c"), (4, "a"))
    add = StreamedCopy.add_batch

    def dies(self, *args):
        if step == "after the copy":
            add(self, *args)
        raise RuntimeError("lost")

    monkeypatch.setattr(StreamedCopy, "add_batch", dies)
    with pytest.raises(Exception, match="lost"):
        _tokens(spark, root)
    before = rows(Vault(spark, f"{root}/vault").read())
    assert [v for v, _ in before] == ["a", "b", "c"]
    monkeypatch.setattr(StreamedCopy, "add_batch", add)
    _tokens(spark, root)
    assert rows(Vault(spark, f"{root}/vault").read()) == before
    token = {v: f"tok_{t}" for v, t in before}
    got = rows(StreamedCopy(spark, f"{root}/out").read(), "id", "ssn")
    assert got == [(1, token["a"]), (2, token["b"]), (3, token["c"]), (4, token["a"])]


def test_a_copy_that_is_not_there(spark, tmp_path):
    with pytest.raises(ValueError, match="nothing was copied"):
        StreamedCopy(spark, str(tmp_path / "none"))


@pytest.mark.parametrize("most", [2, 3, 16])
def test_folders_are_merged_level_by_level(most):
    folders, written = [], 0
    for version in range(1000):
        start, level = merge_from([lv for lv, _ in folders], most)
        size = 1 + sum(n for _, n in folders[start:])
        folders, written = [*folders[:start], (level, size)], written + size
        levels = [lv for lv, _ in folders]
        assert levels == sorted(levels, reverse=True)
        assert all(levels.count(lv) < most for lv in levels)
        assert sum(n for _, n in folders) == version + 1
    assert written <= 1000 * (1 + max(lv for lv, _ in folders) + 1)
