from collections import Counter

import pytest
from pyspark.sql import functions as F

from colmask.operators.sketches import HASHES, _value_hash, exposure_sketch, merged_exposure
from colmask.plans.exposure import ExposureSketches
from colmask.session import drop_folder
from tests.conftest import rows

SETS = {"a": ["a"], "a+b": ["A", "b"]}


def _exact(found, name="t"):
    both = {"a": Counter(a for a, _ in found), "a+b": Counter(found)}
    return sorted(
        [(name, s, len(found), len(c), sum(n == 1 for n in c.values()), sum(n < 5 for n in c.values()), True) for s, c in both.items()]
    )


def test_exact_for_few_values(spark):
    found = [(None if i % 7 == 0 else f"v{i % 40}", None if i % 3 == 0 else f"{i % 11}") for i in range(500)]
    found += [("1:x", None), (None, "1:x"), ("", None), (None, ""), (None, None), ("x-", "y"), ("x", "-y")]
    df = spark.createDataFrame([(*r, i % 4) for i, r in enumerate(found)], "a string, b string, part int")
    got = merged_exposure(exposure_sketch("t", df, "part", SETS))
    assert rows(got) == _exact(found)
    # The same from one unit, and of nothing at all.
    assert rows(merged_exposure(exposure_sketch("t", df.withColumn("part", F.lit(None)), "part", SETS))) == _exact(found)
    assert merged_exposure(exposure_sketch("t", df.limit(0), "part", SETS)).isEmpty()


def test_many_values_within_the_error(spark):
    # 40,000 values of one row, 10,000 of six, spread over units with a third of all rows in one.
    ids = spark.range(40_000).selectExpr("concat('u', id) AS a", "id AS i").unionByName(
        spark.range(60_000).selectExpr("concat('s', id % 10000) AS a", "id AS i")
    )
    df = ids.withColumn("part", F.when(F.col("i") % 3 == 0, 0).otherwise(F.col("i") % 5))
    sketch = exposure_sketch("t", df, "part", {"a": ["a"]}, k=2048)
    assert sketch.filter("hash IS NOT NULL").groupBy("unit").count().agg(F.max("count")).first()[0] == 2048
    got = merged_exposure(sketch).first()
    assert got["n_rows"] == 100_000 and not got["exact"]
    assert got["n_values"] == pytest.approx(50_000, rel=0.1)
    assert got["n_unique"] == pytest.approx(40_000, rel=0.1) and got["n_few"] == got["n_unique"]


def test_only_hashes_that_may_be_low_are_shuffled(spark, tmp_path):
    """The sketch of many values is that of all hashes, of which each unit hands on little more than it keeps."""
    spark.range(60_000).selectExpr(
        "CASE WHEN id % 50 > 0 THEN id % 30000 END AS a", "id % 5 AS b", "nullif(id % 4, 3) AS part"
    ).write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    sets, k = {"a": ["a"], "b": ["b"], "a, b": ["a", "b"]}, 100
    sketch = exposure_sketch("t", df, "part", sets, k=k)
    got = rows(sketch.filter("hash IS NOT NULL"), "Columns", "unit", "theta", "hash", "n")
    found = {}
    for r in df.select("part", *[_value_hash(df, c).alias(s) for s, c in sets.items()]).collect():
        for s in sets:
            found.setdefault((s, None if r["part"] is None else str(r["part"])), Counter())[r[s]] += 1
    want = []
    for (s, unit), counts in found.items():
        low = sorted(counts)
        theta = low[k] if len(low) > k else HASHES
        want += [(s, unit, theta, h, counts[h]) for h in low[:k]]
    assert got == sorted(want, key=repr)
    metrics = []

    def walk(plan):
        if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            plan = plan.executedPlan()
        if plan.getClass().getSimpleName().endswith("QueryStageExec"):
            plan = plan.plan()
        if plan.getClass().getSimpleName() == "ShuffleExchangeExec":
            metrics.append(plan.metrics().apply("shuffleRecordsWritten").value())
        for i in range(plan.children().size()):
            walk(plan.children().apply(i))

    counting = sketch.groupBy("Columns").count()
    frame = counting._jdf
    frame.collectToPython()
    walk(frame.queryExecution().executedPlan())
    assert metrics and max(metrics) < 15_000


def test_a_new_file_costs_one_scan(spark, tmp_path, monkeypatch):
    found = [(f"{'abc'[i % 3]}{i}", "x" if i % 2 else None) for i in range(30)]
    schema = "a string, b string"

    def put(part, chosen):
        spark.createDataFrame(chosen, schema).coalesce(1).write.parquet(f"{tmp_path}/in/part={part}")

    def exposure():
        sketches = ExposureSketches(spark, f"{tmp_path}/sketches")
        return rows(sketches.follow("t", f"{tmp_path}/in", schema, {"a": "redact"}, SETS))

    def masked(chosen):
        return [(a[0] + "*" * (len(a) - 1), b) for a, b in chosen]

    put(1, found[:10])
    put(2, found[10:20])
    assert exposure() == _exact(masked(found[:20]))
    put(3, found[20:])
    assert exposure() == _exact(masked(found))
    units = ExposureSketches(spark, f"{tmp_path}/sketches").read().filter("hash IS NULL").groupBy("unit").count()
    assert [r["count"] for r in units.collect()] == [2, 2, 2]
    drop_folder(spark, f"{tmp_path}/in/part=1")
    version = ExposureSketches(spark, f"{tmp_path}/sketches").version()
    assert exposure() == _exact(masked(found[10:]))
    assert ExposureSketches(spark, f"{tmp_path}/sketches").version() == version
    with pytest.raises(ValueError, match="other masks or sets"):
        ExposureSketches(spark, f"{tmp_path}/sketches").follow("t", f"{tmp_path}/in", schema, {"a": "full"}, SETS)
