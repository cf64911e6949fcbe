import zlib
from collections import Counter

from pyspark.sql import functions as F

from colmask.llm.sharding import ORACLES, UNFOLDED, assign_shards, layout, op10_shards
from tests.conftest import rows
from tests.llm.helpers import SF_DIR, duck, no_docs, odd_docs, same_as_sql


def test_query_against_sql(spark):
    assert same_as_sql(op10_shards(spark, SF_DIR), ORACLES["op10_shards"], duck())


def many(spark, n=6000):
    return spark.range(n).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))


def placed(spark, tree, n=6000):
    got = assign_shards(many(spark, n), tree, tree)
    return {r["doc_id"]: r["shard"] for r in got.select("doc_id", "shard").collect()}


def test_one_more_shard_takes_rows_only_into_itself(spark):
    for count in (24, 25, 30):
        before, after = placed(spark, layout(count), 3000), placed(spark, layout(count + 1), 3000)
        moved = {after[k] for k in before if before[k] != after[k]}
        assert moved == {count}


def test_shares_follow_weights(spark):
    counts = Counter(placed(spark, layout(24, weights={3: 4.0})).values())
    share = 6000 / 27
    assert set(counts) == set(range(24))
    assert abs(counts[3] - 4 * share) < 5 * (4 * share) ** 0.5
    assert all(abs(n - share) < 5 * share**0.5 for s, n in counts.items() if s != 3)


def test_a_weight_moves_rows_only_with_its_own_subtree(spark):
    before, after = placed(spark, layout(24)), placed(spark, layout(24, weights={0: 3.0}))
    region = {s: s * 6 // 24 // 2 for s in range(24)}
    rack = {s: s * 6 // 24 for s in range(24)}
    for key, old in before.items():
        new = after[key]
        if old == new:
            continue
        # Into the heavier shard's region, or within it into its rack, or within that into the shard.
        assert region[new] == region[0]
        if region[old] == region[0]:
            assert rack[new] == rack[0]
            if rack[old] == rack[0]:
                assert new == 0


def test_odd_rows(spark):
    docs = odd_docs(spark, ["shard", "_n", "_key", "size"])
    got = assign_shards(docs, layout(24), layout(25))
    table = got.collect()
    assert len(table) == docs.count()
    assert all(r["size"] == 8 and r["text_crc32"] == 0 for r in table if r["doc_id"] in (2, 3))
    text = docs.filter("doc_id = 7").first()["text"].encode()
    assert [(r["size"], r["text_crc32"]) for r in table if r["doc_id"] == 7] == [(len(text) + 8, zlib.crc32(text))]
    slots = {}
    for r in table:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    twins = [r["slot"] for r in table if r["doc_id"] == 1]
    assert abs(twins[0] - twins[1]) == 1
    assert rows(assign_shards(no_docs(spark), layout(24), layout(25))) == []


def test_a_third_of_all_rows_alike(spark):
    docs = many(spark, 400).unionAll(spark.range(200).select(F.lit(7).cast("bigint"), F.lit("t")))
    got = assign_shards(docs, layout(3, base=3), layout(4, base=3))
    for (shard,) in rows(got.select("shard").distinct()):
        slots = sorted(r["slot"] for r in got.filter(F.col("shard") == shard).collect())
        assert slots == list(range(len(slots)))
    assert got.count() == 600


def test_equal_rows_beyond_one_range(spark):
    n = 2 * UNFOLDED + 1
    docs = many(spark, 50).unionAll(spark.range(n).select(F.lit(-5).cast("bigint"), F.lit("t")))
    got = assign_shards(docs, layout(3, base=3), layout(4, base=3))
    assert got.filter("doc_id = -5").count() == n and got.count() == n + 50
    spans = got.groupBy("shard").agg(F.min("slot"), F.max("slot") + 1, F.countDistinct("slot"), F.count(F.lit(1)))
    assert all(first == 0 and end == distinct == count for _, first, end, distinct, count in spans.collect())
