import hashlib
import re

import numpy as np
from pyspark.sql import functions as F

from colmask.llm import decontaminate as d
from tests.conftest import rows
from tests.llm.helpers import SF_DIR, docs_frame, duck, no_docs, odd_docs, same_as_sql, table

ITEMS = "item_id bigint, text string"


def plain_words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def plain(docs, items, window=10):
    """``{row: (words, hit words, items)}`` by looking for every window at every place."""
    out = []
    for text in docs:
        words = plain_words(text)
        hit, found = set(), set()
        for name, item in items:
            own = plain_words(item)
            k = min(window, len(own))
            windows = {tuple(own[i : i + k]) for i in range(len(own) - k + 1)} if own else set()
            for i in range(len(words) - k + 1):
                if tuple(words[i : i + k]) in windows:
                    hit |= set(range(i, i + k))
                    found.add(name)
        out.append((len(words), len(hit), sorted(map(str, found))))
    return out


def test_query_against_sql(spark):
    assert same_as_sql(d.op6_decontaminate(spark, SF_DIR), d.OP6_SQL, duck())
    assert d.op6_decontaminate(spark, SF_DIR).filter("contaminated").count() > 0


def test_random_texts_small_shards_and_blocks(spark):
    rng = np.random.default_rng(3)
    words = ["the", "of", "a", "Da", "été", "x1"]
    texts = [" ".join(rng.choice(words, rng.integers(0, 40))) for _ in range(60)] + [None, "", "..."]
    items = [(i, " ".join(rng.choice(words, n))) for i, n in enumerate([1, 2, 3, 4, 4, 5, 9, 12, 12])]
    items += [(9, items[4][1]), (10, None), (11, "!!")]
    docs = docs_frame(spark, list(enumerate(texts)))
    bench = spark.createDataFrame(items, ITEMS)
    want = plain(texts, items, 4)
    for options in ({}, {"shard_words": 30}, {"block_bytes": 40}):
        got = d.find_benchmark(docs, bench, "f", window=4, **options)
        got = got.select("doc_id", "f.n_words", d.hit_words("f.spans").alias("n"), F.array_sort("f.items").alias("i"))
        assert [tuple(r)[1:] for r in sorted(got.collect())] == want, options


def test_longest_matches(spark):
    item = " ".join(f"b{i}" for i in range(30))
    parts = item.split()
    docs = docs_frame(spark, [(1, "x " + " ".join(parts[3:15])), (2, "y z " + " ".join(parts[10:29])), (3, "b1 b2")])
    got = d.longest_matches(docs, spark.createDataFrame([(7, item), (8, "q " * 12)], ITEMS))
    assert rows(got) == [("7", 10, 19, 2, 2)]
    named = docs.selectExpr("concat('doc-', doc_id) AS doc_id", "text")
    got = d.longest_matches(named, spark.createDataFrame([(7, item)], ITEMS))
    assert rows(got) == [("7", 10, 19, "doc-2", 2)]
    assert d.longest_matches(named, spark.createDataFrame([], ITEMS)).count() == 0


def test_odd_rows(spark):
    docs = odd_docs(spark, ["found", "_found", "items", "spans"])
    bench = spark.createDataFrame([(1, "Two, THREE"), (None, "four five"), (2, None), (2, "")], ITEMS)
    got = rows(d.contamination(docs, bench), "doc_id", "n_words", "n_hit", "n_items", "contaminated")
    assert got.count((1, 5, 4, 1, True)) == 2
    assert (None, 5, 4, 1, True) in got and (None, 0, 0, 0, False) in got
    assert (5, 60_000, 0, 0, False) in got
    assert (7, 5, 0, 0, False) in got
    kept = d.remove_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert kept.count() == docs.count() - 3
    assert d.contamination(no_docs(spark), bench).count() == 0
    nothing = d.contamination(docs, bench.limit(0))
    assert nothing.filter("contaminated").count() == 0 and nothing.count() == docs.count()


def test_item_digest(spark):
    docs = docs_frame(spark, [(1, "a b c d")])
    bench = spark.createDataFrame([(10, "a b"), (9, "c d"), (10, "b c")], ITEMS)
    got = d.contamination(docs, bench).first()
    want = hashlib.sha256(b"10,9").hexdigest()
    assert (got["n_items"], got["n_hit"], got["items_sha256"]) == (2, 4, want)


def test_suffix_array_is_in_order():
    rng = np.random.default_rng(1)
    ids = rng.integers(0, 4, 400).astype(np.int32)
    shard = d.Shard(ids, 1, 400)

    def suffix(p):
        tail = shard.text[p:]
        return tail[: np.flatnonzero(tail == 0)[0]].tolist()

    suffixes = [suffix(p) for p in shard.order]
    assert suffixes == sorted(suffixes)
    assert len(suffixes) == int((ids > 0).sum())


def test_tables_are_the_same_whatever_the_case(spark):
    docs, bench = table(spark, "documents"), table(spark, "benchmark")
    upper = docs.withColumn("text", F.translate("text", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    assert rows(d.contamination(docs, bench)) == rows(d.contamination(upper, bench))
