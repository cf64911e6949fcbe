import re

import numpy as np
import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F

from colmask.llm import simhash
from colmask.llm.components import components
from tests.conftest import rows
from colmask.session import work_root
from tests.llm.helpers import SF_DIR, docs_frame, no_docs, odd_docs, table


def plain_fingerprint(text, n=3):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_roots(prints, radius=3):
    """Smallest reachable index of each fingerprint."""
    roots = list(range(len(prints)))

    def find(x):
        while roots[x] != x:
            x = roots[x]
        return x

    values = np.array(prints, np.uint64)
    for i in range(len(prints)):
        for j in np.flatnonzero(np.bitwise_count(values[:i] ^ values[i]) <= radius):
            a, b = sorted((find(i), find(int(j))))
            roots[b] = a
    return [find(i) for i in range(len(prints))]


def test_query_against_all_pairs(spark):
    docs = sorted(table(spark, "documents").collect(), key=lambda r: r["doc_id"])
    prints = [plain_fingerprint(r["text"]) for r in docs]
    roots = plain_roots(prints)
    want = {r["doc_id"]: (format(p, "016x"), docs[root]["doc_id"]) for r, p, root in zip(docs, prints, roots)}
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.op1_simhash(spark, SF_DIR).collect()}
    assert got == want
    assert len({c for _, c in want.values()}) < len(want)


@pytest.mark.parametrize("home_rows, guest_rows", [(4096, 65536), (2, 3), (7, 10_000)])
def test_dense_group_and_split_tiles(spark, home_rows, guest_rows):
    rng = np.random.default_rng(5)
    center = int(rng.integers(1 << 63))
    near = {center} | {center ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 63, (150, 2)) if a != b}
    far = {int(x) for x in rng.integers(0, 1 << 63, 150)}
    chain = [int(rng.integers(1 << 62))]
    for step in range(20):
        chain.append(chain[-1] ^ (7 << 3 * step))
    prints = sorted(near | far | set(chain))
    frame = spark.createDataFrame([(p,) for p in prints], "print bigint")
    links = simhash.link_fingerprints(frame, 3, home_rows, guest_rows)
    assert links.count() < 40 * len(prints)
    got = dict(tuple(r) for r in components(links).collect())
    want = plain_roots(prints)
    assert [got.get(p, p) for p in prints] == [prints[r] for r in want]
    assert len(set(want)) < len(prints) - 100


def test_components_of_long_paths_and_hubs(spark):
    path = [(i, i + 1) for i in range(0, 60)]
    hub = [(1000, 1001 + i) for i in range(300)] + [(1000 + 300, 999)]
    links = spark.createDataFrame(path + hub + [(5, 5), (None, 7), (61, 61)], "a bigint, b bigint")
    got = dict(tuple(r) for r in components(links).collect())
    assert all(got[i] == 0 for i in range(61))
    assert {got[1000 + i] for i in range(301)} == {999}
    assert 61 not in got
    assert components(links.limit(0)).count() == 0


def test_odd_rows(spark):
    docs = odd_docs(spark, ["print", "component_id", "root", "Fingerprint"])
    got = rows(simhash.near_duplicates(docs))
    short = format(plain_fingerprint("one two three four five"), "016x")
    by_id = {}
    for doc_id, fingerprint, component in got:
        by_id.setdefault(doc_id, []).append((fingerprint, component))
    assert by_id[1] == [(short, 1)] * 2
    assert (short, 1) in by_id[None]
    assert by_id[2] == by_id[3] == by_id[4] == [("0" * 16, 2)]
    assert ("0" * 16, 2) in by_id[None]
    long = docs.filter("doc_id = 5").first()["text"]
    assert by_id[5] == [(format(plain_fingerprint(long), "016x"), 5)]
    assert by_id[6][0][1] == 5
    assert len(got) == docs.count()
    assert simhash.near_duplicates(no_docs(spark)).count() == 0


def test_one_row_of_each_group_stays(spark):
    docs = odd_docs(spark, ["_print", "_ROW", "_keep"])
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 2, 5, 7]
    only_null = docs_frame(spark, [(None, "a b c d"), (None, "a b c d")])
    assert simhash.drop_near_duplicates(only_null).count() == 1
    assert simhash.drop_near_duplicates(no_docs(spark)).count() == 0


def test_pieces_of_a_long_text_add_up(monkeypatch):
    text = " ".join(f"word{i * i % 101}" for i in range(500))
    whole = simhash.simhash(text.encode())
    monkeypatch.setattr(simhash, "_SHINGLES_AT_ONCE", 7)
    assert simhash.simhash(text.encode()) == whole
    assert whole & (1 << 64) - 1 == plain_fingerprint(text)


def test_spark_hash_is_the_same(spark):
    got = spark.range(1).select(F.xxhash64(F.lit("a b c"))).first()[0]
    assert got & (1 << 64) - 1 == xxhash.xxh64_intdigest(b"a b c", 42)


def test_copies_of_spread_fingerprints_stay_near_the_tiles(spark):
    """200,000 random fingerprints: a copy for each tile around, whatever the number of fingerprints."""
    draw = np.random.default_rng(4)
    prints = np.unique(draw.integers(-(1 << 63), 1 << 63, 200_000, dtype=np.int64))
    spark.createDataFrame(pd.DataFrame({"print": prints})).write.mode("overwrite").parquet(f"{work_root(spark)}/random")
    frame = spark.read.parquet(f"{work_root(spark)}/random")
    few = simhash.placed_fingerprints(frame.limit(20_000), 3, simhash.HOME_ROWS, simhash.GUEST_ROWS).count() / 20_000
    whole = simhash.placed_fingerprints(frame, 3, simhash.HOME_ROWS, simhash.GUEST_ROWS).count() / len(prints)
    # Lots that hold as large a part of a tile as a million does at 1e9 fingerprints.
    scaled = simhash.placed_fingerprints(frame, 3, 210, 210).count() / len(prints)
    assert few <= 65 and whole <= 65 and scaled <= 4 * 65
