"""Ranked search against SQL and against plain sums over all pairs."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from colmask.llm.ranked import OP12_SQL, QUERIES, Search, ranked_search
from tests.llm.helpers import SF_DIR, docs_frame, duck, no_docs, odd_docs, same_as_sql


def plain(docs, items, k):
    """All scores, one by one."""
    def terms(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))

    bags = [(i, Counter(terms(t))) for i, t in docs]
    n_docs, n_words = sum(bool(b) for _, b in bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item_id, text in items:
        scores = []
        for doc_id, bag in bags:
            score = 0
            for t in set(terms(text)) & set(bag):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                m = 50 + (50 * sum(bag.values()) * n_docs) // n_words
                score += w * ((10**9 * bag[t]) // (1000 * bag[t] + 20 * m))
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item_id, r, s[3], -s[0]) for r, s in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


def found(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, df.collect()), key=repr)


def bench_frame(spark, rows):
    return spark.createDataFrame(rows, "item_id string, text string, item int, rank int")


def test_against_sql(spark):
    assert same_as_sql(QUERIES["op12_ranked"](spark, SF_DIR), OP12_SQL, duck())


@pytest.mark.parametrize("limits", [{}, {"block_items": 3, "tree_entries": 40}, {"block_bytes": 1, "k": 3}, {"k": 400}])
def test_against_all_pairs(spark, limits):
    draw = random.Random(3)
    words = [f"w{int(draw.expovariate(0.05))}" for _ in range(4000)]
    docs = [(i, " ".join(draw.choices(words, k=draw.randint(1, 30))) + draw.choice(["", ".", " W7"])) for i in range(300)]
    docs += [(1000 + i, "w1 w2 w3") for i in range(80)] + [(1000, "w1 w2 w3"), (None, "w1 w2 w3"), (2000, None), (2001, " .,")]
    draw.shuffle(docs)
    items = [(f"i{i}", " ".join(draw.choices(words, k=6)), 1, 1) for i in range(8)]
    items += [("same", "W1 w2-w3", 1, 1), ("same", "W1 w2-w3", 1, 1), (None, "w9", 1, 1), ("none", None, 1, 1), ("unknown", "zz", 1, 1)]
    got = ranked_search(docs_frame(spark, docs, extra=("item", "score")).repartition(5), bench_frame(spark, items), **limits)
    assert found(got) == plain(docs, [i[:2] for i in items], limits.get("k", 50))


def test_odd_rows(spark):
    docs = odd_docs(spark)
    items = [("a", "one W1 été", 1, 1), ("long", " ".join(f"w{i % 1500}" for i in range(200_000)), 1, 1), ("e", "", 1, 1)]
    want = plain([(r.doc_id, r.text) for r in docs.collect()], [i[:2] for i in items], 50)
    assert found(ranked_search(docs, bench_frame(spark, items))) == want


def test_empty(spark):
    one = bench_frame(spark, [("a", "x", 1, 1)])
    assert found(ranked_search(no_docs(spark), one)) == []
    assert found(ranked_search(docs_frame(spark, [(1, "x")]), one.limit(0))) == []
    assert found(ranked_search(docs_frame(spark, [(1, None)]), one)) == []


@pytest.mark.parametrize("least", [False, True])
def test_bounds_leave_out_batches_but_no_result(least):
    draw = np.random.default_rng(1)
    n_terms, n_docs, k = 400, 3000, 5
    weights = draw.integers(1, 1000, n_terms)
    # Documents and items keep to one of twenty topics.
    docs = [np.unique(draw.integers(0, 20, 8) + 20 * draw.integers(0, 20)) for _ in range(n_docs)]
    items = [np.unique(draw.integers(0, 20, 6) + 20 * draw.integers(0, 20)) for _ in range(100)]
    values = [weights[d] * draw.integers(1, 20, len(d)) for d in docs]
    dense = np.zeros((n_docs, n_terms), np.int64)
    for i, (d, v) in enumerate(zip(docs, values)):
        dense[i, d] = v
    want = {}
    for i, t in enumerate(items):
        scores = dense[:, t].sum(axis=1)
        want[i] = [(d, scores[d]) for d in np.lexsort((np.arange(n_docs), -scores))[:k] if scores[d] > 0]
    known = np.array([want[i][-1][1] for i in range(100)]) if least else None
    search = Search(items, weights, k, known, leaf=8, fan=4)
    for part in (slice(0, 1800), slice(1800, n_docs)):
        search.add(list(range(n_docs))[part], np.array([len(d) for d in docs[part]]), np.concatenate(docs[part]), np.concatenate(values[part]))
    got = {}
    for item, doc, score in search.best():
        got.setdefault(item, []).append((doc, score))
    assert {i: sorted(g, key=lambda x: (-x[1], x[0])) for i, g in got.items()} == want
    assert search.scored < 100 * n_docs / 4
