"""Exact duplicates against a dictionary of whole texts."""

import hashlib
import random
import re

import pytest

from colmask.llm.exact import OP13_SQL, QUERIES, ContentTable, drop_exact_duplicates, exact_duplicates, one_space
from tests.llm.helpers import SF_DIR, docs_frame, duck, no_docs, odd_docs, same_as_sql


def plain(rows):
    """``doc_id, keep_id, group_size, text_sha256`` of every row, by a dictionary."""
    groups = {}
    for i, text in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", text or ""), []).append(i)
    out = []
    for text, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        out += [(i, keep, len(ids), hashlib.sha256(text.encode()).hexdigest()) for i in ids]
    return sorted(out, key=repr)


def found(df):
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in df.collect()), key=repr)


def test_against_sql(spark):
    assert same_as_sql(QUERIES["op13_exact"](spark, SF_DIR), OP13_SQL, duck())


def test_one_space():
    for text in ("", " ", "\n\t", "a", " a", "a ", "\x0b a\x0c\r b \n", "a b\x1cc", "été 　 x"):
        assert one_space(text.encode()).decode() == re.sub(r"[\x20\x09-\x0D]+", " ", text)
    assert one_space(None) == b""


def test_table_compares_whole_contents():
    table = ContentTable()
    texts = [b"x%d" % i for i in range(3000)]
    for t in texts:
        slot = table.find(7, t)
        assert slot < 0
        table.add(~slot, 7 if len(table.contents) < 200 else hash(t) & 0xFFFF, t) if len(table.contents) < 200 else None
    assert [table.find(7, t) for t in texts[:200]] == list(range(200))
    assert table.find(7, b"other") < 0


# Small tables make every bucket overflow again and again, few hash bits make texts share buckets that no hash
# parts, and few buckets make the text go into folders first.
@pytest.mark.parametrize("limits", [
    {}, {"own_bytes": 2000, "bucket_bytes": 3000}, {"own_bytes": 1, "bucket_bytes": 6000, "hash_bits": 3},
    {"own_bytes": 1, "bucket_bytes": 8000, "most_buckets": 4},
])
def test_spills_until_buckets_fit(spark, limits):
    draw = random.Random(5)
    texts = [" ".join(draw.choices("abcdefgh", k=draw.randint(1, 4))) for _ in range(300)]
    rows = [(i, t.replace(" ", draw.choice([" ", "  ", "\n"]))) for i, t in enumerate(texts)]
    rows += [(1000 + i, "the same\ttext") for i in range(200)] + [(2000, "long " * 3000), (2001, "long  " * 3000)]
    draw.shuffle(rows)
    docs = docs_frame(spark, rows).repartition(6)
    got = exact_duplicates(docs, **limits)
    assert found(got) == plain(rows)
    kept = [r for r in got.collect() if r.kept]
    assert len(kept) == len({r.text_sha256 for r in kept}) and all(r.doc_id == r.keep_id for r in kept)


def test_odd_rows(spark):
    docs = odd_docs(spark, extra=("row", "rep", "hash", "_row", "_keep"))
    got = exact_duplicates(docs)
    assert found(got) == plain([(r.doc_id, r.text) for r in docs.collect()])
    assert sum(r.kept for r in got.collect()) == len({r.text_sha256 for r in got.collect()})
    left = drop_exact_duplicates(docs)
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == [1, 2, 4, 5, 6, 7]


def test_empty(spark):
    assert exact_duplicates(no_docs(spark)).collect() == []
    assert drop_exact_duplicates(no_docs(spark)).collect() == []


def test_text_ids(spark):
    docs = spark.createDataFrame([("b", "x"), ("a", "x"), (None, "x"), ("c", "y")], "doc_id string, text string")
    assert {(r.doc_id, r.keep_id, r.kept) for r in exact_duplicates(docs).collect()} == {
        ("b", "a", False), ("a", "a", True), (None, "a", False), ("c", "c", True),
    }
