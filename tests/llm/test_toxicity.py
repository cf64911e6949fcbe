import itertools
import zlib

import numpy as np
from pyspark.sql import functions as F

from colmask.llm import toxicity as t
from tests.llm.helpers import docs_frame, no_docs, odd_docs

SF_DIR = "/root/testdata/sf0.01"


def test_marginals_against_all_labellings():
    rng = np.random.default_rng(0)
    moves = rng.normal(size=(2, 2))
    texts = [rng.normal(size=n) * 3 for n in (1, 4, 0, 6, 3, 6)]
    got, pairs = t.marginals(texts, moves, pairs=True)
    want_pairs = np.zeros((2, 2))
    for emissions, chances in zip(texts, got):
        total, sums, seen = 0.0, np.zeros(len(emissions)), np.zeros((2, 2))
        for labels in itertools.product((0, 1), repeat=len(emissions)):
            weight = np.exp(sum(e for e, y in zip(emissions, labels) if y) + sum(moves[a, b] for a, b in zip(labels, labels[1:])))
            total += weight
            sums += weight * np.array(labels)
            for a, b in zip(labels, labels[1:]):
                seen[a, b] += weight
        assert np.allclose(chances, sums / total)
        want_pairs += seen / total
    assert np.allclose(pairs, want_pairs)


def test_groups_of_any_size_give_the_same(monkeypatch):
    rng = np.random.default_rng(1)
    texts = [rng.normal(size=int(n)) for n in rng.integers(0, 50, 40)]
    moves = rng.normal(size=(2, 2))
    whole = t.marginals(texts, moves)
    monkeypatch.setattr(t, "PADDED", 7)
    assert all(np.allclose(a, b) for a, b in zip(whole, t.marginals(texts, moves)))


def made_corpus(spark, n=400):
    """Toxic texts have forms of ``grub``; ``filler`` words are of all kinds."""
    rng = np.random.default_rng(2)
    filler = [f"{a}{b}" for a in ("lor", "ips", "dol", "amet", "con", "sec") for b in ("um", "em", "or", "is", "it", "us", "ad")]
    rows, labels = [], []
    for i in range(n):
        words = list(rng.choice(filler, 40))
        toxic = i % 4 == 0
        if toxic:
            for _ in range(3):
                words.insert(int(rng.integers(0, 40)), f"Grub{rng.choice(['ber', 'o', 'ish', 'len', 'a'])}" + ",")
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    return docs_frame(spark, rows), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_learns_a_beginning_and_gives_its_offsets(spark):
    docs, labels = made_corpus(spark)
    field = t.train_field(docs, labels)
    new = docs_frame(spark, [(1, "lorum été \U0001f600 grubzz, grubyy ipsem"), (2, "lorum ipsem dolor"), (3, None), (4, "")])
    got = {r["doc_id"]: r for r in t.score_texts(new, field, "score", "spans").collect()}
    text = got[1]["text"]
    assert got[1]["score"] > 0.5 and [text[s["start"] : s["stop"]] for s in got[1]["spans"]] == ["grubzz, grubyy"]
    for i in (2, 3, 4):
        assert got[i]["score"] < 0.5 and got[i]["spans"] == []
    assert got[3]["score"] == got[4]["score"]


def test_sample_is_drawn_from_texts_that_can_take_part(spark, monkeypatch):
    """Most toxic labels belong to documents that are not there, to copies of one text, or to texts over the whole sample."""
    monkeypatch.setattr(t, "TOXIC_SAMPLE", 40)
    monkeypatch.setattr(t, "CLEAN_SAMPLE", 120)
    monkeypatch.setattr(t, "SAMPLE_CHARS", 29_000)
    docs, labels = made_corpus(spark)
    more = [(1000 + i, "one text of no sign") for i in range(300)] + [(2000 + i, f"{i} " + "ipsem " * 5000) for i in range(100)]
    toxic = [(i, 1, 1) for i, _ in more] + [(3000 + i, 1, 1) for i in range(600)]
    docs, labels = docs.unionByName(docs_frame(spark, more)), labels.unionByName(spark.createDataFrame(toxic, labels.schema))
    field = t.train_field(docs, labels)
    new = docs_frame(spark, [(1, "lorum grubzz, grubyy ipsem"), (2, "lorum ipsem dolor")])
    got = {r["doc_id"]: r["score"] for r in t.score_texts(new, field, "score", "spans").collect()}
    assert got[1] > 0.5 and got[1] > got[2] and any(w.endswith(b"gru") for w in field.weights)


def test_held_out_accuracy(spark):
    docs, labels = made_corpus(spark)
    got = t.toxicity(docs, labels).join(labels, "doc_id").filter("held_out").collect()
    assert len(got) > 50
    assert all(r["predicted"] == r["toxic"] for r in got)
    assert {r["doc_id"] for r in got} == {i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 0}


def test_query(spark):
    got = t.op7_toxicity(spark, SF_DIR)
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    assert got.filter("score < 0 OR score > 1 OR predicted <> int(score >= 0.5)").count() == 0
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    clean = got.join(labels, "doc_id").filter("toxic = 0")
    assert clean.filter("predicted = 1").count() <= 0.02 * clean.count()


def test_held_out_labels_change_nothing(spark):
    docs, labels = made_corpus(spark)
    turned = labels.withColumn("toxic", F.when(t.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, two = (t.toxicity(docs, x).select("doc_id", "score").collect() for x in (labels, turned))
    assert sorted(one) == sorted(two)


def test_without_labels_of_both_kinds(spark):
    docs, labels = made_corpus(spark, 40)
    for few in (labels.limit(0), labels.filter("toxic = 0"), labels.withColumn("toxic", F.lit(None).cast("int"))):
        got = t.toxicity(docs, few).select("score", "predicted").distinct().collect()
        assert len(got) == 1 and got[0]["predicted"] == 0


def test_odd_rows(spark):
    docs = odd_docs(spark, ["score", "spans", "_score", "_SPANS", "toxic", "is_toxic"])
    labels = spark.createDataFrame([(1, 1, 1), (1, 1, 0), (None, 1, 1), (3, 0, 0), (5, 0, 0)], "doc_id bigint, quality int, toxic int")
    got = t.toxicity(docs, labels)
    assert got.count() == docs.count()
    assert {r["held_out"] for r in got.filter("doc_id IS NULL").collect()} == {True}
    kept = t.drop_toxic(docs, labels)
    assert kept.columns == docs.columns
    assert t.toxicity(no_docs(spark), labels).count() == 0
    assert t.drop_toxic(no_docs(spark), labels.limit(0)).count() == 0


def test_score_does_not_grow_with_a_clean_text(spark):
    docs, labels = made_corpus(spark)
    words = " ".join(r["text"] for r in docs.join(labels, "doc_id").filter("toxic = 0").collect()).split()
    sizes = (1000, 20_000, 100_000, 1_000_000)
    long = [(n, " ".join((words * (n // len(words) + 1))[:n])) for n in sizes]
    toxic = [(-n, text + " grubber grubo, grubish" * 3) for n, text in long[:2]]
    field = t.train_field(docs, labels)
    got = {r["doc_id"]: r for r in t.score_texts(docs_frame(spark, long + toxic), field, "score", "spans").collect()}
    assert all(got[n]["score"] < 0.5 for n in sizes)
    assert all(got[-n]["score"] > 0.5 and got[-n]["spans"] for n in sizes[:2])


def test_signs_allow_for_chance():
    base = 1e-4
    assert t.document_signs([np.full(1_000_000, 0.01)], base).tolist() == [[0.01, 0.0]]
    some = np.where(np.arange(1_000_000) % 10_000 == 0, 0.9, 0.01)  # as many words as by chance
    assert t.document_signs([some], base)[0, 1] == 0
    assert t.document_signs([some[:100], np.zeros(0)], base)[:, 1].tolist()[1] == 0
    assert t.document_signs([some[:100]], base)[0, 1] > 0


def test_no_document_is_toxic_without_a_span(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    got = t.toxicity(docs, spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    assert got.filter("predicted = 1 AND size(spans) = 0").count() == 0


def test_long_labelled_texts_take_part(spark):
    docs, labels = made_corpus(spark, 200)
    longer = docs.withColumn("text", F.concat_ws(" ", "text", F.repeat(F.lit("lorum ipsem "), 3000)))
    field = t.train_field(longer, labels)
    new = docs_frame(spark, [(1, "lorum grubzz, grubyy ipsem"), (2, "lorum ipsem dolor")])
    got = {r["doc_id"]: r["score"] for r in t.score_texts(new, field, "score", "spans").collect()}
    assert got[1] > 0.5 > got[2]


def test_memory_of_remembered_words_is_bounded():
    field = t.Field({b"wa": 1.0}, -1.0, np.zeros((2, 2)), (0.0, 1.0, 1.0))
    emissions = t.Emissions(field, 10_000)
    for i in range(40):
        words = [b"w%d" % (i * 50 + j) for j in range(50)] + [b"x" * 70, b"a", b"a"]
        assert emissions(words).tolist() == [np.float32(field.emission(w)) for w in words]
        assert emissions.size <= 10_000 and max(map(len, emissions.known), default=0) <= t.CACHE_WORD
