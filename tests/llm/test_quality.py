import numpy as np
from pyspark.sql import functions as F

from colmask.llm import quality as q
from tests.llm.helpers import no_docs, odd_docs

SF_DIR = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    got = q.op2_quality(spark, SF_DIR).join(labels, "doc_id").filter("held_out").collect()
    good = [r for r in got if r["quality"] == 1]
    bad = [r for r in got if r["quality"] == 0]
    assert len(bad) > 50
    assert sum(r["predicted"] for r in good) >= 0.99 * len(good)
    assert sum(1 - r["predicted"] for r in bad) >= 0.95 * len(bad)
    assert all(0 <= r[c] <= 1 for r in got for c in ("score", "text_score", "metadata_score"))


def two_views(n, seed, flip=0.0):
    rng = np.random.default_rng(seed)
    y = rng.integers(0, 2, n).astype(float)
    side = 2 * y - 1
    one = np.column_stack([side + rng.normal(size=n) * 0.7, rng.normal(size=n)])
    two = np.column_stack([side + rng.normal(size=n) * 0.7, rng.normal(size=(n, 20))])
    if flip:
        y = np.where(rng.random(n) < flip, 1 - y, y)
    return [one, two], y


def from_arrays(pool):
    """The surest rows of arrays, one by one; keys are places."""
    def draw(views, most, taken):
        out = []
        for v, view in enumerate(views):
            chance = q.sigmoid(view.log_odds(pool[v])) if len(pool[v]) else np.zeros(0)
            picks = []
            for label, sure in ((1.0, chance), (0.0, 1 - chance)):
                best = [i for i in sorted(range(len(sure)), key=lambda i: (-sure[i], i)) if sure[i] >= q.SURE and i not in taken[v]]
                picks += [(i, label, pool[0][i], pool[1][i]) for i in best[: most[label]]]
            out.append(picks)
        return out

    return draw


def co_train(x, y, check, pool):
    every = [np.concatenate([a, b]) for a, b in zip(x, pool)]
    return q.co_train(x, y, check, [(e.mean(axis=0), e.std(axis=0) + 1e-6) for e in every], from_arrays(pool))


def accuracy(model, x, y):
    return float(((model.scores(x)[2] >= 0.5) == (y > 0.5)).mean())


def test_views_teach_each_other():
    x, y = two_views(60, 1)
    pool, _ = two_views(2000, 2)
    test, truth = two_views(4000, 3)
    check = np.arange(60) % 3 == 0
    with_pool = co_train(x, y, check, pool)
    alone = co_train(x, y, check, [p[:0] for p in pool])
    assert sum(map(sum, with_pool.exchanged)) > 300
    assert alone.exchanged == ((0, 0),)
    assert accuracy(with_pool, test, truth) > accuracy(alone, test, truth)
    assert accuracy(with_pool, test, truth) > 0.93


def test_both_views_are_better_than_one_and_calibrated():
    x, y = two_views(1500, 4, flip=0.1)
    model = co_train(x, y, np.arange(1500) % 5 == 0, two_views(500, 5)[0])
    test, truth = two_views(6000, 6, flip=0.1)
    both, one, two = (accuracy_of(s, truth) for s in reversed(model.scores(test)))
    assert both > max(one, two) - 0.002
    scores = model.scores(test)[2]
    for low in (0.0, 0.8):
        part = (scores >= low) & (scores < low + 0.2)
        assert abs(scores[part].mean() - truth[part].mean()) < 0.08


def accuracy_of(scores, truth):
    return float(((scores >= 0.5) == (truth > 0.5)).mean())


def test_a_view_that_knows_nothing_is_not_followed():
    x, y = two_views(900, 7)
    rng = np.random.default_rng(8)
    noise = [x[0], rng.normal(size=(900, 3))]
    model = co_train(noise, y, np.arange(900) % 5 == 0, [two_views(300, 9)[0][0], rng.normal(size=(300, 3))])
    assert all(by_metadata == 0 for _, by_metadata in model.exchanged)
    test, truth = two_views(3000, 10)
    odd = [test[0], rng.normal(size=(3000, 3)) * 5]
    assert accuracy(model, odd, truth) > 0.9


def test_odd_rows(spark):
    docs = odd_docs(spark, ["quality", "score", "one"])
    labels = spark.createDataFrame([(1, 1), (3, 0), (5, 1), (6, 0), (None, 0)], "doc_id bigint, quality int")
    got = q.quality_scores(docs, labels)
    assert got.count() == docs.count()
    assert got.filter("score IS NULL OR score < 0 OR score > 1").count() == 0
    assert q.quality_scores(no_docs(spark), labels.limit(0)).count() == 0
    bare = q.quality_scores(docs.select("doc_id", "text"), labels.limit(0))
    assert bare.select(F.min("predicted")).first()[0] == 1


def test_rounds_against_a_plain_version(spark, monkeypatch):
    """Spark draws from all documents, in each round, what a plain loop over their features draws."""
    monkeypatch.setattr(q, "ROUND_ROWS", 12)
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    docs = docs.unionByName(docs.limit(300)).repartition(5)
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    features = q.quality_features(docs)
    drawn = []

    def noting(draw):
        def run(*given):
            drawn.append([[p[:2] for p in part] for part in draw(*given)])
            return draw(*given)
        return run

    surest = q.surest
    monkeypatch.setattr(q, "surest", lambda *given: noting(surest(*given)))
    got = q.train_quality(features, labels)

    rows = {}
    for r in features.collect():
        rows.setdefault(r["doc_id"], (r["held"], r["key"], bytes(r["one"]), bytes(r["two"])))
    known = {r["doc_id"]: float(r["quality"] != 0) for r in labels.collect() if r["quality"] is not None}
    mine = sorted((i for i in known if i in rows and not rows[i][0]), key=lambda i: (q.zlib.crc32(str(i).encode()), i))
    x = [q._table([rows[i][2 + v] for i in mine], v) for v in (0, 1)]
    free = sorted({rows[i][1:] for i in rows if i not in known and not rows[i][0]})
    pool = [q._table([f[1 + v] for f in free], v) for v in (0, 1)]
    keys = [f[0] for f in free]
    every = [q._table([r[n] for r in features.collect()], v) for v, n in enumerate(("one", "two"))]
    frame = [(e.mean(axis=0), e.std(axis=0) + 1e-6) for e in every]
    plain, seen = from_arrays(pool), []

    def draw(views, most, taken):
        found = plain(views, most, [{keys.index(k) for k in t} for t in taken])
        out = [[(keys[i], *rest) for i, *rest in part] for part in found]
        seen.append([[p[:2] for p in part] for part in out])
        return out

    want = q.co_train(x, np.array([known[i] for i in mine]), np.arange(len(mine)) % 5 == 0, frame, draw)
    assert got.exchanged == want.exchanged and sum(map(sum, got.exchanged)) > 20
    assert [[set(p) for p in r] for r in drawn] == [[set(p) for p in r] for r in seen]
    assert all(np.allclose(a, b, atol=1e-6) for a, b in zip(got.scores(pool), want.scores(pool)))
