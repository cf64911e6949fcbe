"""Whitening against numpy's own eigenvectors and exact integers."""

import math

import numpy as np
import pytest

from colmask.llm.whitening import QUERIES, leading_components, leading_values, smaller, tridiagonal, whitened
from tests.llm.helpers import SF_DIR, table


def plain(rows, k=4):
    """``vec_id, component, n, deviation, whitened, explained`` by numpy, of one sign or the other."""
    good = [(i, [math.floor(256 * float(c)) for c in v]) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in good})
    n, total = len(fit), [sum(c) for c in zip(*fit)]
    x = np.array(fit, float) - np.array(total) / n
    values, vectors = np.linalg.eigh(x.T @ x / n)
    out = []
    for i, own in good:
        deviation = sum((n * e - s) ** 2 for e, s in zip(own, total))
        for c in range(min(k, int((values > 1e-9 * values[-1]).sum()))):
            y = (np.array(own) - np.array(total) / n) @ vectors[:, -1 - c] / math.sqrt(values[-1 - c])
            out.append((i, c + 1, n, deviation, y, values[-1 - c] / values.sum()))
    return out


def agree(df, want):
    got = df.collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1], abs(r[4]))
    got, want = sorted(got, key=key), sorted(want, key=key)
    assert [tuple(r[:4]) for r in got] == [r[:4] for r in want]
    signs = {}
    for g, w in zip(got, want):
        if abs(w[4]) > 1e-3:
            signs.setdefault(w[1], set()).add(g[4] * w[4] > 0)
        assert abs(abs(g[4]) - abs(w[4])) < 1e-8 * max(1, abs(w[4]))
        assert abs(g[5] - w[5]) < 1e-10
        assert g[6] < 1e-9
    assert all(len(s) == 1 for s in signs.values())
    return got


def frame(spark, rows):
    made = [(i, v, 1, 1, b"") for i, v in rows]
    return spark.createDataFrame(made, "vec_id bigint, embedding array<float>, component int, n int, _x binary")


def test_whole_table(spark):
    rows = [(r.vec_id, r.embedding) for r in table(spark, "embeddings").collect()]
    assert agree(QUERIES["op11_whitening"](spark, SF_DIR), plain(rows))


def test_odd_rows(spark):
    draw = np.random.default_rng(2)
    rows = [(i, draw.normal(size=6).tolist()) for i in range(200)]
    rows += [rows[0]] * 150 + [(None, rows[1][1]), (900, None), (901, []), (902, [1.0] * 5 + [None]), (903, [math.nan] * 6)]
    rows += [(904, [math.inf] + [0.0] * 5), (905, [-0.0] * 6), (906, [0.0] * 6), (907, [-1e-9] * 6)]
    assert agree(whitened(frame(spark, rows).repartition(7)), plain(rows))
    other = frame(spark, rows + [(908, [1.0, 2.0])])
    assert {r.vec_id for r in whitened(other).collect()} == {r[0] for r in plain(rows)}


def test_little_or_no_variance(spark):
    assert whitened(frame(spark, [])).collect() == []
    assert whitened(frame(spark, [(1, None), (2, [])])).collect() == []
    assert whitened(frame(spark, [(1, [0.5, 0.5]), (2, [0.5, 0.5])])).collect() == []
    rows = [(i, [float(i), 2.0 * i, 1.0]) for i in range(9)]
    got = agree(whitened(frame(spark, rows)), plain(rows))
    assert {r.component for r in got} == {1}


def test_large_deviations_are_exact(spark):
    rows = [(i, [float(i * 2**10), 0.25]) for i in range(40)]
    agree(whitened(frame(spark, rows)), plain(rows))
    far = whitened(frame(spark, [(i, [float(i) * 2.0**50, 0.25]) for i in range(9)])).collect()
    assert {r.deviation for r in far} == {None, 0} and len(far) == 9


@pytest.mark.parametrize("d", [1, 2, 3, 17, 64])
@pytest.mark.parametrize("kind", ["random", "clusters", "equal", "rank one"])
def test_components(d, kind):
    draw = np.random.default_rng(d)
    q, _ = np.linalg.qr(draw.normal(size=(d, d)))
    spectrum = {
        "random": draw.uniform(0, 1e6, d), "clusters": np.where(np.arange(d) < 3, 5 + 1e-13 * np.arange(d), 1.0),
        "equal": np.full(d, 3.0), "rank one": np.eye(d)[0] * 7,
    }[kind]
    v = q @ np.diag(spectrum) @ q.T
    v = (v + v.T) / 2
    values, vectors = leading_components(v, 4)
    size = np.abs(spectrum).max()
    assert np.allclose(values, np.sort(spectrum)[::-1][:4], atol=1e-13 * size * d, rtol=0)
    assert np.abs(vectors @ vectors.T - np.eye(len(values))).max() < 1e-13 * d
    assert np.abs(v @ vectors.T - vectors.T * values).max() < 1e-13 * size * d


def test_sturm_counts():
    draw = np.random.default_rng(9)
    a = draw.normal(size=(12, 12))
    a = a + a.T
    diagonal, off, _ = tridiagonal(a)
    values = np.linalg.eigvalsh(a)
    assert np.allclose(np.linalg.eigvalsh(np.diag(diagonal) + np.diag(off, 1) + np.diag(off, -1)), values)
    x = draw.uniform(-8, 8, 50)
    assert smaller(diagonal, off, x, 1e-30).tolist() == [(values < y).sum() for y in x]
    assert np.allclose(leading_values(diagonal, off, 12), values[::-1])
