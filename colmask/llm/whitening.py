"""Whitening of embeddings along the leading eigenvectors of their covariance.

Sums and the centred covariance come from the executors. The eigenproblem has the
size of a vector, not of the table: Householder reflections make the matrix
tridiagonal, Sturm counts bisect for its leading eigenvalues, and inverse iteration, made orthogonal again
within clusters of eigenvalues, gives the components, which are broadcast to project all rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colmask.llm.learning import sum_batch, summed_rows
from colmask.session import stored

COMPONENTS = 4
#: Entries are multiples of 1/256.
STEPS_PER_UNIT = 256
#: Eigenvalues under this share of the largest count as no variance: rounding makes them, not the data.
LEAST_SHARE = 1e-12


def quantised(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """``vectors`` with ``_x``: the entries' floor(256 c) as 64-bit integers in one binary value, and ``_d``, their number.

    Rows whose vector is null or empty or has a null or non-finite entry, or one whose product leaves the 64-bit range, are dropped.
    """
    at = vectors.columns.index(vector)
    schema = vectors.select("*", F.lit(b"").alias("_x"), F.lit(0).alias("_d")).schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(at)
            flat = lists.flatten().cast(pa.float64())
            # Null lists may hide entries: sizes come from the list itself.
            sizes = np.array([0 if n is None else n for n in lists.value_lengths().to_pylist()], np.int64)
            ends = np.cumsum(sizes)
            values = flat.to_numpy(zero_copy_only=False) * STEPS_PER_UNIT
            # A null entry comes out as NaN.
            fine = np.concatenate([[0], np.cumsum(~(np.abs(values) < 2.0**63))])
            good = (sizes > 0) & (fine[ends] == fine[ends - sizes])
            x = np.floor(np.where(np.abs(values) < 2.0**63, values, 0.0)).astype("<i8")
            rows = np.flatnonzero(good)
            kept = batch.take(pa.array(rows))
            held = [x[ends[i] - sizes[i] : ends[i]].tobytes() for i in rows]
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(held, pa.binary()), pa.array(sizes[rows], pa.int32())], names=[*batch.schema.names, "_x", "_d"]
            )

    return vectors.mapInArrow(run, schema)


def _matrix(column: pa.Array, d: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<i8").reshape(-1, d)


def moments(fit: DataFrame, d: int) -> tuple[int, np.ndarray, np.ndarray]:
    """The number of vectors in ``fit`` (column ``_x``), their exact sums, and their covariance, centred before multiplying."""
    sums_kind, cov_kind = "<i8", "<f8"

    def sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Sums of the high and low halves of entries do not overflow.
        n, low, high = 0, np.zeros(d, np.int64), np.zeros(d, np.int64)
        for batch in batches:
            x = _matrix(batch.column(0), d)
            n, low, high = n + len(x), low + (x & 0xFFFFFFFF).sum(axis=0), high + (x >> 32).sum(axis=0)
        if n:
            yield sum_batch([0, 1, 2], [np.array([n], sums_kind), low.astype(sums_kind), high.astype(sums_kind)])

    found = summed_rows(fit.select("_x").mapInArrow(sums, "i int, row binary"), sums_kind)
    if not found:
        return 0, np.zeros(d, object), np.zeros((d, d))
    n = int(found[0][0])
    total = found[1].astype(object) + found[2].astype(object) * (1 << 32)
    mean = np.array([int(s) / n for s in total])

    def products(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((d, d))
        for batch in batches:
            x = _matrix(batch.column(0), d) - mean
            held += x.T @ x
        yield sum_batch(list(range(d)), [r.astype(cov_kind) for r in held])

    rows = summed_rows(fit.select("_x").mapInArrow(products, "i int, row binary"), cov_kind)
    return n, total, np.stack([rows[i] for i in range(d)]) / n


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, off-diagonal and unit Householder vectors (rows) that make a symmetric matrix tridiagonal."""
    a = np.array(a, float)
    d = len(a)
    mirrors = np.zeros((max(0, d - 2), d))
    for j in range(d - 2):
        v = a[j + 1 :, j].copy()
        size = np.linalg.norm(v)
        if not np.any(v[1:]):
            continue
        v[0] += np.copysign(size, v[0])
        v /= np.linalg.norm(v)
        mirrors[j, j + 1 :] = v
        below = a[j + 1 :, j + 1 :]
        p = below @ v
        q = p - (v @ p) * v
        below -= 2 * (np.outer(v, q) + np.outer(q, v))
        a[j + 1, j] = a[j, j + 1] = -np.copysign(size, a[j + 1, j])
    return np.diag(a).copy(), np.diag(a, 1).copy() if d > 1 else np.zeros(0), mirrors


def smaller(diagonal: np.ndarray, off: np.ndarray, x: np.ndarray, tiny: float) -> np.ndarray:
    """The number of eigenvalues under each of ``x``: signs of the Sturm sequence of a tridiagonal matrix."""
    count = np.zeros(len(x), np.int64)
    q = np.ones(len(x))
    for i in range(len(diagonal)):
        q = diagonal[i] - x - (off[i - 1] ** 2 / q if i else 0.0)
        q = np.where(np.abs(q) < tiny, -tiny, q)
        count += q < 0
    return count


def leading_values(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest eigenvalues, falling, by bisection down to neighbouring doubles."""
    d = len(diagonal)
    reach = np.zeros(d)
    reach[:-1] += np.abs(off)
    reach[1:] += np.abs(off)
    low, high = np.full(k, (diagonal - reach).min()), np.full(k, (diagonal + reach).max())
    span = max(abs(low[0]), abs(high[0]))
    low, high = low - 1e-15 * span, high + 1e-15 * span
    tiny = max(np.finfo(float).tiny, (np.finfo(float).eps * max(span, 1e-300)) ** 2)
    wanted = d - np.arange(1, k + 1)  # eigenvalues under the one that is sought
    while True:
        middle = low + (high - low) / 2
        open_ = (middle > low) & (middle < high)
        if not open_.any():
            return middle
        over = smaller(diagonal, off, middle, tiny) > wanted
        high, low = np.where(open_ & over, middle, high), np.where(open_ & ~over, middle, low)


def _solve(diagonal: np.ndarray, off: np.ndarray, shift: float, b: np.ndarray, tiny: float) -> np.ndarray:
    """Solution of (T - shift) z = b by elimination with row exchanges; zero pivots become ``tiny``."""
    d = len(diagonal)
    a, u, w, b = diagonal - shift, np.append(off, 0.0), np.zeros(d), b.copy()
    for i in range(d - 1):
        lower = off[i]
        if abs(lower) > abs(a[i]):
            factor = a[i] / lower
            a[i], u[i], w[i], a[i + 1], u[i + 1] = lower, a[i + 1], u[i + 1], u[i] - factor * a[i + 1], -factor * u[i + 1]
            b[i], b[i + 1] = b[i + 1], b[i] - factor * b[i + 1]
        else:
            pivot = a[i] if abs(a[i]) > tiny else tiny
            a[i], factor = pivot, lower / pivot
            a[i + 1] -= factor * u[i]
            b[i + 1] -= factor * b[i]
    z = np.zeros(d)
    for i in range(d - 1, -1, -1):
        rest = b[i] - (u[i] * z[i + 1] if i + 1 < d else 0.0) - (w[i] * z[i + 2] if i + 2 < d else 0.0)
        z[i] = rest / (a[i] if abs(a[i]) > tiny else np.copysign(tiny, a[i]))
    return z


def leading_components(v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues of a symmetric matrix, falling, and unit eigenvectors as rows."""
    k = min(k, len(v))
    scale = np.abs(v).max(initial=0.0)
    if not k or scale == 0:
        return np.zeros(0), np.zeros((0, len(v)))
    diagonal, off, mirrors = tridiagonal(v / scale)
    values = leading_values(diagonal, off, k)
    size = np.abs(diagonal).max() + 2 * np.abs(off).max(initial=0.0)
    eps = np.finfo(float).eps
    draw = np.random.default_rng(0)
    found = np.zeros((k, len(v)))
    cluster = 0  # first of the eigenvalues that lie together
    for c in range(k):
        if c and values[c - 1] - values[c] > 1e-3 * size:
            cluster = c
        # Equal eigenvalues are moved apart a little, so that the iterations differ.
        shift = values[c] - (c - cluster) * 4 * eps * size
        z = draw.uniform(-1, 1, len(v))
        for _ in range(5):
            z = _solve(diagonal, off, shift, z / np.linalg.norm(z), eps * size)
            z /= np.linalg.norm(z)
            for _ in range(2):
                z -= found[cluster:c].T @ (found[cluster:c] @ z)
                z /= np.linalg.norm(z)
        found[c] = z
    for j in range(len(mirrors) - 1, -1, -1):
        found -= 2 * np.outer(found @ mirrors[j], mirrors[j])
    return values * scale, found / np.linalg.norm(found, axis=1)[:, None]


def _deviations(x: np.ndarray, n: int, total: np.ndarray) -> list[int | None]:
    """Exact sums of squares of n x - S; null beyond 64 bits."""
    most = n * max(abs(int(x.max())), abs(int(x.min()))) + max(abs(int(s)) for s in total) if x.size else 0
    if most * most * x.shape[1] < 1 << 63:
        return ((n * x - total.astype(np.int64)) ** 2).sum(axis=1).tolist()
    sums = (sum((n * int(e) - int(s)) ** 2 for e, s in zip(row, total)) for row in x)
    return [s if s < 1 << 63 else None for s in sums]


def whitened(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` of every row and leading component.

    Entries become x = floor(256 c). Each distinct x takes part once in the fit: n vectors with sums S. ``whitened`` is
    x - S/n projected on the unit eigenvector of the covariance over the root of its eigenvalue, ``explained`` the
    eigenvalue's share of all variance, ``deviation`` the exact sum of squares of n x - S (null beyond 64 bits) and
    ``identity_error`` the largest absolute entry of the fit's whitened covariance minus the identity.

    Rows with a null or empty vector or a null or non-finite entry are dropped, and so are those of
    another length than most distinct vectors have (the larger one of two as frequent). Components without variance are left out:
    equal vectors alone give an empty result, and so does an empty table. Repeated rows each get their
    rows, null ids stay null, other columns are not read.
    """
    spark = vectors.sparkSession
    rows = quantised(vectors.select(F.col(vec_id).alias("vec_id"), F.col(vector).alias("embedding"))).select("vec_id", "_x", "_d")
    schema = (
        f"vec_id {rows.schema['vec_id'].dataType.simpleString()}, component int, n bigint, deviation bigint, "
        "whitened double, explained double, identity_error double"
    )
    # A vector that many rows share is one row a task before it moves.
    fit = stored(rows.select("_x", "_d").distinct(), "fit")
    length = fit.groupBy("_d").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("_d")).first()
    d = length["_d"] if length else 0
    fit = fit.filter(F.col("_d") == d)
    n, total, v = moments(fit, d) if d else (0, np.zeros(0), np.zeros((0, 0)))
    values, vectors_ = leading_components(v, components)
    real = values > LEAST_SHARE * max(values.max(initial=0.0), 0.0)
    values, vectors_ = values[real], vectors_[real]
    if not len(values):
        return spark.createDataFrame([], schema)
    mean = np.array([int(s) / n for s in total])
    shared = spark.sparkContext.broadcast((mean, (vectors_ / np.sqrt(values)[:, None]).T, total))
    explained = values / np.trace(v)
    k = len(values)

    def project(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre, axes, _ = shared.value
        for batch in batches:
            y = (_matrix(batch.column(0), d) - centre) @ axes
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in y.T], names=[f"y{c}" for c in range(k)])

    y = stored(fit.select("_x").mapInArrow(project, ", ".join(f"y{c} double" for c in range(k))), "whitened-fit")
    centre = y.agg(*[F.avg(f"y{c}").alias(f"m{c}") for c in range(k)]).first()
    centred = [F.col(f"y{c}") - F.lit(centre[c]) for c in range(k)]
    pairs = [(a, b) for a in range(k) for b in range(a, k)]
    cov = y.agg(*[F.avg(centred[a] * centred[b]).alias(f"c{a}_{b}") for a, b in pairs]).first()
    error = max(abs(c - (a == b)) for c, (a, b) in zip(cov, pairs))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        middle, axes, sums = shared.value
        for batch in batches:
            x = _matrix(batch.column(1), d)
            if not len(x):
                continue
            projected = (x - middle) @ axes
            deviation = pa.array(_deviations(x, n, sums), pa.int64())
            each = pa.array(np.repeat(np.arange(len(x)), k))
            columns = [
                batch.column(0).take(each), pa.array(np.tile(np.arange(1, k + 1), len(x)), pa.int32()),
                pa.array(np.full(len(x) * k, n), pa.int64()), deviation.take(each), pa.array(projected.ravel()),
                pa.array(np.tile(explained, len(x))), pa.array(np.full(len(x) * k, float(error))),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.filter(F.col("_d") == d).select("vec_id", "_x").mapInArrow(run, schema)


def op11_whitening(spark, sf_dir: str) -> DataFrame:
    """Every embedding along the four leading components."""
    return whitened(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


QUERIES = {"op11_whitening": op11_whitening}
ORACLES: dict[str, str] = {}
