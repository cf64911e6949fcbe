"""Helpers of the trained operators."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that are never learned from: the checksum of the id as text leaves no remainder by 5. Null counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 0


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float) -> np.ndarray:
    """Weighted logistic regression with a ridge, by Newton's method; the bias comes first.

    ``y`` may be shares between 0 and 1. The ridge is per unit of mean weight.
    """
    x = np.column_stack([np.ones(len(x)), x])
    beta = np.zeros(x.shape[1])
    penalty = np.diag([1e-6] + [ridge] * (x.shape[1] - 1)) * weight.sum() / len(weight)
    for _ in range(30):
        p = sigmoid(x @ beta)
        slope = x.T @ (weight * (y - p)) - penalty @ beta
        bend = (x * (weight * p * (1 - p))[:, None]).T @ x + penalty
        move = np.clip(np.linalg.solve(bend, slope), -5, 5)
        beta += move
        if np.abs(move).max() < 1e-6:
            break
    return beta


def summed_rows(parts: DataFrame, kind: str) -> dict[int, np.ndarray]:
    """Sums of equally long rows of numbers (``i int, row binary``) by their number ``i``.

    Tasks give a row for each ``i`` they have, and the rows of one ``i`` stream through one task. For
    few ``i`` and short rows: as many as a vector or a matrix of features has, however many documents there are.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = np.frombuffer(row, kind)
                sums[i] = sums[i] + own if i in sums else own
        if sums:
            yield sum_batch(list(sums), [s.astype(kind) for s in sums.values()])

    tasks = int(parts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    summed = parts.repartition(tasks, "i").mapInArrow(run, "i int, row binary")
    return {r["i"]: np.frombuffer(bytes(r["row"]), kind) for r in summed.collect()}


def sum_batch(numbers: list[int], rows: list[np.ndarray]) -> pa.RecordBatch:
    """A task's part for ``summed_rows``."""
    columns = [pa.array(numbers, pa.int32()), pa.array([r.tobytes() for r in rows], pa.binary())]
    return pa.RecordBatch.from_arrays(columns, names=["i", "row"])
