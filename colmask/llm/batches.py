"""Parts of Arrow batches, so that a task holds little of a batch of long texts at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: UTF-8 bytes of texts that are worked on and handed on together.
SLICE_BYTES = 4 << 20


def slices(
    batch: pa.RecordBatch, text: int, size: int = SLICE_BYTES
) -> Iterator[tuple[pa.RecordBatch, list[bytes | None]]]:
    """Parts of a batch of up to ``size`` bytes of column ``text`` (or one row), each with its texts as UTF-8."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes) // size
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(edges, edges[1:]):
        if b > a:
            rows = batch.slice(a, b - a)
            yield rows, rows.column(text).cast(pa.binary()).to_pylist()
