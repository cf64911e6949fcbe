"""Consecutive numbers without sorting everything in one task."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from colmask.functions.names import free_name
from colmask.session import stored


def key_digest(keys: Sequence[str]) -> Column:
    """MD5 of the key columns; spreads rows evenly whatever the keys look like."""
    return F.md5(F.concat_ws("\x1f", *[F.col(k).cast("string") for k in keys]))


def number_rows(
    df: DataFrame,
    keys: Sequence[str],
    out: str,
    after: int | Column = 0,
    digits: int | None = None,
) -> DataFrame:
    """Number the rows ``after + 1, after + 2, ...`` in the order of their key digest.

    ``keys`` must identify a row. The number depends on the data alone, so a
    task that runs again gives the same numbers. ``df`` is evaluated once, into
    the shared work folder. Rows are split by the first ``digits`` hex digits of
    the digest, by default enough for sixteen buckets a shuffle partition; the
    buckets' counts are the only thing summed up in one place. The number of buckets
    does not change the numbers.
    """
    after = F.lit(after) if isinstance(after, int) else after
    if digits is None:
        partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        digits = max(3, math.ceil(math.log(16 * partitions, 16)))
    taken = [*df.columns, out]
    digest, bucket, rank, size, before = (
        free_name(taken, n) for n in ("_digest", "_bucket", "_rank", "_size", "_before")
    )
    rows = df.withColumn(digest, key_digest(keys)).withColumn(bucket, F.substring(digest, 1, digits))
    rows = stored(rows, "numbered")
    sizes = rows.groupBy(bucket).agg(F.count(F.lit(1)).alias(size))
    earlier = Window.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(bucket, F.coalesce(F.sum(size).over(earlier), F.lit(0)).alias(before))
    in_bucket = Window.partitionBy(bucket).orderBy(digest, *keys)
    return (
        rows.withColumn(rank, F.row_number().over(in_bucket))
        .join(offsets, bucket)
        .withColumn(out, (after + F.col(before) + F.col(rank)).cast("bigint"))
        .drop(digest, bucket, rank, before)
    )
