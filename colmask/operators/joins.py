"""Joins that hold when one key owns a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from colmask.functions.names import free_name, quote_ident


def _key_hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*[F.col(k) for k in keys])


def _any_null(keys: Sequence[str]) -> Column:
    null = F.lit(False)
    for key in keys:
        null = null | F.col(key).isNull()
    return null


def default_share(spark: SparkSession) -> float:
    """Share of the rows from which a key is hot: what one shuffle partition holds of evenly spread rows."""
    return min(0.01, 1 / int(spark.conf.get("spark.sql.shuffle.partitions")))


def shuffled(right: DataFrame) -> DataFrame:
    """The right side of a join that must be shuffled whatever Spark takes its size for.

    Spark knows the size of the files, not how many rows come of each of theirs: an inventory, made of a row a table,
    would be broadcast and collected in the driver.
    """
    return right.hint("merge")


def hot_keys(df: DataFrame, key_sets: Sequence[Sequence[str]], share: float) -> list[list[int]]:
    """For each set of key columns, the hashes of keys that own at least ``share`` of the rows.

    One pass over the key columns with a bounded sketch per task; there are at
    most 1/share such keys, and 10,000 at the very most. The counts are
    estimates, which is enough: they only decide how a row is dealt out.
    """
    k = max(1, min(10_000, int(1 / share)))
    hashes = [F.when(~_any_null(keys), _key_hash(keys)).alias(f"h{i}") for i, keys in enumerate(key_sets)]
    tops = [F.expr(f"approx_top_k(h{i}, {k}, {max(10_000, 8 * k)})").alias(f"t{i}") for i in range(len(hashes))]
    found = df.select(*hashes).agg(F.count(F.lit(1)).alias("n"), *tops).first()
    return [
        sorted(r["item"] for r in found[f"t{i}"] or [] if r["item"] is not None and r["count"] >= share * found["n"])
        for i in range(len(hashes))
    ]


def skew_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str,
    hot: Sequence[int] | None = None,
) -> DataFrame:
    """Equi join of a large ``left`` with a ``right`` that has each key once.

    One join, and ``left`` is read once by it: rows with a hot or NULL key get a salt from the
    rest of the row, all others salt 0, and the ``right`` rows of the hot keys are
    there once for each salt. ``hot`` are the hashes of hot keys; without it they are looked up
    in one pass over the keys of ``left``. Spark broadcasts ``right`` if it turns out small.
    ``how`` is ``inner``, ``left``, ``left_semi`` or ``left_anti``.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"join type not supported: {how}")
    keys = list(keys)
    spark = left.sparkSession
    if hot is None:
        (hot,) = hot_keys(left, [keys], default_share(spark))
    salts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    salt = free_name([*left.columns, *right.columns], "_salt")
    is_hot = _key_hash(keys).isin(list(hot)) if hot else F.lit(False)
    rest = F.pmod(F.xxhash64(*[F.col(quote_ident(c)) for c in left.columns]), F.lit(salts)).cast("int")
    dealt = left.withColumn(salt, F.when(_any_null(keys) | is_hot, rest).otherwise(F.lit(0)))
    if hot:
        copies = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
        right = right.withColumn(salt, F.explode(copies))
    else:
        right = right.withColumn(salt, F.lit(0))
    added = [] if how in ("left_semi", "left_anti") else [c for c in right.columns if c not in (*keys, salt)]
    joined = dealt.join(right, [*keys, salt], how)
    return joined.select(*[F.col(quote_ident(c)) for c in left.columns + added])
