"""How many rows of a masked table are one of a kind, from sketches that can be added up.

A sketch belongs to a unit of a table (a file, a day) and a set of columns. It holds the ``k`` lowest hashes of the
set's values with the number of rows of each, and ``theta``, below which it has every hash. Sketches of units are
merged below the lowest theta of them, so nothing is read again when units come and go. Up to ``k`` different
values a unit the result is exact; beyond that n kept values give an error of some 1/sqrt(n).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from colmask.functions.names import find_column, quote_ident

K = 4096
#: Hashes are the first 15 hex digits of an MD5.
HASHES = 1 << 60
_UNIT = ["TableName", "Columns", "unit"]


def _texts(df: DataFrame, columns: Sequence[str]) -> list[Column]:
    return [F.col(quote_ident(find_column(df, c))).cast("string") for c in columns]


def _value_hash(df: DataFrame, columns: Sequence[str]) -> Column:
    """Hash of the values, each with its length in front, so that no two rows read alike; NULL is a value of its own."""
    parts = [F.coalesce(F.concat(F.length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in _texts(df, columns)]
    return F.conv(F.substring(F.md5(F.concat(*parts)), 1, 15), 16, 10).cast("bigint")


def _bounds(df: DataFrame, key: Column, sets: Sequence[Sequence[str]], k: int) -> DataFrame:
    """``unit, _below0, ...``: a hash below which a unit has its k + 1 lowest hashes of each set, for units of many values.

    Hashes are evenly spread, so it follows from the number of different values. That is estimated, to some 5 %, and
    the bound leaves room for twice k and 256 more, hence for an estimate twice the number. Units of few values are left out.
    """
    room = 2 * k + 256
    counts = [F.approx_count_distinct(F.xxhash64(*_texts(df, c))).alias(f"_n{i}") for i, c in enumerate(sets)]
    counted = df.groupBy(key).agg(*counts).filter(F.greatest(F.lit(0), *[F.col(f"_n{i}") for i in range(len(sets))]) > room)
    share = [F.lit(float(room)) / F.greatest(F.col(f"_n{i}"), F.lit(room)) for i in range(len(sets))]
    return counted.select("unit", *[F.ceil(s * F.lit(float(HASHES))).alias(f"_below{i}") for i, s in enumerate(share)])


def exposure_sketch(
    name: str, df: DataFrame, unit: str, sets: Mapping[str, Sequence[str]], k: int = K
) -> DataFrame:
    """Sketches of a masked table: ``TableName, Columns, unit, theta, hash, n``.

    ``unit`` is the column that tells units apart, ``sets`` names sets of columns. Each unit and set has a row
    without a hash and with the unit's number of rows. ``df`` is read three times: for the units' sizes, for their numbers of
    different values, and for the hashes. Hashes that cannot be among the k + 1 lowest of a unit are not shuffled,
    and equal values are counted before they are.
    """
    key = F.col(quote_ident(find_column(df, unit))).cast("string").alias("unit")
    hashed = df.select(key, *[_value_hash(df, c).alias(f"_hash{i}") for i, c in enumerate(sets.values())])
    bounds = F.broadcast(_bounds(df, key, list(sets.values()), k).withColumnRenamed("unit", "_unit"))
    hashes = F.array(
        *[
            F.struct(
                F.lit(s).alias("Columns"),
                F.col(f"_hash{i}").alias("hash"),
                F.coalesce(F.col(f"_below{i}"), F.lit(HASHES)).alias("below"),
            )
            for i, s in enumerate(sets)
        ]
    )
    counted = (
        hashed.join(bounds, F.col("unit").eqNullSafe(F.col("_unit")), "left")
        .select("unit", F.inline(hashes))
        .filter("hash < below")
        .groupBy("Columns", "unit", "hash")
        .agg(F.count(F.lit(1)).alias("n"), F.min("below").alias("below"))
        .withColumn("TableName", F.lit(name))
    )
    rank = F.row_number().over(Window.partitionBy(*_UNIT).orderBy("hash")).alias("_rank")
    lowest = counted.select("*", rank).filter(F.col("_rank") <= k + 1)
    beyond = F.max(F.when(F.col("_rank") == k + 1, F.col("hash"))).over(Window.partitionBy(*_UNIT))
    kept = lowest.withColumn("theta", F.coalesce(beyond, F.col("below"))).filter(F.col("_rank") <= k)
    names = F.array(*[F.lit(s) for s in sets])
    sizes = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).select(
        F.lit(name).alias("TableName"), F.explode(names).alias("Columns"), "unit", F.lit(HASHES).alias("theta"),
        F.lit(None).cast("bigint").alias("hash"), "n",
    )
    return kept.select(*_UNIT, "theta", "hash", "n").unionByName(sizes)


def merged_exposure(sketches: DataFrame, few: int = 5) -> DataFrame:
    """Per table and set of columns: rows, different values, and values of one row and of fewer than ``few`` rows.

    ``TableName, Columns, n_rows, n_values, n_unique, n_few, exact``; a unit's sketch must be there once. The sketches
    are read twice, so pass a written table.
    """
    key = ["TableName", "Columns"]
    whole = sketches.groupBy(*key).agg(
        F.min("theta").alias("low"), F.coalesce(F.sum(F.when(F.col("hash").isNull(), F.col("n"))), F.lit(0)).alias("n_rows")
    )
    values = (
        sketches.filter("hash IS NOT NULL")
        .join(whole.select(*key, "low"), key)
        .filter("hash < low")
        .groupBy(*key, "hash")
        .agg(F.sum("n").alias("n"))
        .groupBy(*key)
        .agg(
            F.count(F.lit(1)).alias("n_values"),
            F.count_if(F.col("n") == 1).alias("n_unique"),
            F.count_if(F.col("n") < few).alias("n_few"),
        )
    )

    def scaled(count: str) -> Column:
        return F.floor(F.coalesce(F.col(count), F.lit(0)) * F.lit(float(HASHES)) / F.col("low")).cast("bigint").alias(count)

    return whole.join(values, key, "left").select(
        *key, "n_rows", scaled("n_values"), scaled("n_unique"), scaled("n_few"), (F.col("low") == HASHES).alias("exact")
    )
