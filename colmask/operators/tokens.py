"""Replace values by tokens from a table that outlives the run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colmask.functions.names import find_column, free_name, quote_ident
from colmask.operators.joins import default_share, hot_keys, skew_join
from colmask.operators.numbering import number_rows


def _values(df: DataFrame, columns: str | Sequence[str]) -> DataFrame:
    """The distinct values of the columns, in one pass; made distinct before they are shuffled."""
    columns = [columns] if isinstance(columns, str) else list(columns)
    texts = [F.col(quote_ident(find_column(df, c))).cast("string") for c in columns]
    return df.select(F.explode(F.array(*texts)).alias("value")).filter("value IS NOT NULL").distinct()


def known_tokens(vault: DataFrame, df: DataFrame, columns: str | Sequence[str]) -> DataFrame:
    """The rows of ``vault`` for the values of the columns.

    Few values are broadcast by Spark's own estimate of their size, and the vault, however large, is not shuffled.
    """
    return vault.join(_values(df, columns), "value", "left_semi")


def new_tokens(
    vault: DataFrame, df: DataFrame, columns: str | Sequence[str], known: DataFrame | None = None
) -> DataFrame:
    """Tokens for the values of the columns that ``vault`` (value, token) does not have.

    One pass over ``df`` whatever the number of columns. Values are made
    distinct before they are shuffled to the vault, so a frequent value costs
    one row per task. ``known`` are the ``known_tokens``, if there are any at hand: the values then meet these only.
    """
    fresh = _values(df, columns).join(vault if known is None else known, "value", "left_anti")
    after = F.coalesce(vault.agg(F.max("token")).scalar(), F.lit(0))
    return number_rows(fresh, ["value"], "token", after=after)


def extend_vault(vault: DataFrame, df: DataFrame, columns: str | Sequence[str]) -> DataFrame:
    """``vault`` plus a token for every new value of the columns; old values keep theirs."""
    return vault.unionByName(new_tokens(vault, df, columns))


def tokenize(df: DataFrame, columns: str | Sequence[str], vault: DataFrame) -> DataFrame:
    """``df`` with the columns replaced by ``tok_<n>``; NULL stays NULL.

    Names compare without case; a column that is not there is an error. Every
    value must be in the vault; use ``extend_vault`` first. A value without a
    token comes out as NULL, never as itself.

    One join per column. Frequent values of all columns are found in one pass before, and their rows are spread.
    That pass is left out on a stream, whose batches are small next to a table.
    """
    columns = [columns] if isinstance(columns, str) else list(columns)
    names = [find_column(df, c) for c in columns]
    value, token = free_name(df.columns, "_value"), free_name(df.columns, "_token")
    tokens = vault.select(F.col("value").alias(value), F.concat(F.lit("tok_"), F.col("token")).alias(token))
    hot: list[list[int]] = [[] for _ in names]
    if not df.isStreaming:
        keys = [f"k{i}" for i in range(len(names))]
        texts = [F.col(quote_ident(c)).cast("string").alias(k) for c, k in zip(names, keys)]
        hot = hot_keys(df.select(*texts), [[k] for k in keys], default_share(df.sparkSession))
    shown = df.columns
    for name, frequent in zip(names, hot):
        joined = skew_join(
            df.withColumn(value, F.col(quote_ident(name)).cast("string")), tokens, [value], "left", hot=frequent
        )
        df = joined.select(*[F.col(token).alias(c) if c == name else F.col(quote_ident(c)) for c in shown])
    return df
