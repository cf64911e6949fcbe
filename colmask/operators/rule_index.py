"""Rules of any number, looked up by a piece of their keyword instead of one by one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colmask.operators.joins import skew_join
from colmask.operators.rules import has_excluded_suffix
from colmask.session import stored

#: Letters of a piece; shorter keywords are a piece of their own.
PIECE = 3
#: Rules with at most so many bytes of keywords, and 64 more for each, are broadcast; more are joined by shuffles.
BROADCAST_BYTES = 1 << 20


def pieces(text: Column, lengths: list[int]) -> Column:
    """All different substrings of a text that have one of the given lengths; the empty one for length 0."""

    def of_length(n: int) -> Column:
        if n == 0:
            return F.array(F.lit(""))
        starts = F.when(F.length(text) >= n, F.sequence(F.lit(1), F.length(text) - n + 1))
        return F.coalesce(F.transform(starts, lambda i: F.substring(text, i, F.lit(n))), F.array().cast("array<string>"))

    return F.array_distinct(F.flatten(F.array(*[of_length(n) for n in lengths])))


def classify_indexed(columns: DataFrame, rules: DataFrame, nulls: bool = False) -> DataFrame:
    """``classify_columns`` for a table of many rules ``(prio, keyword, mode, string_only)``.

    Every rule is filed under the piece of three letters of its keyword that the fewest names have, and a name meets
    only the rules filed under its own pieces; the rest of the keyword is then compared in full. The cost grows with the
    names and with the pairs that share a rare piece, not with rules times names. Equal names are looked up once.
    Keywords of one or two letters are pieces themselves and an empty one is found in every name, as in
    ``classify_columns``; a null keyword matches nothing. Without rules or without columns there is no row.
    ``nulls`` keeps columns without a type, which rules for texts do not match, and takes a null place for the first.
    """
    name, dtype = F.lower("ColumnName"), F.lower("DataType")
    text, place = F.col("DataType") == "string", F.col("Ordinal")
    if nulls:
        place = F.coalesce(place.cast("bigint"), F.lit(-(1 << 62)))
    # Equal columns of a table meet the same rules: they are merged before anything else moves.
    lower = (
        columns.select("TableName", "Ordinal", name.alias("ColumnName"), dtype.alias("DataType"))
        .filter(~has_excluded_suffix(F.col("ColumnName")))
        .groupBy("TableName", "ColumnName", "DataType")
        .agg(F.min(place).alias("Ordinal"))
        .withColumn("_text", F.coalesce(text, F.lit(False)) if nulls else text)
    )
    lower = stored(lower, "columns")
    names = stored(lower.select("ColumnName", "_text").distinct(), "names")

    rules = rules.select("prio", F.lower("keyword").alias("keyword"), "mode", "string_only").filter("keyword IS NOT NULL")
    rules = stored(rules.distinct(), "rules")
    size = rules.agg(F.coalesce(F.sum(F.octet_length("keyword") + 64), F.lit(0))).first()[0]

    def of_bounded_size(df: DataFrame) -> DataFrame:
        """A frame of at most one row per letter of the rules: sent to all tasks if the rules are small."""
        return F.broadcast(df) if size <= BROADCAST_BYTES else df

    length = F.least(F.length("keyword"), F.lit(PIECE))
    lengths = sorted(r["n"] for r in rules.select(length.alias("n")).distinct().collect())  # four at most
    if not lengths:
        lengths = [PIECE]
    own = F.filter(pieces(F.col("keyword"), lengths), lambda p: F.length(p) == length)
    of_rules = rules.select("keyword").distinct().select("keyword", F.explode(own).alias("_piece"))
    of_names = names.select("*", F.explode(pieces(F.col("ColumnName"), lengths)).alias("_piece"))

    known = of_names.join(of_bounded_size(of_rules.select("_piece").distinct()), "_piece", "left_semi")
    counts = known.groupBy("_piece").agg(F.count(F.lit(1)).alias("_n"))
    # A keyword with a piece that no name has is in no name: it needs no place in the index.
    filed = (
        of_rules.join(counts, "_piece", "left")
        .groupBy("keyword")
        .agg(F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("n"), F.col("_piece").alias("piece"))).alias("rarest"))
        .filter("rarest.n > 0")
        .select("keyword", F.col("rarest.piece").alias("_piece"))
    )
    word, of = F.col("keyword"), F.col("ColumnName")
    edge = of.startswith(word) | of.endswith(word)
    found = F.when(F.col("mode") == "edge", edge).otherwise(of.contains(word))
    met = (
        of_names.join(of_bounded_size(filed), "_piece")
        .filter(of.contains(word))
        .join(of_bounded_size(rules), "keyword")
        .filter(found & (~F.col("string_only") | F.col("_text")))
    )
    first = met.groupBy("ColumnName", "_text").agg(F.min(F.struct("prio", "keyword")).alias("hit"))
    matched = skew_join(lower, first, ["ColumnName", "_text"], "inner")
    return (
        matched.groupBy("TableName", "ColumnName")
        .agg(F.min(F.struct("hit", "Ordinal", "DataType")).alias("best"))
        .select(
            "TableName",
            F.col("best.hit.keyword").alias("PIICategory"),
            "ColumnName",
            F.col("best.DataType").alias("DataType"),
            F.lit(True).alias("EncryptFlag"),
        )
    )
