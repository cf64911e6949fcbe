"""Exposure of sets of columns, from sketches of a table's units."""

from __future__ import annotations

from pyspark.sql import functions as F

from colmask import mask_table
from colmask.operators.sketches import HASHES, K, exposure_sketch, merged_exposure
from colmask.session import stored
from entry_queries.derived import mask_sql, table

SETS = {
    "order": ["l_orderkey"],
    "part, supplier": ["l_partkey", "l_suppkey"],
    "part, supplier, price": ["l_partkey", "l_suppkey", "l_extendedprice"],
}


def exposure_sketches(spark, sf_dir):
    """How many values of each set of columns of masked lines are one of a kind, from a sketch of each ship year."""
    lines = table(spark, sf_dir, "lineitem").withColumn("year", F.year("l_shipdate"))
    sketch = exposure_sketch("lineitem", mask_table(lines, ["l_extendedprice"]), "year", SETS)
    return merged_exposure(stored(sketch, "sketch"))


QUERIES = {"exposure_sketches": exposure_sketches}


def _text(column: str) -> str:
    value = mask_sql(column) if column == "l_extendedprice" else f"CAST({column} AS VARCHAR)"
    return f"coalesce(length({value}) || ':' || {value}, '-')"


_HASHED = " UNION ALL ".join(
    f"SELECT '{name}' AS Columns, year(l_shipdate) AS unit, "
    f"CAST('0x' || substr(md5({' || '.join(map(_text, columns))}), 1, 15) AS BIGINT) AS hash FROM lineitem"
    for name, columns in SETS.items()
)
ORACLES = {
    "exposure_sketches": f"""WITH counted AS (SELECT Columns, unit, hash, count(*) AS n FROM ({_HASHED}) GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY Columns, unit ORDER BY hash) AS rank FROM counted),
low AS (SELECT Columns, coalesce(min(hash) FILTER (WHERE rank = {K + 1}), {HASHES}) AS low FROM ranked GROUP BY Columns),
merged AS (
  SELECT Columns, hash, sum(n) AS n FROM ranked JOIN low USING (Columns) WHERE rank <= {K} AND hash < low GROUP BY ALL),
tally AS (
  SELECT Columns, count(*) AS v, count(*) FILTER (WHERE n = 1) AS u, count(*) FILTER (WHERE n < 5) AS f FROM merged GROUP BY Columns)
SELECT 'lineitem' AS TableName, Columns, (SELECT count(*) FROM lineitem) AS n_rows,
  CAST(floor(v * {HASHES}::DOUBLE / low) AS BIGINT) AS n_values, CAST(floor(u * {HASHES}::DOUBLE / low) AS BIGINT) AS n_unique,
  CAST(floor(f * {HASHES}::DOUBLE / low) AS BIGINT) AS n_few, low = {HASHES} AS exact
FROM tally JOIN low USING (Columns)""",
}
