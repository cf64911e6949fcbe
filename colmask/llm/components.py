"""Connected components of a graph given as links, without a node's links in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colmask.session import stored


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node that has links; ``root`` is the smallest node reachable.

    ``links`` has two columns of integers. Each round hangs all smaller
    neighbours of a node under the smallest of them and then jumps each link to
    its upper end's own parent, so paths shrink by a factor a round. Rounds use
    aggregations with partial sums and joins that adaptive execution can split
    at a hot node; each is written to the shared folder. Nulls and links of a
    node with itself are left out; no links give an empty result.
    """
    a, b = (F.col(c) for c in links.columns)
    down = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    down = down.filter(a.isNotNull() & b.isNotNull() & (F.col("u") > F.col("v"))).distinct()
    down = stored(down, "links")
    while True:
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        hung = (
            down.join(least, "u")
            .select(
                F.explode(
                    F.when(F.col("v") == F.col("m"), F.array(F.struct("u", "v", F.lit(False).alias("moved")))).otherwise(
                        F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v"), F.lit(True).alias("moved")))
                    )
                ).alias("e")
            )
            .select("e.*")
            .groupBy("u", "v")
            .agg(F.max("moved").alias("moved"))
        )
        hung = stored(hung, "links")
        parents = hung.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("top"))
        down = (
            hung.join(parents, F.col("v") == F.col("w"), "left")
            .select("u", F.coalesce("top", "v").alias("v"), (F.col("moved") | F.col("top").isNotNull()).alias("moved"))
            .groupBy("u", "v")
            .agg(F.max("moved").alias("moved"))
        )
        down = stored(down, "links")
        if not down.agg(F.max("moved")).first()[0]:
            return down.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                down.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
            )
