"""Who may see stored values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colmask import schemas
from colmask.functions.sql import ACCESS_GROUP
from colmask.operators.joins import skew_join
from colmask.session import stored


def has_grant(
    grants: DataFrame,
    group: str = ACCESS_GROUP,
    principal: Column | None = None,
    closure: DataFrame | None = None,
) -> Column:
    """Whether ``principal`` (default: the reader) is in ``group``, as a subquery.

    Spark runs it once per query, so a view built on it follows the grants
    table without being rebuilt. With a ``closure`` (see ``group_closure``) members of groups inside the group are in it as well.
    """
    principal = F.current_user() if principal is None else principal
    mine = grants.filter(F.col("principal") == principal)
    if closure is None:
        return mine.filter(F.col("grp") == group).exists()
    inside = closure.filter(F.col("grp") == group).select(F.col("member").alias("grp"))
    return mine.join(inside, "grp", "left_semi").exists()


def group_closure(grants: DataFrame, groups: Sequence[str] = (ACCESS_GROUP,)) -> DataFrame:
    """Which groups count as each of ``groups``, as ``(member, grp)``: the group itself, the groups in it, those in these, and so on.

    A principal that is the name of a group is that group. One step per level of nesting, each a join on the
    executors whose result is written to the shared folder; only rows in which a group is inside a group take part.
    Groups in a circle are each in the other. Nulls and repeated rows add nothing; a group without members is there with itself.
    """
    spark = grants.sparkSession
    named = grants.select(F.col("grp").alias("principal")).filter("principal IS NOT NULL").distinct()
    pairs = grants.select("principal", "grp").filter("grp IS NOT NULL").distinct()
    inside = stored(skew_join(pairs, named, ["principal"], "left_semi"), "groups")
    found = stored(spark.createDataFrame([(g, g) for g in sorted(set(groups))], schemas.CLOSURE), "closure")
    fresh = found
    while not fresh.isEmpty():
        step = inside.select(F.col("principal").alias("_inner"), F.col("grp").alias("member")).join(fresh, "member")
        step = step.select(F.col("_inner").alias("member"), "grp").distinct()
        fresh = stored(step.join(found, ["member", "grp"], "left_anti"), "closure")
        found = found.unionByName(fresh)
    return found
