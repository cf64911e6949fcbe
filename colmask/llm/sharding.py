"""Shards by descent through a weighted hash tree of regions, racks and shards.

Every node draws ``-ln(u) / weight`` with ``u`` from a hash of key and node; the
smallest draw wins (an exponential race, so a node wins in proportion to its
weight). A draw depends on nothing but key, node and weight, hence a changed
weight moves keys only into or out of the subtree whose weight changed.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from colmask.session import stored

HEX_DIGITS = 13
#: Hex digits of the order key that make a numbering bucket: 4,096 buckets a shard.
BUCKET_DIGITS = 3
#: Slots in one array while equal rows are unfolded.
UNFOLDED = 1 << 16


@dataclass(frozen=True)
class Node:
    """A region, rack or shard; ``shard`` is set on leaves only."""

    name: str
    weight: float
    children: tuple["Node", ...] = ()
    shard: int = -1


def _inner(name: str, children: list[Node]) -> Node:
    return Node(name, sum(c.weight for c in children), tuple(children))


def layout(
    shards: int,
    base: int = 24,
    regions: int = 3,
    racks: int = 2,
    weights: Mapping[int, float] | None = None,
) -> Node:
    """The tree for shards ``0 .. shards-1``, of weight 1 if ``weights`` has no other.

    The first ``base`` shards are spread over ``regions`` x ``racks``. Every later
    shard is a region of its own: a weight added inside an old region would also
    pull rows into that region's other shards, while a new region takes rows
    only into itself, so growth from ``base`` on moves nothing else.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    weights = weights or {}
    if any(w <= 0 for w in weights.values()):
        raise ValueError("weights must be positive")

    def leaf(path: str, shard: int) -> Node:
        return Node(f"{path}/s{shard}", float(weights.get(shard, 1.0)), (), shard)

    placed: dict[int, dict[int, list[int]]] = {}
    first = min(shards, base)
    for shard in range(first):
        cell = shard * regions * racks // base
        placed.setdefault(cell // racks, {}).setdefault(cell % racks, []).append(shard)
    top = [
        _inner(f"r{r}", [_inner(f"r{r}/k{k}", [leaf(f"r{r}/k{k}", s) for s in members]) for k, members in inside.items()])
        for r, inside in placed.items()
    ]
    for shard in range(first, shards):
        top.append(_inner(f"x{shard}", [_inner(f"x{shard}/k0", [leaf(f"x{shard}/k0", shard)])]))
    return _inner("root", top)


def _draw(key: Column, node: Node) -> Column:
    digits = F.substring(F.md5(F.concat(key, F.lit("|" + node.name))), 1, HEX_DIGITS)
    u = (F.conv(digits, 16, 10).cast("bigint").cast("double") + F.lit(0.5)) / F.lit(float(16**HEX_DIGITS))
    return -F.log(u) / F.lit(node.weight)


def _winner(key: Column, nodes: tuple[Node, ...], out: list[int]) -> Column:
    """The entry of ``out`` that belongs to the node with the smallest draw; ties go to the earlier node."""
    if len(nodes) == 1:
        return F.lit(out[0])
    draws = [F.struct(_draw(key, n).alias("d"), F.lit(i).alias("i")) for i, n in enumerate(nodes)]
    return F.element_at(F.array(*[F.lit(o) for o in out]), F.least(*draws)["i"] + 1)


def _descend(df: DataFrame, key: str, tree: Node, out: str) -> DataFrame:
    """Add column ``out``: level by level, so that only draws on a row's own path are made."""
    key_col = F.col(key)
    racks = [rack for region in tree.children for rack in region.children]
    regions = tree.children
    df = df.withColumn("_region", _winner(key_col, regions, list(range(len(regions)))))
    at = 0
    rack = F.lit(None).cast("int")
    for i, region in enumerate(regions):
        ids = list(range(at, at + len(region.children)))
        rack = F.when(F.col("_region") == i, _winner(key_col, region.children, ids)).otherwise(rack)
        at += len(region.children)
    df = df.withColumn("_rack", rack)
    shard = F.lit(None).cast("int")
    for i, node in enumerate(racks):
        shard = F.when(
            F.col("_rack") == i, _winner(key_col, node.children, [leaf.shard for leaf in node.children])
        ).otherwise(shard)
    return df.withColumn(out, shard.cast("int")).drop("_region", "_rack")


def assign_shards(
    docs: DataFrame, tree: Node, grown: Node, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per document: ``doc_id, size, text_crc32, shard, slot, grown_shard``.

    ``size`` is the text's UTF-8 bytes plus 8 (8 for a null text, whose checksum
    is that of the empty text). ``grown_shard`` is the shard under ``grown``.
    ``slot`` numbers the rows of a shard without gaps from 0, in the order of a
    hash of the row. Only the id and the tree decide the shard; rows without an
    id take checksum and size in its place, so that they spread as well. Equal
    rows go to the same shard and get numbers one after another. An empty table
    gives an empty result; other columns, whatever their names, are not read.

    Only five narrow columns are shuffled. Equal rows are counted before the
    shuffle and unfolded after it, and numbering works on 4,096 hash buckets a
    shard, whose counts (shards x 4,096 rows at most) give the offsets, so no
    task sees a whole shard. Equal rows are unfolded in ranges of ``UNFOLDED`` slots, so however many there
    are, no array holds them all.
    """
    size = F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("bigint") + 8
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        size.alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"),
    )
    same = rows.groupBy("doc_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("_n"))
    unkeyed = F.concat(F.lit("null:"), F.col("text_crc32").cast("string"), F.lit(":"), F.col("size").cast("string"))
    same = same.withColumn("_key", F.coalesce(F.col("doc_id").cast("string"), unkeyed))
    same = _descend(same, "_key", tree, "shard")
    same = _descend(same, "_key", grown, "grown_shard")
    order = F.md5(F.concat_ws(":", F.col("_key"), F.col("text_crc32").cast("string"), F.col("size").cast("string")))
    same = stored(same.withColumn("_order", order).withColumn("_bucket", F.substring("_order", 1, BUCKET_DIGITS)), "shards")

    counts = same.groupBy("shard", "_bucket").agg(F.sum("_n").alias("_size"))
    earlier = Window.partitionBy("shard").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "_bucket", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_before"))
    within = (
        Window.partitionBy("shard", "_bucket")
        .orderBy("_order", "doc_id", "size", "text_crc32")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    first = F.col("_before") + F.col("_inside")
    return (
        same.withColumn("_inside", F.coalesce(F.sum("_n").over(within), F.lit(0)))
        .join(offsets, ["shard", "_bucket"])
        .select(
            "doc_id", "size", "text_crc32", "shard", "grown_shard", (first + F.col("_n")).alias("_end"),
            F.explode(F.sequence(first, first + F.col("_n") - 1, F.lit(UNFOLDED))).alias("_start"),
        )
        .select(
            "doc_id", "size", "text_crc32", "shard", "grown_shard",
            F.explode(F.sequence("_start", F.least(F.col("_start") + UNFOLDED, "_end") - 1)).alias("slot"),
        )
    )


def op10_shards(spark, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 23 by the law ``key``, and in 25 shards."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return assign_shards(docs, layout(24), layout(25)).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )


def _sql_pick(nodes: tuple[Node, ...], out: list[str]) -> str:
    """SQL for the entry of ``out`` whose node has the smallest draw."""
    if len(nodes) == 1:
        return out[0]
    draws = [
        f"-ln((('0x' || substr(md5(k || '|{n.name}'), 1, {HEX_DIGITS}))::BIGINT::DOUBLE + 0.5) / {float(16**HEX_DIGITS)!r}) / {n.weight!r}"
        for n in nodes
    ]
    return f"list_extract([{', '.join(out)}], list_position([{', '.join(draws)}], least({', '.join(draws)})))"


def _sql_descent(tree: Node) -> str:
    def rack(node: Node) -> str:
        return _sql_pick(node.children, [str(leaf.shard) for leaf in node.children])

    def region(node: Node) -> str:
        cases = " ".join(f"WHEN {i} THEN {rack(c)}" for i, c in enumerate(node.children))
        return f"CASE {_sql_pick(node.children, [str(i) for i in range(len(node.children))])} {cases} END"

    cases = " ".join(f"WHEN {i} THEN {region(c)}" for i, c in enumerate(tree.children))
    return f"CASE {_sql_pick(tree.children, [str(i) for i in range(len(tree.children))])} {cases} END"


#: CRC-32 in SQL: a table made by its rule, then one step a byte.
_SQL_CRC = """
crc_table AS (
  SELECT list(list_reduce(list_prepend(n, range(8)),
    lambda c, b: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY n) AS t
  FROM (SELECT unnest(range(256)) AS n)),
sized AS (
  SELECT doc_id, strlen(coalesce(text, ''))::BIGINT + 8 AS size,
    xor(list_reduce(list_prepend(4294967295::BIGINT,
      list_transform(range(strlen(coalesce(text, ''))),
        lambda i: ('0x' || substr(hex(encode(coalesce(text, ''))), 2 * i + 1, 2))::BIGINT)),
      lambda c, b: xor(c >> 8, list_extract(t, (xor(c, b) & 255) + 1))), 4294967295)::BIGINT AS text_crc32
  FROM documents, crc_table)
"""

OP10_SQL = f"""
WITH {_SQL_CRC.strip()},
keyed AS (
  SELECT *, coalesce(doc_id::VARCHAR, 'null:' || text_crc32 || ':' || size) AS k FROM sized)
SELECT doc_id, size, text_crc32, 'key' AS law, shard::INTEGER AS shard,
  row_number() OVER (PARTITION BY shard ORDER BY md5(k || ':' || text_crc32 || ':' || size),
    doc_id NULLS FIRST, size, text_crc32) - 1 AS slot,
  grown_shard::INTEGER AS grown_shard
FROM (SELECT *, {_sql_descent(layout(24))} AS shard, {_sql_descent(layout(25))} AS grown_shard FROM keyed)
"""

QUERIES = {"op10_shards": op10_shards}
ORACLES = {"op10_shards": OP10_SQL}
