"""Ranked lexical search by a dual tree.

Items and documents are vectors over the items' terms. Both are put into
hierarchies whose nodes hold the largest value of each coordinate, so the product of an item node
with a document node bounds every score between them. A pair of nodes whose
bound is under the weakest kth score of the node's items is left out with all that
is below it; what remains is scored in full, so the result is exact.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from colmask.llm.batches import slices
from colmask.llm.words import split_words
from colmask.session import stored

#: Items of a block and UTF-8 bytes of their text: what a task holds of the benchmark. Each block is a pass over the documents.
BLOCK_ITEMS = 4096
BLOCK_BYTES = 32 << 20
#: Entries (a term in a document) of one tree of documents; a task builds one tree after the other.
TREE_ENTRIES = 1 << 21
LEAF_DOCS = 16
FAN = 8
#: Share of the documents that is searched first, for lower bounds of the kth scores.
FIRST_SHARE = 1 / 64

_VECTORS = "doc_id bigint, n bigint, terms array<int>, tfs array<bigint>"


@dataclass
class Items:
    """A block of items: their ids and their distinct terms as numbers of ``vocabulary``."""

    ids: list
    terms: list[np.ndarray]
    vocabulary: dict[bytes, int]

    @classmethod
    def of(cls, rows: Iterable[tuple]) -> "Items":
        vocabulary: dict[bytes, int] = {}
        ids, terms = [], []
        for item_id, text in rows:
            own = {vocabulary.setdefault(w, len(vocabulary)) for w in split_words(text)}
            ids.append(item_id)
            terms.append(np.array(sorted(own), np.int64))
        return cls(ids, terms, vocabulary)


def _blocks(benchmark: DataFrame, items: int, size: int) -> Iterator[Items]:
    held: list[tuple] = []
    total = 0
    for row in benchmark.select("item_id", F.encode("text", "utf-8").alias("text")).toLocalIterator():
        text = bytes(row["text"] or b"")
        if held and (len(held) == items or total + len(text) > size):
            yield Items.of(held)
            held, total = [], 0
        held.append((row["item_id"], text))
        total += len(text)
    if held:
        yield Items.of(held)


def _ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places ``starts[i] .. starts[i] + sizes[i]``, one range after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes, sizes) + np.repeat(starts, sizes)


class ItemTree:
    """Levels of items: level 0 has single items, a node of each next level up to ``fan`` nodes of the one below.

    A node's coordinate maxima are 1 at the terms that one of its items has.
    """

    def __init__(self, terms: list[np.ndarray], weights: np.ndarray, fan: int):
        # Items that share rare terms come together.
        rarest = [tuple(t[np.lexsort((t, -weights[t]))[:4]].tolist()) for t in terms]
        self.order = np.array(sorted(range(len(terms)), key=lambda i: (not len(terms[i]), rarest[i])), np.int64)
        level = [terms[i] for i in self.order]
        self.fan = fan
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while True:
            sizes = np.array([len(t) for t in level], np.int64)
            flat = np.concatenate(level) if level else np.zeros(0, np.int64)
            self.levels.append((flat, np.cumsum(sizes) - sizes, sizes))
            if len(level) <= 1:
                break
            level = [np.unique(np.concatenate(level[i : i + fan])) for i in range(0, len(level), fan)]

    def products(self, level: int, nodes: np.ndarray, dense: np.ndarray) -> np.ndarray:
        """The product of the nodes' maxima with a dense vector."""
        flat, starts, sizes = self.levels[level]
        out = np.zeros(len(nodes), np.int64)
        some = np.flatnonzero(sizes[nodes])
        if len(some):
            own = sizes[nodes[some]]
            values = dense[flat[_ragged(starts[nodes[some]], own)]]
            out[some] = np.add.reduceat(values, np.cumsum(own) - own)
        return out

    def alive(self, items: np.ndarray, dense: np.ndarray, weakest: np.ndarray) -> np.ndarray:
        """Which of ``items`` (places in the tree, sorted) may reach their ``weakest`` kept score with some vector under ``dense``."""
        for level in range(len(self.levels) - 1, -1, -1):
            node = items // self.fan**level
            first = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
            nodes = node[first]
            bound = self.products(level, nodes, dense)
            passed = (bound > 0) & (bound >= np.minimum.reduceat(weakest[items], first))
            items = items[np.repeat(passed, np.diff(np.append(first, len(items))))]
            if not len(items):
                break
        return items


class DocTree:
    """Levels of documents: leaves of ``leaf`` documents, then ``fan`` nodes a node, each with its coordinate maxima."""

    def __init__(self, starts: np.ndarray, sizes: np.ndarray, terms: np.ndarray, values: np.ndarray, n_terms: int, leaf: int, fan: int):
        # Documents whose largest value is at the same term come together.
        top = np.full(len(sizes), -1, np.int64)
        some = np.flatnonzero(sizes)
        doc = np.repeat(np.arange(len(sizes)), sizes)
        most = np.maximum.reduceat(values, starts[some]) if len(some) else values[:0]
        largest = np.zeros(len(sizes), np.int64)
        largest[some] = most
        at = np.flatnonzero(values == largest[doc])
        top[doc[at[::-1]]] = terms[at[::-1]]
        self.order = np.lexsort((-largest, top))
        self.starts, self.sizes = starts[self.order], sizes[self.order]
        self.terms, self.values, self.fan, self.leaf = terms, values, fan, leaf
        places = _ragged(self.starts, self.sizes)
        owner, t, v = np.repeat(np.arange(len(sizes)), self.sizes) // leaf, terms[places], values[places]
        count = -(-len(sizes) // leaf)
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while True:
            order = np.argsort(owner * n_terms + t, kind="stable")
            owner, t, v = owner[order], t[order], v[order]
            new = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (t[1:] != t[:-1])])) if len(t) else order
            owner, t, v = owner[new], t[new], np.maximum.reduceat(v, new) if len(new) else v
            self.levels.append((np.searchsorted(owner, np.arange(count + 1)), t, v))
            if count <= 1:
                break
            owner, count = owner // fan, -(-count // fan)


class Search:
    """The best ``k`` documents of each item so far, over one tree of documents after the other.

    ``least`` are scores that an item's kth document is known to reach.
    """

    def __init__(self, items: list[np.ndarray], weights: np.ndarray, k: int, least: np.ndarray | None, leaf: int = LEAF_DOCS, fan: int = FAN):
        self.tree = ItemTree(items, weights, fan)
        self.k, self.leaf, self.fan = k, leaf, fan
        self.weights = weights
        self.weakest = np.ones(len(items), np.int64) if least is None else np.maximum(1, least[self.tree.order])
        self.heaps: list[list[tuple]] = [[] for _ in items]
        self.dense = np.zeros(len(weights) + 1, np.int64)
        #: Documents that were scored with an item, for measuring what the bounds leave out.
        self.scored = 0

    def add(self, ids: list, sizes: np.ndarray, terms: np.ndarray, values: np.ndarray) -> None:
        """Search documents given by their ids, their numbers of terms, and terms and values one document after the other."""
        docs = DocTree(np.cumsum(sizes) - sizes, sizes, terms, values, len(self.weights), self.leaf, self.fan)
        everything = np.arange(len(self.heaps))
        stack = [(len(docs.levels) - 1, 0, everything)] if len(sizes) and len(everything) else []
        while stack:
            level, node, items = stack.pop()
            edges, t, v = docs.levels[level]
            own = slice(edges[node], edges[node + 1])
            self.dense[t[own]] = v[own]
            items = self.tree.alive(items, self.dense, self.weakest)
            self.dense[t[own]] = 0
            if not len(items):
                continue
            if level:
                below = len(docs.levels[level - 1][0]) - 1
                stack += [(level - 1, c, items) for c in range(node * self.fan, min(below, (node + 1) * self.fan))]
                continue
            for at in range(node * self.leaf, min(len(sizes), (node + 1) * self.leaf)):
                own = slice(docs.starts[at], docs.starts[at] + docs.sizes[at])
                self.dense[docs.terms[own]] = docs.values[own]
                scores = self.tree.products(0, items, self.dense)
                self.dense[docs.terms[own]] = 0
                self.scored += len(items)
                reach = np.flatnonzero(scores >= self.weakest[items])
                for item, score in zip(items[reach].tolist(), scores[reach].tolist()):
                    self._keep(item, score, ids[docs.order[at]])

    def _keep(self, item: int, score: int, doc_id) -> None:
        heap = self.heaps[item]
        # The least of a heap is its worst: the lowest score, then no id, then the largest id.
        entry = (score, doc_id is not None, -doc_id if doc_id is not None else 0)
        if len(heap) < self.k:
            heapq.heappush(heap, entry)
        else:
            heapq.heappushpop(heap, entry)
        if len(heap) == self.k:
            self.weakest[item] = max(self.weakest[item], heap[0][0])

    def best(self) -> Iterator[tuple[int, int | None, int]]:
        """``item, doc_id, score`` of all kept documents."""
        for place, heap in enumerate(self.heaps):
            for score, known, negative in heap:
                yield int(self.tree.order[place]), -negative if known else None, score


def _vectors(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """``doc_id, n, terms, tfs``: terms in a document and its counts of known terms; stored.

    At its end each task adds a row without ``n``: the number of its documents that have a term.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())), ("tfs", pa.list_(pa.int64()))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        held = np.zeros(len(known), np.int64)
        for batch in batches:
            for part, texts in slices(batch, 1):
                sizes, terms, tfs = [], [], []
                for text in texts:
                    words = split_words(text)
                    sizes.append(len(words))
                    counts = Counter(words)
                    own = [(known[w], c) for w, c in counts.items() if w in known]
                    terms.append([t for t, _ in own])
                    tfs.append([c for _, c in own])
                    held[terms[-1]] += 1
                columns = [part.column(0), pa.array(sizes, pa.int64()), pa.array(terms, schema.field(2).type), pa.array(tfs, schema.field(3).type)]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)
        some = np.flatnonzero(held)
        if len(some):
            rest = [pa.array([some], schema.field(2).type), pa.array([held[some]], schema.field(3).type)]
            yield pa.RecordBatch.from_arrays([pa.array([None], pa.int64()), pa.array([None], pa.int64()), *rest], schema=schema)

    return stored(docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, _VECTORS), "vectors")


def _candidates(
    vectors: DataFrame, items: Items, weights: np.ndarray, n_docs: int, n_words: int, k: int, least: np.ndarray | None, tree_entries: int
) -> DataFrame:
    """``item, doc_id, score``: the best ``k`` documents of each task for every item, those under ``least`` left out."""
    shared = vectors.sparkSession.sparkContext.broadcast((items.terms, weights, least))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms_of, w, known = shared.value
        search = Search(terms_of, w, k, known)
        ids: list = []
        parts: list[tuple] = []

        def flush() -> None:
            if ids:
                sizes, terms, tfs, n = (np.concatenate(x) for x in zip(*parts))
                m = 50 + (50 * n * n_docs) // n_words
                tf = tfs.astype(np.int64)
                values = w[terms] * ((1_000_000_000 * tf) // (1000 * tf + 20 * np.repeat(m, sizes)))
                search.add(ids, sizes, terms.astype(np.int64), values)
                ids.clear()
                parts.clear()

        entries = 0
        for batch in batches:
            terms, tfs = batch.column(2), batch.column(3)
            sizes = np.diff(terms.offsets.to_numpy())
            cuts = (np.cumsum(sizes) + entries) // tree_entries
            edges = [0, *(np.flatnonzero(np.diff(cuts)) + 1).tolist(), batch.num_rows]
            for a, b in zip(edges, edges[1:]):
                if a:
                    flush()
                    entries = 0
                own = batch.slice(a, b - a)
                ids += own.column(0).to_pylist()
                parts.append((
                    sizes[a:b], own.column(2).flatten().to_numpy(zero_copy_only=False),
                    own.column(3).flatten().to_numpy(zero_copy_only=False), own.column(1).to_numpy(zero_copy_only=False),
                ))
                entries += int(sizes[a:b].sum())
        flush()
        found = list(zip(*search.best())) or [[]] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(found, (pa.int32(), pa.int64(), pa.int64()))], names=["item", "doc_id", "score"])

    some = vectors.filter(F.col("n").isNotNull() & (F.size("terms") > 0))
    return some.mapInArrow(run, "item int, doc_id bigint, score bigint")


def ranked_search(
    docs: DataFrame,
    benchmark: DataFrame,
    k: int = 50,
    block_items: int = BLOCK_ITEMS,
    block_bytes: int = BLOCK_BYTES,
    tree_entries: int = TREE_ENTRIES,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: each item's ``k`` best documents with a score above 0, equal scores by ascending id.

    Terms are the words of ``split_words``. A term weighs floor(1000 ln((2N + 2) / (2 df + 1))) for N documents with a
    term; a document's part of it is (10^9 tf) div (1000 tf + 20 m) with m = 50 + (50 n N) div L for
    its n and all L terms. An item's score is the sum over its distinct terms, in 64-bit integers.

    Texts are read once for each block of items; the counts go to the shared folder. A first search over a share
    of them gives scores that every kth document reaches at least, so that the search over
    all rows hands on few candidates; it leaves nothing out of the result. Ids are integers; null
    ids come last. Every row of either table counts for itself, repeated rows too. Null and wordless
    texts have no terms: such an item finds nothing. Empty tables give an empty result; other columns are not read.
    """
    spark = docs.sparkSession
    id_type = benchmark.schema["item_id"].dataType
    out = None
    for items in _blocks(benchmark, block_items, block_bytes):
        if not items.vocabulary:
            continue
        vectors = _vectors(docs, items.vocabulary)
        total = vectors.agg(F.count_if(F.col("n") > 0).alias("docs"), F.sum("n").alias("words")).first()
        if not total["docs"]:
            break
        pairs = vectors.filter(F.col("n").isNull()).select(F.explode(F.arrays_zip("terms", "tfs")).alias("p"))
        # One row for each term of the block at most.
        held = pairs.groupBy("p.terms").agg(F.sum("p.tfs").alias("df")).toLocalIterator()
        df = np.zeros(len(items.vocabulary))
        for row in held:
            df[row["terms"]] = row["df"]
        weights = np.floor(1000 * np.log((2 * total["docs"] + 2) / (2 * df + 1))).astype(np.int64)

        def best(rows: DataFrame, least: np.ndarray | None) -> DataFrame:
            found = _candidates(rows, items, weights, total["docs"], total["words"], k, least, tree_entries)
            order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
            return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

        least = np.zeros(len(items.ids), np.int64)
        for row in best(vectors.sample(FIRST_SHARE, seed=12), None).filter(F.col("rank") == k).select("item", "score").collect():
            least[row["item"]] = row["score"]
        kinds = StructType([StructField("item", IntegerType()), StructField("item_id", id_type)])
        names = spark.createDataFrame(list(enumerate(items.ids)), kinds)
        ranked = best(vectors, least).join(names, "item").select("item_id", "rank", "doc_id", "score")
        out = ranked if out is None else out.unionByName(ranked)
    if out is None:
        out = docs.select(
            F.lit(None).cast(id_type).alias("item_id"), F.lit(0).alias("rank"), F.col("doc_id").cast("bigint"),
            F.lit(0).cast("bigint").alias("score"),
        ).limit(0)
    return out


def op12_ranked(spark, sf_dir: str) -> DataFrame:
    """The 50 best documents of every benchmark item."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return ranked_search(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


_SQL_TERMS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
)
OP12_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, {_SQL_TERMS} AS w FROM documents),
s AS (SELECT count(*) FILTER (len(w) > 0) AS docs, sum(len(w))::BIGINT AS words FROM d),
t AS (SELECT row, doc_id, len(w)::BIGINT AS n, term, count(*) AS tf FROM d, unnest(w) AS u(term) GROUP BY ALL),
f AS (SELECT term, count(*) AS df FROM t GROUP BY term),
i AS (SELECT DISTINCT item, item_id, term
  FROM (SELECT row_number() OVER () AS item, item_id, {_SQL_TERMS} AS w FROM benchmark), unnest(w) AS u(term)),
p AS (SELECT item, item_id, row, doc_id, sum(floor(1000 * ln((2 * docs + 2) / (2 * df + 1)))::BIGINT
    * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // words))))::BIGINT AS score
  FROM i JOIN f USING (term) JOIN t USING (term) CROSS JOIN s GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM p WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM r WHERE rank <= 50
"""

QUERIES = {"op12_ranked": op12_ranked}
ORACLES = {"op12_ranked": OP12_SQL}
