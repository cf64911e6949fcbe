"""Benchmark decontamination with suffix arrays over the training texts.

Each task turns its documents, a shard of bounded size at a time, into one
sequence of word numbers and sorts the positions where benchmark text can match:
a suffix array. Every benchmark suffix long enough to hold a window is searched
in it by bisection, which gives its longest verbatim match in the shard and the
range of all places where its window occurs.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colmask.functions.names import free_name
from colmask.llm.words import split_words
from colmask.session import stored

WINDOW = 10
#: Words of a shard: what is sorted and searched at once. A longer document is a shard of its own.
SHARD_WORDS = 500_000
#: UTF-8 bytes of benchmark text that a task holds at once. A larger benchmark takes several passes.
BLOCK_BYTES = 32 << 20

FOUND = "struct<n_words:bigint,spans:array<struct<start:int,stop:int>>,items:array<string>>"


@dataclass
class Benchmark:
    """Benchmark items as one sequence of word numbers (0 ends an item), and the suffixes to search.

    ``starts`` are the places where a window begins, ``left`` the words from
    there to the end of the item, ``sizes`` the words of the window and
    ``owners`` the item's index in ``names`` (None for an item without id).
    """

    vocabulary: dict[bytes, int]
    names: list[str | None]
    words: np.ndarray
    starts: np.ndarray
    left: np.ndarray
    sizes: np.ndarray
    owners: np.ndarray

    @classmethod
    def of(cls, items: Iterable[tuple[str | None, bytes | None]], window: int = WINDOW) -> "Benchmark":
        vocabulary: dict[bytes, int] = {}
        names: list[str | None] = []
        words: list[int] = []
        starts, left, sizes, owners = [], [], [], []
        for name, text in items:
            own = [vocabulary.setdefault(w, len(vocabulary) + 1) for w in split_words(text)]
            size = min(window, len(own))
            for i in range(len(own) - size + 1 if own else 0):
                starts.append(len(words) + i)
                left.append(len(own) - i)
                sizes.append(size)
                owners.append(len(names))
            names.append(name)
            words += [*own, 0]
        return cls(vocabulary, names, np.array([*words, 0], np.int32), *(np.array(x, np.int64) for x in (starts, left, sizes, owners)))


def _common(text: np.ndarray, p: np.ndarray, words: np.ndarray, q: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Words, at most ``most``, that the texts from ``p`` and ``q`` on share; 0 ends a text."""
    lengths = np.zeros(len(p), np.int64)
    alive = np.arange(len(p))
    k = 0
    while len(alive):
        a = text[p[alive] + k]
        same = (a == words[q[alive] + k]) & (a > 0) & (k < most[alive])
        alive = alive[same]
        k += 1
        lengths[alive] = k
    return lengths


class Shard:
    """The suffix array of a sequence of word numbers in which 0 ends a text.

    Only stretches of at least ``least`` known words can hold a match; the
    others are left out. Suffixes are in order by their first ``depth`` words.
    """

    def __init__(self, ids: np.ndarray, least: int, depth: int):
        edges = np.diff(np.concatenate([[0], (ids > 0).view(np.int8), [0]]))
        begins, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        long = ends - begins >= least
        begins, ends = begins[long], ends[long]
        sizes = ends - begins
        total = int(sizes.sum())
        firsts = np.cumsum(sizes + 1) - (sizes + 1)
        run = np.repeat(np.arange(len(sizes)), sizes)
        inside = np.arange(total) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        at = firsts[run] + inside
        self.text = np.zeros(total + len(sizes) + 1, np.int32)
        self.text[at] = ids[begins[run] + inside]
        #: Where a place of ``text`` is in the whole sequence.
        self.origin = np.zeros(len(self.text), np.int64)
        self.origin[at] = begins[run] + inside
        rest = np.zeros(len(self.text), np.int64)
        rest[at] = sizes[run] - inside

        rank = self.text.astype(np.int64)
        span = 1
        while span < depth and len(at):
            ahead = np.zeros_like(rank)
            more = at[rest[at] > span]
            ahead[more] = rank[more + span]
            _, order = np.unique(rank[at] * (int(rank.max()) + 1) + ahead[at], return_inverse=True)
            rank[at] = order + 1
            span *= 2
            if order.max() + 1 == len(at):
                break
        self.order = at[np.argsort(rank[at], kind="stable")]

    def search(self, words: np.ndarray, q: np.ndarray, most: np.ndarray, after: bool = False) -> np.ndarray:
        """First place in the order whose first ``most`` words are not below (``after``: above) those from ``q`` on."""
        low, high = np.zeros(len(q), np.int64), np.full(len(q), len(self.order))
        while (open_ := np.flatnonzero(low < high)).size:
            middle = (low[open_] + high[open_]) // 2
            p, b, m = self.order[middle], q[open_], most[open_]
            shared = _common(self.text, p, words, b, m)
            below = (shared < m) & (self.text[p + shared] < words[b + shared])
            if after:
                below |= shared == m
            low[open_] = np.where(below, middle + 1, low[open_])
            high[open_] = np.where(below, high[open_], middle)
        return low

    def longest(self, bench: Benchmark) -> tuple[np.ndarray, np.ndarray]:
        """Length and place of each benchmark suffix's longest verbatim match."""
        best, where = np.zeros(len(bench.starts), np.int64), np.zeros(len(bench.starts), np.int64)
        if len(self.order):
            at = self.search(bench.words, bench.starts, bench.left)
            for near in (at - 1, at):
                near = np.clip(near, 0, len(self.order) - 1)
                shared = _common(self.text, self.order[near], bench.words, bench.starts, bench.left)
                where = np.where(shared > best, self.order[near], where)
                best = np.maximum(best, shared)
        return best, where


def _found(docs: list[np.ndarray], bench: Benchmark) -> tuple[list[list[tuple[int, int]]], list[set[int]], list[tuple]]:
    """Hit spans and items of each document, and ``(item, item word, length, document, document word)`` of longest matches."""
    spans: list[list[tuple[int, int]]] = [[] for _ in docs]
    items: list[set[int]] = [set() for _ in docs]
    offsets = np.cumsum([0] + [len(d) + 1 for d in docs])
    ids = np.zeros(offsets[-1] + 1, np.int32)
    for offset, doc in zip(offsets, docs):
        ids[offset : offset + len(doc)] = doc
    if not len(bench.starts):
        return spans, items, []
    shard = Shard(ids, int(bench.sizes.min()), int(bench.left.max()))
    length, where = shard.longest(bench)
    matched = np.flatnonzero(length >= bench.sizes)
    if not len(matched):
        return spans, items, []
    q, size = bench.starts[matched], bench.sizes[matched]
    first, last = shard.search(bench.words, q, size), shard.search(bench.words, q, size, after=True)

    # Equal windows have the same range: each range is walked once.
    ranges, which = np.unique(np.stack([first, last, size]), axis=1, return_inverse=True)
    which = which.reshape(-1)
    change = np.zeros(len(shard.text) + 1, np.int64)
    by_range = np.argsort(which, kind="stable")
    cuts = np.searchsorted(which[by_range], np.arange(ranges.shape[1] + 1))
    for r in range(ranges.shape[1]):
        places = shard.order[ranges[0, r] : ranges[1, r]]
        change[places] += 1
        np.add.at(change, places + ranges[2, r], -1)
        owners = set(bench.owners[matched[by_range[cuts[r] : cuts[r + 1]]]].tolist())
        for doc in np.unique(np.searchsorted(offsets, shard.origin[places], "right") - 1).tolist():
            items[doc] |= owners
    hit = np.concatenate([[0], (np.cumsum(change[:-1]) > 0).view(np.int8), [0]])
    edges = np.diff(hit)
    for begin, end in zip(np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)):
        start = int(shard.origin[begin])
        doc = int(np.searchsorted(offsets, start, "right") - 1)
        start -= int(offsets[doc])
        spans[doc].append((start, start + int(end - begin)))

    longest = []
    places = shard.origin[where[matched]]
    of = np.searchsorted(offsets, places, "right") - 1
    begins = np.flatnonzero(np.concatenate([[True], bench.words[bench.starts[1:] - 1] == 0])) if len(bench.starts) else []
    item_first = dict(zip(bench.owners[begins].tolist(), bench.starts[begins].tolist()))
    for row, place, doc in zip(matched.tolist(), places.tolist(), of.tolist()):
        owner = int(bench.owners[row])
        longest.append((owner, int(bench.starts[row]) - item_first[owner], int(length[row]), doc, place - int(offsets[doc])))
    return spans, items, longest


def _shards(batch: pa.RecordBatch, at: int, bench: Benchmark, shard_words: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Consecutive documents of a batch as word numbers, up to ``shard_words`` at a time."""
    texts = batch.column(at).cast(pa.binary())
    first, held, docs = 0, 0, []
    known = bench.vocabulary.get
    for i, text in enumerate(texts):
        words = split_words(text.as_py())
        if docs and held + len(words) > shard_words:
            yield first, docs
            first, held, docs = i, 0, []
        docs.append(np.fromiter(map(known, words, itertools.repeat(0)), np.int32, len(words)))
        held += len(words)
    if docs:
        yield first, docs


def _mark(docs: DataFrame, text: str, bench: Benchmark, out: str, shard_words: int) -> DataFrame:
    """``docs`` with the words and matches of one benchmark block in the struct column ``out``."""
    at = docs.columns.index(text)
    shared = docs.sparkSession.sparkContext.broadcast(bench)
    schema = docs.select("*", F.lit(None).cast(FOUND).alias(out)).schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        kind = pa.struct([
            ("n_words", pa.int64()),
            ("spans", pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))),
            ("items", pa.list_(pa.string())),
        ])
        for batch in batches:
            rows = []
            for _, words in _shards(batch, at, held, shard_words):
                spans, items, _ = _found(words, held)
                for doc, spanned, owners in zip(words, spans, items):
                    names = {held.names[o] for o in owners} - {None}
                    rows.append({
                        "n_words": len(doc),
                        "spans": [{"start": a, "stop": b} for a, b in spanned],
                        "items": sorted(names),
                    })
            found = pa.array(rows, kind)
            yield pa.RecordBatch.from_arrays([*batch.columns, found], names=[*batch.schema.names, out])

    return docs.mapInArrow(run, schema)


def _blocks(benchmark: DataFrame, window: int, block_bytes: int) -> Iterator[Benchmark]:
    """The whole benchmark in blocks of bounded size; at least one, be it empty."""
    held: list[tuple[str | None, bytes | None]] = []
    size, given = 0, False
    rows = benchmark.select(F.col("item_id").cast("string"), F.encode(F.col("text"), "utf-8"))
    for name, text in rows.toLocalIterator():
        if held and size + len(text or b"") > block_bytes:
            yield Benchmark.of(held, window)
            held, size, given = [], 0, True
        held.append((name, bytes(text) if text is not None else None))
        size += len(text or b"")
    if held or not given:
        yield Benchmark.of(held, window)


def find_benchmark(
    docs: DataFrame,
    benchmark: DataFrame,
    out: str,
    window: int = WINDOW,
    shard_words: int = SHARD_WORDS,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` with a struct column ``out``: ``n_words``, ``spans`` of hit words, ``items`` that occur.

    A window is ``window`` consecutive words of an item, or all words of a
    shorter item. Spans are word positions ``[start, stop)``; spans from different
    blocks may overlap. ``items`` are the distinct ids, as strings, of items with a window in the
    document; items without id hit words but are not listed. Null and wordless
    texts have no words. Nothing is shuffled: documents stream through, and the
    benchmark goes to the tasks in blocks of ``block_bytes`` of text, with one pass
    over the documents for each block.
    """
    found = None
    for bench in _blocks(benchmark, window, block_bytes):
        if found is None:
            docs, found = _mark(docs, "text", bench, out, shard_words), out
            continue
        more = free_name(docs.columns, "_more")
        docs = _mark(stored(docs, "marked"), "text", bench, more, shard_words)
        merged = F.struct(
            F.col(f"{out}.n_words").alias("n_words"),
            F.concat(f"{out}.spans", f"{more}.spans").alias("spans"),
            F.array_union(f"{out}.items", f"{more}.items").alias("items"),
        )
        docs = docs.withColumn(out, merged).drop(more)
    return docs


def hit_words(spans: str) -> Column:
    """Words inside any of the spans."""
    zero = F.struct(F.lit(0).alias("till"), F.lit(0).cast("bigint").alias("n"))
    return F.aggregate(
        F.array_sort(spans),
        zero,
        lambda acc, s: F.struct(
            F.greatest(acc["till"], s["stop"]).alias("till"),
            (acc["n"] + F.greatest(F.lit(0), s["stop"] - F.greatest(acc["till"], s["start"]))).alias("n"),
        ),
        lambda acc: acc["n"],
    )


def contamination(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """One row per document: words, hit words, the number and digest of the items, and the verdict.

    Repeated rows each get a row, null ids stay null, an empty table gives an
    empty result, and only id and text are read.
    """
    found = find_benchmark(docs.select("doc_id", "text"), benchmark, "found", **options)
    return found.select(
        "doc_id",
        F.col("found.n_words").alias("n_words"),
        hit_words("found.spans").alias("n_hit"),
        F.size("found.items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("found.items"), ","), 256).alias("items_sha256"),
        (F.size("found.spans") > 0).alias("contaminated"),
    )


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` in which no benchmark window occurs, with the columns of ``docs``."""
    out = free_name(docs.columns, "_found")
    return find_benchmark(docs, benchmark, out, **options).filter(F.size(f"{out}.spans") == 0).drop(out)


def longest_matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shard_words: int = SHARD_WORDS) -> DataFrame:
    """Each item's longest verbatim match in all documents, and where.

    ``item_id, item_word, n_words, doc_id, doc_word``, for items with a match of
    at least a window. Every shard reports its longest match of an item, and the
    longest of those is kept; ties go to the smallest document id and place.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    out = None
    for bench in _blocks(benchmark, window, BLOCK_BYTES):
        shared = docs.sparkSession.sparkContext.broadcast(bench)

        def run(batches: Iterable[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            held = shared.value
            for batch in batches:
                ids = batch.column(0)
                for first, words in _shards(batch, 1, held, shard_words):
                    best: dict[int, tuple] = {}
                    for owner, start, n, doc, place in _found(words, held)[2]:
                        if owner not in best or n > best[owner][2]:
                            best[owner] = (held.names[owner], start, n, ids[first + doc].as_py(), place)
                    columns = list(zip(*best.values())) or [[]] * 5
                    kinds = (pa.string(), pa.int64(), pa.int64(), ids.type, pa.int64())
                    names = ["item_id", "item_word", "n_words", "doc_id", "doc_word"]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

        rows = docs.select("doc_id", "text").mapInArrow(
            run, f"item_id string, item_word bigint, n_words bigint, doc_id {id_type}, doc_word bigint"
        )
        out = rows if out is None else out.unionByName(rows)
    first = F.struct((-F.col("n_words")).alias("order"), "doc_id", "doc_word", "item_word", "n_words")
    best = out.groupBy("item_id").agg(F.min(first).alias("best"))
    return best.select("item_id", "best.item_word", "best.n_words", "best.doc_id", "best.doc_word")


def op6_decontaminate(spark, sf_dir: str) -> DataFrame:
    """Which benchmark items every document holds, and how many of its words are theirs."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


_SQL_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)
OP6_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, {_SQL_WORDS} AS w FROM documents),
b AS (SELECT item, w, least({WINDOW}, len(w)) AS k
  FROM (SELECT item_id::VARCHAR AS item, {_SQL_WORDS} AS w FROM benchmark) WHERE len(w) > 0),
win AS (SELECT DISTINCT item, k, array_to_string(w[i:i + k - 1], ' ') AS g
  FROM b, unnest(range(1, len(w) - k + 2)) AS u(i)),
hit AS (SELECT row, i, h.k, item
  FROM (SELECT row, k, i, array_to_string(w[i:i + k - 1], ' ') AS g
    FROM d, (SELECT DISTINCT k FROM b) AS s, unnest(range(1, len(w) - k + 2)) AS u(i)) AS h
  JOIN win ON h.k = win.k AND h.g = win.g),
n AS (SELECT row, count(DISTINCT p) AS n_hit FROM hit, unnest(range(i, i + k)) AS u(p) GROUP BY row),
m AS (SELECT row, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hit GROUP BY row)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN n USING (row) LEFT JOIN m USING (row)
"""

QUERIES = {"op6_decontaminate": op6_decontaminate}
ORACLES = {"op6_decontaminate": OP6_SQL}
