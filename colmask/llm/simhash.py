"""Near-duplicates by SimHash and tiled exact comparison.

Distinct fingerprints are put into tiles by the population counts of their four
16-bit quarters. Two fingerprints that differ in at most ``r`` bits have counts
that differ by at most ``r`` in sum, so only such pairs of tiles are compared:
numpy exclusive-or and bit counts over whole blocks, where pairs of blocks are
skipped again by the counts of their eight bytes.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colmask.functions.names import free_name
from colmask.llm.batches import slices
from colmask.llm.components import components
from colmask.operators.joins import skew_join
from colmask.session import stored

SEED = 42
QUARTERS = 4
#: Counts of a quarter go from 0 to 16, so there are at most 17**4 = 83,521 tiles.
LEVELS = 17
#: Fingerprints of one tile that a task holds; larger tiles are split.
HOME_ROWS = 1 << 20
#: Fingerprints that stream past them in one group; more of them are split as well.
GUEST_ROWS = 1 << 20
#: Rows and columns of one block of comparisons.
BLOCK = 512
_SHINGLES_AT_ONCE = 1 << 16


def simhash(text: bytes | None, shingle_words: int = 3) -> int:
    """The 64-bit fingerprint of a UTF-8 text, 0 for null or a text without words.

    Lower case of A-Z only, words between ASCII white space, shingles of
    ``shingle_words`` words with repeats (a shorter text is one shingle). A bit is 1
    if more than half of the shingles' XXH64 hashes have it. Long texts are
    counted piece by piece.
    """
    words = text.lower().split() if text else []
    if not words:
        return 0
    n = max(1, len(words) - shingle_words + 1)
    set_bits = np.zeros(64, np.int64)
    for first in range(0, n, _SHINGLES_AT_ONCE):
        last = min(n, first + _SHINGLES_AT_ONCE)
        part = words[first : last + shingle_words - 1]
        shingles = map(b" ".join, zip(*(part[i:] for i in range(min(shingle_words, len(part))))))
        if len(words) < shingle_words:
            shingles = iter([b" ".join(words)])
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, itertools.repeat(SEED)), np.uint64, last - first)
        bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        set_bits += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * set_bits > n).tobytes(), "big", signed=True)


def add_fingerprints(docs: DataFrame, text: str, out: str, shingle_words: int = 3) -> DataFrame:
    """``docs`` with its fingerprint as a long (two's complement) in column ``out``."""
    at = docs.columns.index(text)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, at):
                prints = pa.array([simhash(t, shingle_words) for t in texts], pa.int64())
                yield pa.RecordBatch.from_arrays([*part.columns, prints], names=[*batch.schema.names, out])

    schema = docs.select("*", F.lit(0).cast("bigint").alias(out)).schema
    return docs.mapInArrow(run, schema)


def _quarter(fingerprint: Column, i: int) -> Column:
    return F.bit_count(F.shiftrightunsigned(fingerprint, 16 * i).bitwiseAND(F.lit(0xFFFF)))


def _tile(quarters: list[Column]) -> Column:
    code = F.lit(0)
    for q in quarters:
        code = code * LEVELS + q
    return code


def _neighbours(radius: int) -> list[tuple[int, ...]]:
    """Steps to a tile within ``radius``: none, and of two opposite steps the one whose first part is positive."""
    span = range(-radius, radius + 1)
    steps = itertools.product(span, repeat=QUARTERS)
    return [s for s in steps if sum(map(abs, s)) <= radius and s >= (0,) * QUARTERS]


def _at_neighbours(df: DataFrame, radius: int) -> DataFrame:
    """A row of ``df`` (with quarters ``q0..q3``) for each tile ``home`` that it is compared in."""
    steps = F.array(*[F.struct(*[F.lit(x).alias(f"d{i}") for i, x in enumerate(s)]) for s in _neighbours(radius)])
    df = df.withColumn("step", F.explode(steps))
    moved = [F.col(f"q{i}") + F.col(f"step.d{i}") for i in range(QUARTERS)]
    inside = F.lit(True)
    for m in moved:
        inside = inside & m.between(0, LEVELS - 1)
    return df.filter(inside).withColumn("home", _tile(moved))


def _byte_counts(prints: np.ndarray) -> np.ndarray:
    return np.bitwise_count(np.ascontiguousarray(prints).view(np.uint8).reshape(-1, 8))


class _Side:
    """Fingerprints in the order of their byte counts, with the range of counts of each block."""

    def __init__(self, prints: np.ndarray):
        counts = _byte_counts(prints)
        order = np.lexsort(counts.T)
        self.prints, counts = prints[order], counts[order].astype(np.int16)
        starts = np.arange(0, len(prints), BLOCK)
        self.starts = starts
        self.low = np.minimum.reduceat(counts, starts, axis=0)
        self.high = np.maximum.reduceat(counts, starts, axis=0)

    def pairs(self, other: "_Side", radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Indexes of all linked pairs, block by block."""
        for i, start in enumerate(self.starts):
            apart = np.maximum(0, np.maximum(self.low[i] - other.high, other.low - self.high[i])).sum(axis=1)
            own = self.prints[start : start + BLOCK, None]
            for j in np.flatnonzero(apart <= radius):
                at = other.starts[j]
                near = np.bitwise_count(own ^ other.prints[None, at : at + BLOCK]) <= radius
                x, y = np.nonzero(near)
                if len(x):
                    yield x + start, y + at


def _merge(roots: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Roots (index of the smallest member) after linking ``a`` with ``b``."""
    while True:
        ra, rb = roots[a], roots[b]
        apart = ra != rb
        if not apart.any():
            return roots
        ra, rb, a, b = ra[apart], rb[apart], a[apart], b[apart]
        np.minimum.at(roots, np.maximum(ra, rb), np.minimum(ra, rb))
        while not np.array_equal(jumped := roots[roots], roots):
            roots = jumped


def _compare(home: _Side, guests: _Side | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what is linked among ``home`` or with ``guests``: at most one for each fingerprint."""
    n = len(home.prints)
    prints = home.prints if guests is None else np.concatenate([home.prints, guests.prints])
    roots = np.arange(len(prints))
    for x, y in home.pairs(home if guests is None else guests, radius):
        roots = _merge(roots, x, y if guests is None else y + n)
    linked = np.flatnonzero(roots != np.arange(len(prints)))
    return prints[linked], prints[roots[linked]]


def _tile_links(radius: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, residents, home = None, [], None

        def emit(links: tuple[np.ndarray, np.ndarray]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)) for x in links], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            prints = batch.column("fingerprint").to_numpy(zero_copy_only=False).view(np.uint64)
            keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("home", "sub", "lot", "guest")])
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            for start, stop in zip([0, *cuts], [*cuts, batch.num_rows]):
                here, guest = tuple(keys[:3, start]), keys[3, start]
                if here != key:
                    if home is None and residents:
                        yield emit(_compare(_Side(np.concatenate(residents)), None, radius))
                    key, residents, home = here, [], None
                if not guest:
                    residents.append(prints[start:stop])
                elif residents:
                    if home is None:
                        home = _Side(np.concatenate(residents))
                        if here[2] == 0:
                            yield emit(_compare(home, None, radius))
                    yield emit(_compare(home, _Side(prints[start:stop]), radius))
        if home is None and residents:
            yield emit(_compare(_Side(np.concatenate(residents)), None, radius))

    return run


def placed_fingerprints(prints: DataFrame, radius: int, home_rows: int, guest_rows: int) -> DataFrame:
    """``home, sub, lot, guest, fingerprint``: every place where a fingerprint is compared."""
    p = prints.select(F.col(prints.columns[0]).alias("fingerprint"))
    p = p.select("fingerprint", *[_quarter(F.col("fingerprint"), i).alias(f"q{i}") for i in range(QUARTERS)])
    quarters = [f"q{i}" for i in range(QUARTERS)]
    held = p.groupBy(*quarters).agg(F.count(F.lit(1)).alias("n"))
    around = _at_neighbours(held, radius).groupBy("home").agg(
        F.sum(F.when(F.col("home") == _tile([F.col(q) for q in quarters]), F.col("n")).otherwise(0)).alias("residents"),
        F.sum("n").alias("all"),
    )
    tiles = stored(
        around.filter("residents > 0").select(
            "home",
            F.ceil(F.col("residents") / home_rows).cast("int").alias("subs"),
            F.ceil((F.col("all") - F.col("residents") + 1) / guest_rows).cast("int").alias("lots"),
        ),
        "tiles",
    )
    # A row becomes up to 65: spread before, however few files the prints are in.
    spread = p.repartition(int(p.sparkSession.conf.get("spark.sql.shuffle.partitions")), "fingerprint")
    rows = _at_neighbours(spread, radius).join(F.broadcast(tiles), "home")
    own = F.col("home") == _tile([F.col(q) for q in quarters])
    sub = F.pmod(F.xxhash64("fingerprint"), F.col("subs")).cast("int")
    lot = F.pmod(F.xxhash64("fingerprint", F.lit(1)), F.col("lots")).cast("int")

    def place(guest: int, s: Column, l: Column) -> Column:
        return F.struct(F.lit(guest).alias("guest"), s.cast("int").alias("sub"), l.cast("int").alias("lot"))

    def up_to(count: Column) -> Column:
        return F.sequence(F.lit(0), count - 1)

    whole = (F.col("subs") == 1) & (F.col("lots") == 1)
    in_lots = F.concat(
        F.transform(up_to(F.col("lots")), lambda l: place(0, sub, l)),
        F.transform(F.filter(up_to(F.col("subs")), lambda s: s > sub), lambda s: place(1, s, lot)),
    )
    places = (
        F.when(whole, F.array(F.struct(F.when(own, 0).otherwise(1).alias("guest"), F.lit(0).alias("sub"), F.lit(0).alias("lot"))))
        .when(own, in_lots)
        .otherwise(F.transform(up_to(F.col("subs")), lambda s: place(1, s, lot)))
    )
    placed = rows.select("home", "fingerprint", F.explode(places).alias("at")).select(
        "home", "at.sub", "at.lot", "at.guest", "fingerprint"
    )
    return placed


def link_fingerprints(prints: DataFrame, radius: int = 3, home_rows: int = HOME_ROWS, guest_rows: int = GUEST_ROWS) -> DataFrame:
    """Links ``a, b`` that connect all distinct fingerprints at most ``radius`` bits apart.

    ``prints`` has one column of distinct longs and must be a stored table. A
    fingerprint goes to its own tile and, as a guest, to the tiles around it; of
    two tiles one takes the other's guests. A tile of many fingerprints is
    split into lots that meet pairwise, and so are many guests, so no task holds
    a whole tile. The links are a spanning forest of each comparison: a dense group
    gives as many links as members, not all its pairs. The only broadcast is the count
    of fingerprints by tile, at most 83,521 rows.
    """
    placed = placed_fingerprints(prints, radius, home_rows, guest_rows)
    placed = placed.repartition("home", "sub", "lot").sortWithinPartitions("home", "sub", "lot", "guest")
    return placed.mapInArrow(_tile_links(radius), "a bigint, b bigint")


def near_duplicates(
    docs: DataFrame, shingle_words: int = 3, radius: int = 3, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id, fingerprint`` (16 hex digits) and ``component_id`` of every row of ``docs``.

    ``component_id`` is the smallest id that can be reached over links of at
    most ``radius`` differing bits, a row's own included; null ids count only
    where a component has no other. Equal texts share a fingerprint and are compared
    once. Null and wordless texts have fingerprint 0, linked like any other.
    Repeated rows each get a row; an empty table gives an empty result; other
    columns are not read.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows = stored(add_fingerprints(rows, "text", "print", shingle_words).drop("text"), "prints")
    groups = fingerprint_groups(rows, "doc_id", radius)
    # Null and wordless texts, for one, share a fingerprint.
    return skew_join(rows, groups, ["print"], "inner").select(
        "doc_id",
        F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"),
        F.col("first").alias("component_id"),
    )


def fingerprint_groups(rows: DataFrame, order: str, radius: int = 3) -> DataFrame:
    """``print, root, first``: for each distinct ``print`` of a stored table its component and the smallest ``order`` in it."""
    prints = stored(rows.groupBy("print").agg(F.min(order).alias("own")), "prints")
    roots = components(link_fingerprints(prints.select("print"), radius))
    known = prints.join(roots, F.col("print") == F.col("node"), "left").select(
        "print", "own", F.coalesce("root", "print").alias("root")
    )
    known = stored(known, "known")
    first = known.groupBy("root").agg(F.min("own").alias("first"))
    # One component may have a large part of the fingerprints.
    return stored(skew_join(known, first, ["root"], "inner").select("print", "root", "first"), "groups")


def drop_near_duplicates(docs: DataFrame, shingle_words: int = 3, radius: int = 3) -> DataFrame:
    """``docs`` with one row of each group left: the one with the smallest id, nulls last.

    Rows that share that id, such as repeated rows, are told apart by a row
    number that is written once together with the rows. Only ids, fingerprints
    and row numbers are compared and grouped; the texts move once, to meet the
    list of rows to keep. Columns keep their names and order.
    """
    names = docs.columns
    mark, row, out = (free_name(names, n) for n in ("_print", "_row", "_keep"))
    marked = add_fingerprints(docs, "text", mark, shingle_words).withColumn(row, F.monotonically_increasing_id())
    marked = stored(marked, "marked")
    order = F.struct(F.col("doc_id").isNull().alias("unknown"), F.col("doc_id").alias("doc_id"), F.col(row).alias("row"))
    rows = marked.select(F.col(mark).alias("print"), order.alias("order"))
    keep = fingerprint_groups(rows, "order", radius).select(F.col("first.row").alias(out)).distinct()
    kept = marked.join(keep, F.col(row) == F.col(out), "left_semi")
    return kept.select(*[F.col(f"`{n}`") for n in names])


def op1_simhash(spark, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op1_simhash": op1_simhash}
ORACLES: dict[str, str] = {}
