"""Exact duplicates by Grace hashing.

A task first merges equal texts of its own rows. What is left is dealt into
buckets by a hash and each bucket goes through an open-addressing table that
compares complete texts. Texts that do not fit the table go to spill files in the
shared folder and are dealt anew by another hash, until every bucket fits.
"""

from __future__ import annotations

import hashlib
import math
from array import array
from collections.abc import Iterable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colmask.functions.names import free_name
from colmask.llm.batches import slices
from colmask.operators.joins import default_share, hot_keys
from colmask.session import stored, work_folder

#: Bytes of different texts in the table of a task that merges its own rows; a full table is handed on and emptied.
OWN_BYTES = 16 << 20
#: Bytes of different texts in the table of a bucket; a single longer text is taken as well.
BUCKET_BYTES = 64 << 20
#: Buckets of one pass. More text than they hold is first split into folders that are worked on one after the other.
MOST_BUCKETS = 10_000
#: Bytes that an entry counts for beside its text.
ENTRY_BYTES = 128
#: Bytes of text that are handed on together.
OUT_BYTES = 4 << 20


def one_space(text: bytes | None) -> bytes:
    """The text with one space for each stretch of ASCII white space; null counts as empty."""
    if not text:
        return b""
    words = text.split()
    if not words:
        return b" "
    ends = [b" " if text[:1].isspace() else b"", b" ".join(words), b" " if text[-1:].isspace() else b""]
    return b"".join(ends)


class ContentTable:
    """Open addressing with linear probing; entries with equal hashes are told apart by their complete content."""

    def __init__(self) -> None:
        self.hashes: list[int] = []
        self.contents: list[bytes] = []
        self.size = 0
        self._grow(1024)

    def _grow(self, slots: int) -> None:
        self.mask = slots - 1
        self.slots = array("q", [-1]) * slots
        for entry, h in enumerate(self.hashes):
            at = h & self.mask
            while self.slots[at] >= 0:
                at = (at + 1) & self.mask
            self.slots[at] = entry

    def find(self, h: int, content: bytes) -> int:
        """The number of the entry with this content, or the complement of the free slot where it belongs."""
        at = h & self.mask
        while (entry := self.slots[at]) >= 0:
            if self.hashes[entry] == h and self.contents[entry] == content:
                return entry
            at = (at + 1) & self.mask
        return ~at

    def add(self, slot: int, h: int, content: bytes) -> int:
        """Put a content into the free slot that ``find`` gave (its complement)."""
        entry = len(self.hashes)
        self.slots[slot] = entry
        self.hashes.append(h)
        self.contents.append(content)
        self.size += len(content) + ENTRY_BYTES
        if 2 * len(self.hashes) > len(self.slots):
            self._grow(2 * len(self.slots))
        return entry


def _order(doc_id, row: int) -> tuple:
    return doc_id is None, doc_id, row


class _Rows:
    """Rows that are given out as Arrow batches of bounded size."""

    def __init__(self, schema: pa.Schema):
        self.schema = schema
        self._clear()

    def _clear(self) -> None:
        self.columns: list[list] = [[] for _ in self.schema]
        self.bytes = 0

    def add(self, **values) -> None:
        for name, column in zip(self.schema.names, self.columns):
            column.append(values.get(name))
        self.bytes += ENTRY_BYTES + len(values.get("content") or b"")

    def full(self, most: int = OUT_BYTES) -> Iterator[pa.RecordBatch]:
        if self.bytes > most:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(self.columns, self.schema)], schema=self.schema)
            self._clear()


def _merge_own(docs: DataFrame, own_bytes: int, hash_bits: int) -> DataFrame:
    """Members ``doc_id, row, rep`` and entries ``rep, hash, content, bytes, n, least, least_row`` of all rows, stored.

    ``rep`` is the row that stands for equal texts of one filling of a task's table.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {kind}, row bigint, rep bigint, hash bigint, content binary, bytes bigint, n bigint, "
        f"least {kind}, least_row bigint"
    )
    keep = (1 << hash_bits) - 1

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = table = None
        firsts: list[tuple] = []
        counts: list[int] = []
        reps: list[int] = []

        def entries() -> Iterator[pa.RecordBatch]:
            for i, content in enumerate(table.contents):
                signed = table.hashes[i] - (1 << 64 if table.hashes[i] >> 63 else 0)
                out.add(
                    rep=reps[i], hash=signed, content=content, bytes=len(content) + ENTRY_BYTES, n=counts[i],
                    least=firsts[i][1], least_row=firsts[i][2],
                )
                yield from out.full()

        for batch in batches:
            if out is None:
                ids = batch.schema.field("doc_id").type
                kinds = [ids, *[pa.int64()] * 3, pa.binary(), *[pa.int64()] * 2, ids, pa.int64()]
                names = ["doc_id", "row", "rep", "hash", "content", "bytes", "n", "least", "least_row"]
                out, table = _Rows(pa.schema(list(zip(names, kinds)))), ContentTable()
            for part, texts in slices(batch, 2):
                for doc_id, row, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), texts):
                    content = one_space(text)
                    h = xxhash.xxh64_intdigest(content) & keep
                    entry = table.find(h, content)
                    if entry < 0:
                        if table.size + len(content) > own_bytes and table.contents:
                            yield from entries()
                            table, firsts, counts, reps = ContentTable(), [], [], []
                            entry = table.find(h, content)
                        entry = table.add(~entry, h, content)
                        firsts.append(_order(doc_id, row))
                        counts.append(0)
                        reps.append(row)
                    counts[entry] += 1
                    firsts[entry] = min(firsts[entry], _order(doc_id, row))
                    out.add(doc_id=doc_id, row=row, rep=reps[entry])
                yield from out.full()
        if out is not None:
            yield from entries()
            yield from out.full(0)

    return stored(docs.select("doc_id", "row", "text").mapInArrow(run, schema), "merged")


def _buckets(entries: DataFrame, hot: frozenset[int], bucket_bytes: int) -> DataFrame:
    """One pass over buckets, a partition each: links ``rep, root``, classes ``root, sha, ...`` and what goes on.

    Entries of ``hot`` hashes are spread over several buckets, so they are merged and go on as well.
    """
    kind = entries.schema["least"].dataType.simpleString()
    schema = (
        f"rep bigint, root bigint, hash bigint, content binary, bytes bigint, n bigint, least {kind}, "
        "least_row bigint, sha binary"
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, table = None, ContentTable()
        firsts: list[tuple] = []
        counts: list[int] = []
        roots: list[int] = []
        for batch in batches:
            if out is None:
                ids = batch.schema.field("least").type
                kinds = [*[pa.int64()] * 3, pa.binary(), *[pa.int64()] * 2, ids, pa.int64(), pa.binary()]
                names = ["rep", "root", "hash", "content", "bytes", "n", "least", "least_row", "sha"]
                out = _Rows(pa.schema(list(zip(names, kinds))))
            for part, contents in slices(batch, 2):
                rest = (part.column(c).to_pylist() for c in (0, 1, 4, 5, 6))
                for content, rep, signed, n, least, least_row in zip(contents, *rest):
                    h = signed & 0xFFFFFFFFFFFFFFFF
                    entry = table.find(h, content)
                    if entry < 0 and table.contents and table.size + len(content) > bucket_bytes:
                        out.add(
                            rep=rep, hash=signed, content=content, bytes=len(content) + ENTRY_BYTES, n=n,
                            least=least, least_row=least_row,
                        )
                        continue
                    if entry < 0:
                        entry = table.add(~entry, h, content)
                        firsts.append(_order(least, least_row))
                        counts.append(0)
                        roots.append(rep)
                    counts[entry] += n
                    firsts[entry] = min(firsts[entry], _order(least, least_row))
                    out.add(rep=rep, root=roots[entry])
                yield from out.full()
        for i, content in enumerate(table.contents):
            signed = table.hashes[i] - (1 << 64 if table.hashes[i] >> 63 else 0)
            _, least, least_row = firsts[i]
            if signed in hot:
                out.add(
                    rep=roots[i], hash=signed, content=content, bytes=len(content) + ENTRY_BYTES, n=counts[i],
                    least=least, least_row=least_row,
                )
            else:
                sha = hashlib.sha256(content).digest()
                out.add(root=roots[i], n=counts[i], least=least, least_row=least_row, sha=sha)
            yield from out.full()
        if out is not None:
            yield from out.full(0)

    return entries.mapInArrow(run, schema)


_ENTRY = ["rep", "hash", "content", "bytes", "n", "least", "least_row"]
_CLASS = ["n", "least", "least_row", "sha"]


def _resolve(entries: DataFrame, level: int, bucket_bytes: int, most_buckets: int, split_first: bool = True) -> DataFrame | None:
    """``rep`` with the size, first row and digest of its class, for all stored ``entries``; None if there are none.

    After a split into folders a pass over buckets always follows: it merges copies, which no hash can split.
    """
    total = entries.agg(F.sum("bytes")).first()[0]
    if not total:
        return None
    spark = entries.sparkSession
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    needed = math.ceil(1.5 * total / bucket_bytes)
    if split_first and needed > most_buckets:
        parts = min(256, math.ceil(needed / most_buckets))
        part = F.pmod(F.xxhash64("hash", F.lit(level)), F.lit(parts)).cast("int")
        spread = F.pmod(F.xxhash64("rep"), F.lit(math.ceil(most_buckets / parts)))
        path = work_folder(spark, "split")
        entries.withColumn("part", part).repartition(least, "part", spread).write.partitionBy("part").parquet(path)
        split = spark.read.schema(entries.withColumn("part", part).schema).parquet(path)
        out = None
        for p in range(parts):
            found = _resolve(split.filter(F.col("part") == p).select(*_ENTRY), level + 1, bucket_bytes, most_buckets, False)
            out = found if out is None else out if found is None else out.unionByName(found)
        return out
    hot: list[int] = []
    if level == 0:
        (hot,) = hot_keys(entries.withColumnRenamed("hash", "key"), [["key"]], default_share(spark))
    salted = F.xxhash64("hash").isin(hot) if hot else F.lit(False)
    salt = F.when(salted, F.pmod(F.xxhash64("rep"), F.lit(least))).otherwise(F.lit(-1))
    n = max(least, min(needed, most_buckets))
    dealt = entries.withColumn("bucket", F.pmod(F.xxhash64("hash", F.lit(level + 1), salt), F.lit(n)))
    hot_hashes: frozenset[int] = frozenset()
    if hot:
        found_hot = entries.filter(salted).select("hash").distinct().limit(len(hot) + 1)
        hot_hashes = frozenset(r["hash"] for r in found_hot.collect())
    done = stored(_buckets(dealt.repartition(n, "bucket").select(*_ENTRY), hot_hashes, bucket_bytes), "bucket-level")
    classes = done.filter(F.col("sha").isNotNull()).select("root", *_CLASS)
    later = _resolve(done.filter(F.col("content").isNotNull()).select(*_ENTRY), level + 1, bucket_bytes, most_buckets)
    links = done.filter(F.col("rep").isNotNull() & F.col("root").isNotNull()).select("rep", "root")
    if later is None:
        return links.join(classes, "root").select("rep", *_CLASS)
    # What went on: entries that no table took, by themselves, and merged entries of hot hashes, with their links.
    known = classes.unionByName(later.withColumnRenamed("rep", "root"))
    own = later.join(links.select("rep"), "rep", "left_anti")
    return links.join(known, "root").select("rep", *_CLASS).unionByName(own.select("rep", *_CLASS))


def _classes(
    docs: DataFrame, own_bytes: int, bucket_bytes: int, most_buckets: int, hash_bits: int
) -> tuple[DataFrame, DataFrame | None]:
    merged = _merge_own(docs, own_bytes, hash_bits)
    members = merged.filter(F.col("row").isNotNull()).select("doc_id", "row", "rep")
    entries = merged.filter(F.col("content").isNotNull()).select(*_ENTRY)
    return members, _resolve(entries, 0, bucket_bytes, most_buckets)


def exact_duplicates(
    docs: DataFrame,
    own_bytes: int = OWN_BYTES,
    bucket_bytes: int = BUCKET_BYTES,
    most_buckets: int = MOST_BUCKETS,
    hash_bits: int = 64,
) -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` of every row of ``docs``.

    Texts are equal when they are the same, byte by byte, after each stretch of ASCII white
    space has become one space; null counts as empty. Of equal texts the row with
    the smallest id stays, null ids last; of rows that share that id, such as
    repeated rows, one. ``keep_id`` is the id of the row that stays, ``text_sha256`` the digest of
    the text with single spaces. An empty table gives an empty result; other columns
    are not read. Hashes only deal texts out: equality is decided on whole texts (``hash_bits``
    below 64 makes hashes collide, for tests). A group of copies of any size meets as one entry
    for each filled table of a task.
    """
    rows = docs.select("doc_id", "text").withColumn("row", F.monotonically_increasing_id())
    members, classes = _classes(rows, own_bytes, bucket_bytes, most_buckets, hash_bits)
    if classes is None:
        classes = members.select("rep", *[F.lit(None).alias(c) for c in _CLASS]).limit(0)
    return members.join(classes, "rep").select(
        "doc_id",
        F.col("least").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("row") == F.col("least_row")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )


def drop_exact_duplicates(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one row of each group of equal texts left, chosen as in ``exact_duplicates``; columns keep their names."""
    row, out = free_name(docs.columns, "_row"), free_name(docs.columns, "_keep")
    marked = stored(docs.withColumn(row, F.monotonically_increasing_id()), "marked")
    limits = {"own_bytes": OWN_BYTES, "bucket_bytes": BUCKET_BYTES, "most_buckets": MOST_BUCKETS, "hash_bits": 64} | options
    rows = marked.select("doc_id", "text", F.col(row).alias("row"))
    _, classes = _classes(rows, **limits)
    names = [F.col(f"`{n}`") for n in docs.columns]
    if classes is None:
        return marked.select(*names)
    keep = classes.select(F.col("least_row").alias(out)).distinct()
    return marked.join(keep, F.col(row) == F.col(out), "left_semi").select(*names)


def op13_exact(spark, sf_dir: str) -> DataFrame:
    """Which documents are equal, and which of them stay."""
    return exact_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP13_SQL = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t, row_number() OVER () AS row
  FROM documents),
g AS (SELECT t, first(doc_id ORDER BY doc_id NULLS LAST, row) AS keep_id, first(row ORDER BY doc_id NULLS LAST, row) AS keep_row,
  count(*) AS group_size FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size, row = keep_row AS kept, sha256(t) AS text_sha256 FROM d JOIN g USING (t)
"""

QUERIES = {"op13_exact": op13_exact}
ORACLES = {"op13_exact": OP13_SQL}
