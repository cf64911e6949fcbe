"""Quality by co-training: one classifier sees the text, the other the page's metadata.

In each round a view labels those unlabelled documents that it is sure of for the
other view to learn from. In the end each view's log odds are calibrated on
labelled documents it was not fitted on, and added up.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from colmask.llm.batches import slices
from colmask.llm.learning import fit_logistic, held_out, sigmoid, sum_batch, summed_rows
from colmask.llm.rules import quality_labels
from colmask.llm.words import split_words
from colmask.session import stored

#: The classifiers are fitted on at most this many labelled documents, drawn by a hash of their ids.
LABELLED_SAMPLE = 6000
ROUNDS = 4
#: Of all unlabelled documents, a view labels in a round those it is surest of, this many,
ROUND_ROWS = 300
#: if it is at least this sure.
SURE = 0.95
#: A pseudo-label's weight next to a label's 1.
PSEUDO_WEIGHT = 0.5
RIDGE = 1.0
WORD_BUCKETS = 128
SOURCE_BUCKETS = 64
LANG_BUCKETS = 16

_PUNCTUATION = [c for c in range(33, 127) if not chr(c).isalnum()]


def text_view(text: bytes | None) -> np.ndarray:
    """What the text says of itself: sizes, shares of characters, repetition, and hashed words."""
    data = text or b""
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256).astype(float)
    words = split_words(data)
    lines = [line for line in data.split(b"\n") if line.strip()]
    size, n = max(1, len(data)), max(1, len(words))
    buckets = np.bincount([zlib.crc32(w) % WORD_BUCKETS for w in words], minlength=WORD_BUCKETS)
    head = [
        math.log1p(len(data)), math.log1p(len(words)), math.log1p(len(lines)),
        counts[65:91].sum() / size, counts[48:58].sum() / size, counts[128:].sum() / size, counts[10] / size,
        counts[_PUNCTUATION].sum() / size, sum(map(len, words)) / n, len(set(words)) / n,
        1 - len(set(lines)) / max(1, len(lines)),
    ]
    return np.concatenate([head, counts[_PUNCTUATION] / size, buckets / n])


def metadata_view(lang: str | None, source: str | None, n_chars: int | None) -> np.ndarray:
    """What is known of the page without its text: language, source, and the size stated for it."""
    out = np.zeros(LANG_BUCKETS + SOURCE_BUCKETS + 2)
    out[zlib.crc32((lang or "").encode()) % LANG_BUCKETS] = 1
    out[LANG_BUCKETS + zlib.crc32((source or "").encode()) % SOURCE_BUCKETS] = 1
    out[-2] = math.log1p(max(0, n_chars or 0))
    out[-1] = n_chars is None
    return out


@dataclass(frozen=True)
class View:
    """A scaled logistic regression whose log odds are calibrated by ``slope`` and ``shift``."""

    mean: np.ndarray
    scale: np.ndarray
    beta: np.ndarray
    slope: float = 1.0
    shift: float = 0.0

    def raw(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -5, 5)
        return self.beta[0] + z @ self.beta[1:]

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        return self.shift + self.slope * self.raw(x)

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, weight: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> "View":
        z = np.clip((x - mean) / scale, -5, 5)
        return cls(mean, scale, fit_logistic(z, y, weight, RIDGE))

    def calibrated(self, x: np.ndarray, y: np.ndarray) -> "View":
        """With log odds refitted to labelled rows that the view was not fitted on (a falling line becomes flat)."""
        beta = fit_logistic(self.raw(x)[:, None], y, np.ones(len(y)), 1e-2)
        if beta[1] < 0:
            share = (y.sum() + 1) / (len(y) + 2)
            beta = np.array([math.log(share / (1 - share)), 0.0])
        return View(self.mean, self.scale, self.beta, float(beta[1]), float(beta[0]))


@dataclass(frozen=True)
class CoTrained:
    """Both views, the log odds of quality before seeing either, and the rounds' numbers of pseudo-labels."""

    views: tuple[View, View] | None
    prior: float
    slope: float = 1.0
    shift: float = 0.0
    exchanged: tuple[tuple[int, int], ...] = ()

    def scores(self, x: list[np.ndarray]) -> list[np.ndarray]:
        """Scores of the text view, of the metadata view, and of both."""
        if self.views is None:
            return [np.full(len(x[0]), sigmoid(np.array(self.prior)))] * 3
        odds = [v.log_odds(part) for v, part in zip(self.views, x)]
        joint = self.shift + self.slope * (odds[0] + odds[1] - self.prior)
        return [sigmoid(o) for o in (*odds, joint)]


#: A document that a view is sure of: its key, the label, and its features of both views.
Pick = tuple[int, float, np.ndarray, np.ndarray]


def shares(share: float) -> dict[float, int]:
    """How many documents of each label a view picks in a round: as the labels suggest."""
    return {1.0: math.ceil(ROUND_ROWS * share), 0.0: math.ceil(ROUND_ROWS * (1 - share))}


def co_train(
    x: list[np.ndarray],
    y: np.ndarray,
    check: np.ndarray,
    frame: list[tuple[np.ndarray, np.ndarray]],
    draw: Callable[[tuple[View, View], dict[float, int], list[set[int]]], list[list[Pick]]],
) -> CoTrained:
    """Co-train on features ``x`` (text, metadata) of labelled rows and on what ``draw`` picks from unlabelled ones.

    ``frame`` has each view's means and deviations. ``draw(views, most, taken)`` gives for each view the
    documents it is surest of, ``most`` of a label, without those whose keys are ``taken``. ``check`` marks labelled rows that
    only calibrate. Without rows of both kinds, to fit and to calibrate, every score is the smoothed share of good rows.
    """
    share = (y.sum() + 1.5) / (len(y) + 2)
    prior = math.log(share / (1 - share)) if share < 1 else 30.0
    if len(set(y[~check])) < 2 or len(set(y[check])) < 2:
        return CoTrained(None, prior)
    # Pseudo-labels that each view learns from, by key.
    given: list[dict[int, Pick]] = [{}, {}]

    def fitted(v: int) -> View:
        picks = list(given[v].values())
        features = np.concatenate([x[v][~check], *(p[2 + v][None] for p in picks)])
        labels = np.concatenate([y[~check], [p[1] for p in picks]])
        weight = np.concatenate([np.ones((~check).sum()), np.full(len(picks), PSEUDO_WEIGHT)])
        return View.fit(features, labels, weight, *frame[v]).calibrated(x[v][check], y[check])

    exchanged = []
    for _ in range(ROUNDS):
        found = draw((fitted(0), fitted(1)), shares(share), [set(given[1]), set(given[0])])
        for v in (0, 1):
            given[1 - v].update((p[0], p) for p in found[v])
        exchanged.append((len(found[0]), len(found[1])))
        if not any(found):
            break
    views = (fitted(0), fitted(1))
    odds = [v.log_odds(part[check]) for v, part in zip(views, x)]
    joint = fit_logistic((odds[0] + odds[1] - prior)[:, None], y[check], np.ones(check.sum()), 1e-2)
    return CoTrained(views, prior, max(0.0, float(joint[1])), float(joint[0]), tuple(exchanged))


def _needed(docs: DataFrame) -> DataFrame:
    """Id, text and metadata; a metadata column that the table lacks is null."""
    have = set(docs.columns)
    kinds = {"lang": "string", "source": "string", "n_chars": "bigint"}
    return docs.select(
        "doc_id", "text", *[(F.col(c) if c in have else F.lit(None)).cast(k).alias(c) for c, k in kinds.items()]
    )


_WIDTHS = len(text_view(b"")), len(metadata_view(None, None, None))


def _table(rows: Sequence, v: int) -> np.ndarray:
    return np.frombuffer(b"".join(map(bytes, rows)), np.float32).reshape(-1, _WIDTHS[v]).astype(float)


def quality_features(docs: DataFrame) -> DataFrame:
    """``doc_id, held, key, one, two``: both views of every document as 32-bit numbers, and a hash of them; stored."""
    kind = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, held boolean, key bigint, one binary, two binary"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, 1):
                one = [text_view(t).astype(np.float32).tobytes() for t in texts]
                meta = zip(*(part.column(i).to_pylist() for i in (2, 3, 4)))
                two = [metadata_view(*m).astype(np.float32).tobytes() for m in meta]
                keys = np.array([xxhash.xxh64_intdigest(a + b) for a, b in zip(one, two)], np.uint64).view(np.int64)
                columns = [part.column(0), part.column(5), pa.array(keys), pa.array(one, pa.binary()), pa.array(two, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "held", "key", "one", "two"])

    # Unknown ids are not learned from.
    held = (F.col("doc_id").isNull() | held_out()).alias("held")
    return stored(_needed(docs).select("*", held).mapInArrow(run, kind), "features")


def _frames(features: DataFrame) -> list[tuple[np.ndarray, np.ndarray]]:
    """Means and deviations of both views over all documents."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, [np.zeros(w) for w in _WIDTHS for _ in (1, 2)]
        for batch in batches:
            n += batch.num_rows
            for v in (0, 1):
                x = _table(batch.column(v).to_pylist(), v)
                sums[2 * v] += x.sum(axis=0)
                sums[2 * v + 1] += (x**2).sum(axis=0)
        if n:
            yield sum_batch(list(range(5)), [*sums, np.array([float(n)])])

    found = summed_rows(features.select("one", "two").mapInArrow(run, "i int, row binary"), "<f8")
    if not found:
        return [(np.zeros(w), np.ones(w)) for w in _WIDTHS]
    means = [found[2 * v] / found[4][0] for v in (0, 1)]
    return [(m, np.sqrt(np.maximum(found[2 * v + 1] / found[4][0] - m**2, 0)) + 1e-6) for v, m in enumerate(means)]


def surest(features: DataFrame, known: DataFrame):
    """The ``draw`` of ``co_train`` over all documents that have no label and are not held out.

    A pass over the features scores them and hands on keys of those a view is sure of; documents of equal features
    count once, and equal chances go by key. Only the picks come to the driver.
    """
    free = features.filter(~F.col("held"))

    def draw(views: tuple[View, View], most: dict[float, int], taken: list[set[int]]) -> list[list[Pick]]:
        shared = features.sparkSession.sparkContext.broadcast((views, [np.array(sorted(t), np.int64) for t in taken]))

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            both, out = shared.value
            for batch in batches:
                if not batch.num_rows:
                    continue
                keys = batch.column(1).to_numpy()
                for v in (0, 1):
                    chance = sigmoid(both[v].log_odds(_table(batch.column(2 + v).to_pylist(), v)))
                    sure = np.flatnonzero((np.maximum(chance, 1 - chance) >= SURE) & ~np.isin(keys, out[v]))
                    good = chance[sure] >= 0.5
                    columns = [
                        batch.column(0).take(pa.array(sure)), pa.array(keys[sure]), pa.array(np.full(len(sure), v, np.int32)),
                        pa.array(good.astype(float)), pa.array(np.where(good, chance[sure], 1 - chance[sure])),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "key", "v", "label", "chance"])

        kind = f"doc_id {features.schema['doc_id'].dataType.simpleString()}, key bigint, v int, label double, chance double"
        sure = free.select("doc_id", "key", "one", "two").mapInArrow(run, kind).join(known, "doc_id", "left_anti")
        once = sure.groupBy("v", "label", "key").agg(F.max("chance").alias("chance"))
        place = F.row_number().over(Window.partitionBy("v", "label").orderBy(F.col("chance").desc(), "key"))
        enough = F.when(F.col("label") == 1.0, most[1.0]).otherwise(most[0.0])
        picks = stored(once.withColumn("place", place).filter(F.col("place") <= enough), "picks")
        # A few hundred picks for each view and label.
        rows = free.select("key", "one", "two").join(F.broadcast(picks), "key")
        rows = rows.groupBy("v", "label", "place", "key").agg(F.min(F.struct("one", "two")).alias("x")).collect()
        out: list[list[Pick]] = [[], []]
        for r in sorted(rows, key=lambda r: (r["v"], -r["label"], r["place"])):
            out[r["v"]].append((r["key"], r["label"], _table([r["x"]["one"]], 0)[0], _table([r["x"]["two"]], 1)[0]))
        return out

    return draw


def train_quality(features: DataFrame, labels: DataFrame) -> CoTrained:
    """Co-train outside the held-out fold; every fifth sampled label only calibrates.

    Labelled documents are a bounded sample, drawn by a hash of their ids; unlabelled ones all take part in every round.
    """
    known = quality_labels(labels).filter(~held_out()).select("doc_id", F.col("quality").cast("int").alias("quality"))
    there = known.join(features.select("doc_id"), "doc_id", "left_semi")
    drawn = there.orderBy(F.xxhash64("doc_id"), F.col("doc_id")).limit(LABELLED_SAMPLE)
    made = features.join(F.broadcast(drawn), "doc_id").groupBy("doc_id", "quality").agg(F.min(F.struct("one", "two")).alias("made"))
    sampled = sorted(
        made.select("doc_id", "quality", "made.*").collect(),  # a row for each drawn id at most
        key=lambda r: (zlib.crc32(str(r["doc_id"]).encode()), r["doc_id"]),
    )
    x = [_table([r[name] for r in sampled], v) for v, name in enumerate(("one", "two"))]
    y = np.array([float(r["quality"] != 0) for r in sampled])
    return co_train(x, y, np.arange(len(y)) % 5 == 0, _frames(features), surest(features, known))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, text_score, metadata_score, score, predicted`` of every document.

    Scores are chances of quality 1; ``predicted`` is 1 from a half on. Labels are
    learned from outside the held-out fold only, and id and labels are no inputs of a score.
    Null and empty texts, and missing metadata, have features of their own. Repeated rows each get a
    row, an empty table gives an empty result. Texts are read whole, once: their features are
    stored. What is shuffled are keys of documents that a view is sure of, and labels.
    """
    features = quality_features(docs)
    shared = docs.sparkSession.sparkContext.broadcast(train_quality(features, labels))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            made = shared.value.scores([_table(batch.column(1 + v).to_pylist(), v) for v in (0, 1)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *map(pa.array, made)], names=["doc_id", "text_score", "metadata_score", "score"]
            )

    kind = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, text_score double, metadata_score double, score double"
    return features.select("doc_id", "one", "two").mapInArrow(run, kind).select(
        "doc_id",
        held_out().alias("held_out"),
        "text_score",
        "metadata_score",
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op2_quality(spark, sf_dir: str) -> DataFrame:
    """Quality scores of all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return quality_scores(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


QUERIES = {"op2_quality": op2_quality}
ORACLES: dict[str, str] = {}
