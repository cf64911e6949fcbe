"""Toxic spans by a linear-chain conditional random field over words.

Labels say whether a document is toxic. A word of a toxic document is labelled
toxic if its form, beginning or ending turns up in far more toxic than clean
documents; all other words are labelled clean. The field is trained on these
labelled words, and forward-backward gives each word's probability, from which
come a document's score and the offsets of what offends.
"""

from __future__ import annotations

import heapq
import math
import re
import zlib
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from colmask.functions.names import free_name
from colmask.llm.batches import slices
from colmask.llm.learning import fit_logistic, held_out
from colmask.llm.words import FOLD, split_words
from colmask.session import stored

#: The field is fitted on at most this many toxic and clean labelled texts, each once, drawn by a hash of their ids,
TOXIC_SAMPLE = 1000
CLEAN_SAMPLE = 3000
#: as far as the texts of a kind have this many characters in sum. Scoring takes whole texts of any length.
SAMPLE_CHARS = 12_000_000
#: In training the chain of a longer text is cut after this many words; all of them take part.
STRETCH = 512
#: A word form or part labels words as toxic if it is this many times as frequent in toxic as in clean documents
MIN_RATIO = 20.0
#: and its spread over the two kinds has this log likelihood ratio against chance (15: about 4e-8).
MIN_EVIDENCE = 15.0
#: Hashes that tell copies among the sampled documents.
SKETCH = 16
#: Features in fewer sampled documents get no weight.
MIN_FEATURE_DOCS = 3
STEPS = 40
#: Bytes of words whose emissions a task remembers; beyond, it forgets all and starts anew. Longer words are not remembered.
CACHE_BYTES = 24 << 20
CACHE_WORD = 64
#: What a remembered word takes beside its own bytes.
CACHE_ENTRY = 160
#: UTF-8 bytes of texts that are scored together: texts of like length share the steps of forward-backward.
TEXT_BYTES = 8 << 20
#: Padded places that one call of forward-backward takes.
PADDED = 1 << 20
SPANS = "array<struct<start:int,stop:int,p:double>>"


def features(word: bytes) -> tuple[bytes, ...]:
    """The word, its beginnings of 3 to 5 bytes and its endings of 3 and 4, each with its kind in front."""
    return (b"w" + word, b"3" + word[:3], b"4" + word[:4], b"5" + word[:5], b"c" + word[-3:], b"d" + word[-4:])


@dataclass(frozen=True)
class Field:
    """Weights of features for the label toxic, transitions (log, from, to), and the document's logistic."""

    weights: dict[bytes, float]
    bias: float
    moves: np.ndarray
    scale: tuple[float, float, float]
    #: How many of a clean text's words are called toxic, as a share.
    base: float = 0.0

    def emission(self, word: bytes) -> float:
        get = self.weights.get
        return min(30.0, max(-30.0, self.bias + sum(get(f, 0.0) for f in features(word))))

    def score(self, signs: np.ndarray) -> np.ndarray:
        """Document scores from rows of ``document_signs``."""
        bias, a, b = self.scale
        return 1 / (1 + np.exp(-(bias + a * signs[:, 0] + b * signs[:, 1])))


def document_signs(chances: Sequence[np.ndarray], base: float) -> np.ndarray:
    """Two signs of toxicity a document, neither of which grows with the length of a clean text.

    The first is the largest probability of a word, up to a half: short of calling a word toxic. The second is the logarithm of one plus
    the toxic words (probability of at least a half) beyond what chance makes of as
    many clean words: their expected number and three times its root.
    """
    out = np.zeros((len(chances), 2))
    for i, c in enumerate(chances):
        by_chance = base * len(c)
        hits = c[c >= 0.5].sum()
        out[i] = min(0.5, c.max(initial=0.0)), math.log1p(max(0.0, hits - by_chance - 3 * math.sqrt(by_chance)))
    return out


class Emissions:
    """Emissions of words, the usual ones remembered within ``most`` bytes."""

    def __init__(self, model: Field, most: int = CACHE_BYTES):
        self.model, self.most = model, most
        self.known: dict[bytes, float] = {}
        self.size = 0

    def __call__(self, words: list[bytes]) -> np.ndarray:
        here: dict[bytes, float] = {}
        for w in set(words).difference(self.known):
            if len(w) > CACHE_WORD or self.size + len(w) + CACHE_ENTRY > self.most:
                here[w] = self.model.emission(w)
            else:
                self.known[w] = self.model.emission(w)
                self.size += len(w) + CACHE_ENTRY
        out = np.fromiter((self.known[w] if w in self.known else here[w] for w in words), np.float32, len(words))
        if here and self.size + CACHE_WORD + CACHE_ENTRY > self.most:
            self.known, self.size = {}, 0
        return out


def _pack(lengths: np.ndarray) -> Iterator[np.ndarray]:
    """Indexes of texts in groups of like length whose padded size is bounded (or a single text)."""
    order = np.argsort(lengths, kind="stable")
    order = order[lengths[order] > 0]
    start = 0
    while start < len(order):
        stop = start + 1
        while stop < len(order) and lengths[order[stop]] * (stop + 1 - start) <= PADDED:
            stop += 1
        yield order[start:stop]
        start = stop


def marginals(emissions: Sequence[np.ndarray], moves: np.ndarray, pairs: bool = False):
    """Each word's probability of being toxic, by forward-backward over many texts at a time.

    With ``pairs`` also the expected number of each transition, summed over all texts.
    """
    out: list[np.ndarray] = [np.zeros(0)] * len(emissions)
    expected = np.zeros((2, 2))
    m = np.exp(moves)
    for group in _pack(np.array([len(e) for e in emissions])):
        lengths = np.array([len(emissions[i]) for i in group])
        longest = int(lengths[-1])
        # Places by time, then text. Texts are in order of length, so those still going are a slice at the end.
        odds = np.ones((longest, len(group)))
        for j, i in enumerate(group):
            odds[: lengths[j], j] = np.exp(emissions[i])
        begin = np.searchsorted(lengths, np.arange(longest), "right")
        ahead = np.empty_like(odds)
        a = odds[0] / (1 + odds[0])
        ahead[0] = a
        for t in range(1, longest):
            s = begin[t]
            p = a[s:]
            one = (m[0, 1] + (m[1, 1] - m[0, 1]) * p) * odds[t, s:]
            none = m[0, 0] + (m[1, 0] - m[0, 0]) * p
            a[s:] = one / (one + none)
            ahead[t, s:] = a[s:]
        both = np.empty_like(odds)
        back = np.full(len(group), 0.5)  # share of the label toxic in the backward message
        for t in range(longest - 1, -1, -1):
            s = begin[t]
            p, b = ahead[t, s:], back[s:]
            one, none = p * b, (1 - p) * (1 - b)
            both[t, s:] = one / (one + none)
            if t and pairs:
                q = ahead[t - 1, s:]
                o, f = odds[t, s:] * b, 1 - b
                w = np.stack([(1 - q) * m[0, 0] * f, (1 - q) * m[0, 1] * o, q * m[1, 0] * f, q * m[1, 1] * o])
                expected += (w / w.sum(axis=0)).sum(axis=1).reshape(2, 2)
            if t:
                one, none = odds[t, s:] * b, 1 - b
                to_one, to_none = m[1, 0] * none + m[1, 1] * one, m[0, 0] * none + m[0, 1] * one
                back[s:] = to_one / (to_one + to_none)
        for j, i in enumerate(group):
            out[i] = both[: lengths[j], j]
    return (out, expected) if pairs else out


def _telling(counts: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Which features mark toxic documents, from their numbers of clean and toxic documents."""
    n_toxic, n_clean = int(toxic.sum()), int((~toxic).sum())
    share = n_toxic / (n_toxic + n_clean)
    clean, seen = counts.astype(float)
    n = np.maximum(clean + seen, 1)
    ratio = (seen + 0.5) / (n_toxic + 1) / ((clean + 0.5) / (n_clean + 1))
    evidence = seen * np.log(np.maximum(seen, 1) / (n * share)) + clean * np.log(np.maximum(clean, 1) / (n * (1 - share)))
    return (ratio >= MIN_RATIO) & (seen > 0) & (evidence >= MIN_EVIDENCE)


def _sketch(words: list[bytes]) -> list[int]:
    """The smallest hashes of a text's three-word shingles."""
    return heapq.nsmallest(SKETCH, {zlib.crc32(b" ".join(words[i : i + 3])) for i in range(max(1, len(words) - 2))})


def fit_field(texts: list[bytes], toxic: Sequence[bool], n_toxic: int, n_clean: int) -> Field:
    """A field from sampled documents; ``n_toxic`` and ``n_clean`` are the counts they stand for.

    With no toxic or no clean document every score is the smoothed share of toxic ones. A near-copy of
    another sampled document is left out: it says nothing new about a word.
    """
    share = (n_toxic + 0.5) / (n_toxic + n_clean + 2)
    truth = np.array(toxic, bool)
    flat = Field({}, -30.0, np.zeros((2, 2)), (math.log(share / (1 - share)), 0.0, 0.0))
    if not truth.any() or truth.all():
        return flat
    # Words become numbers text by text: the sample is held as numbers only.
    types: dict[bytes, int] = {}
    seen_shingles: set[int] = set()
    ids, kept_truth = [], []
    for text, is_toxic in zip(texts, truth):
        words = split_words(text)
        sketch = _sketch(words)
        if 4 * sum(h in seen_shingles for h in sketch) < len(sketch):
            ids.append(np.fromiter((types.setdefault(w, len(types)) for w in words), np.int32, len(words)))
            kept_truth.append(is_toxic)
        seen_shingles.update(sketch)
    truth = np.array(kept_truth, bool)
    if not truth.any() or truth.all() or not types:
        return flat
    numbers: dict[bytes, int] = {}
    parts = np.array([[numbers.setdefault(f, len(numbers) + 1) for f in features(w)] for w in types], np.int32)
    counts = np.zeros((2, len(numbers) + 1), np.int64)
    for i, is_toxic in zip(ids, truth):
        if len(i):
            counts[int(is_toxic), np.unique(parts[np.unique(i)])] += 1
    marks = _telling(counts, truth)
    if not marks.any():
        return flat
    marked = marks[parts].any(axis=1)
    # Rare features share number 0, which has no weight.
    often = counts.sum(axis=0) >= MIN_FEATURE_DOCS
    renumbered = np.where(often, np.cumsum(often), 0).astype(np.int32)
    known = {f: int(renumbered[n]) for f, n in numbers.items() if often[n]}
    whole = renumbered[parts]
    del numbers, counts, parts
    # In training a part of the word forms, by their hash, lack their word, ending or long beginning, so that the
    # beginnings learn to tell forms that were never seen.
    draw = np.array([zlib.crc32(w) for w in types])
    parts = whole.copy()
    for bit, columns in ((1, [0]), (2, [4, 5]), (4, [3])):
        parts[np.ix_((draw & bit) > 0, columns)] = 0
    labels = [marked[i] & t for i, t in zip(ids, truth)]
    flat_ids, flat_labels = np.concatenate(ids), np.concatenate(labels)
    per_type = np.bincount(flat_ids, weights=flat_labels, minlength=len(types))
    seen_moves = np.zeros((2, 2))
    for y in labels:
        if len(y) > 1:
            np.add.at(seen_moves, (y[:-1].astype(int), y[1:].astype(int)), 1)

    weights = np.zeros(len(known) + 1)
    rate = (flat_labels.sum() + 1) / (len(flat_labels) + 2)
    bias = math.log(rate / (1 - rate))
    moves = np.zeros((2, 2))
    first, second = np.zeros(len(weights) + 5), np.zeros(len(weights) + 5)
    stretches = [i[a : a + STRETCH] for i in ids for a in range(0, len(i), STRETCH)]
    for step in range(1, STEPS + 1):
        by_type = np.clip(bias + weights[parts].sum(axis=1), -30, 30)
        chances, pairs = marginals([by_type[i] for i in stretches], moves, pairs=True)
        excess = per_type - np.bincount(flat_ids, weights=np.concatenate(chances), minlength=len(types))
        slope = np.concatenate([
            np.bincount(parts.ravel(), weights=np.repeat(excess, parts.shape[1]), minlength=len(weights)) - 0.5 * weights,
            [excess.sum()],
            (seen_moves - pairs).ravel() - 0.5 * moves.ravel(),
        ])
        slope[0] = 0.0
        first = 0.8 * first + 0.2 * slope
        second = 0.95 * second + 0.05 * slope**2
        move = 0.4 * (first / (1 - 0.8**step)) / (np.sqrt(second / (1 - 0.95**step)) + 1e-3)
        weights += move[: len(weights)]
        bias += move[len(weights)]
        moves = moves + move[len(weights) + 1 :].reshape(2, 2)
    by_type = np.clip(bias + weights[whole].sum(axis=1), -30, 30)
    parted = np.concatenate(marginals([by_type[i] for i in stretches], moves))
    chances = np.split(parted, np.cumsum([len(i) for i in ids])[:-1])
    clean = np.concatenate([c for c, t in zip(chances, truth) if not t])
    base = float((clean >= 0.5).sum() + 1) / (len(clean) + 1)
    stands_for = np.where(truth, n_toxic / truth.sum(), n_clean / (~truth).sum())
    scale = _fit_scale(document_signs(chances, base), truth, stands_for)
    kept = {f: float(weights[i]) for f, i in known.items() if abs(weights[i]) > 1e-3}
    return Field(kept, float(bias), moves, scale, base)


def _fit_scale(signs: np.ndarray, truth: np.ndarray, weight: np.ndarray) -> tuple[float, float, float]:
    """The document's logistic: no sign counts against toxicity, and without a toxic word a score is under a half."""
    used = [0, 1]
    while True:
        fitted = fit_logistic(signs[:, used], truth.astype(float), weight, 1e-2)
        against = [c for c, slope in zip(used, fitted[1:]) if slope < 0]
        if not against:
            break
        used = [c for c in used if c not in against]
    slopes = dict(zip(used, fitted[1:]))
    first, second = float(slopes.get(0, 0.0)), float(slopes.get(1, 0.0))
    return min(float(fitted[0]), -0.5 * first - 1e-3), first, second


def train_field(docs: DataFrame, labels: DataFrame) -> Field:
    """A field from the labelled documents outside the held-out fold, on the bounded sample named above."""
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out())
    known = known.groupBy("doc_id").agg(F.max(F.col("toxic") != 0).alias("is_toxic"))
    # Ids and hashes alone are joined and stored; of a repeated id the text with the smallest hash stands for it.
    there = docs.select("doc_id", F.xxhash64("text").alias("hash"), F.char_length("text").alias("chars")).join(known, "doc_id")
    there = there.groupBy("doc_id", "is_toxic").agg(F.min(F.when(F.col("chars").isNotNull(), F.struct("hash", "chars"))).alias("t"))
    there = stored(there.select("doc_id", "is_toxic", "t.hash", "t.chars"), "labelled")
    sizes = {r["is_toxic"]: r["n"] for r in there.groupBy("is_toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    # Drawn are only texts that can take part, each once.
    once = there.filter(F.col("chars") <= SAMPLE_CHARS).groupBy("is_toxic", "hash").agg(
        F.min(F.struct(F.xxhash64("doc_id").alias("place"), "doc_id", "chars")).alias("first")
    )
    drawn = None
    for kind, most in ((True, TOXIC_SAMPLE), (False, CLEAN_SAMPLE)):
        part = once.filter(F.col("is_toxic") == kind).orderBy("first").limit(most)
        so_far = F.sum("first.chars").over(Window.orderBy("first").rowsBetween(Window.unboundedPreceding, 0))
        part = part.withColumn("so_far", so_far).filter(F.col("so_far") <= SAMPLE_CHARS)
        part = part.select("first.doc_id", "is_toxic", "hash")
        drawn = part if drawn is None else drawn.unionByName(part)
    # The drawn ids are bounded, so documents are looked up in them without a shuffle of texts.
    mine = docs.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")
    mine = mine.filter(F.xxhash64("text") == F.col("hash")).groupBy("doc_id", "is_toxic").agg(F.min("text").alias("text"))
    texts, toxic = [], []
    for row in mine.select(F.encode("text", "utf-8").alias("text"), "is_toxic").orderBy("doc_id").toLocalIterator():
        texts.append(bytes(row["text"]))
        toxic.append(row["is_toxic"])
    return fit_field(texts, toxic, sizes.get(True, 0), sizes.get(False, 0))


_WORD = re.compile(rb"[^ ]+")


def _spans(text: bytes, chances: np.ndarray) -> list[dict]:
    """Code point offsets of stretches of words with a probability of at least a half."""
    out: list[dict] = []
    hits = np.flatnonzero(chances >= 0.5)
    if not len(hits):
        return out
    at = [m.span() for m in _WORD.finditer(text.translate(FOLD))]
    chars = np.cumsum(np.concatenate([[0], (np.frombuffer(text, np.uint8) & 0xC0) != 0x80]))
    for run in np.split(hits, np.flatnonzero(np.diff(hits) > 1) + 1):
        start, stop = at[run[0]][0], at[run[-1]][1]
        # chars counts the code points that begin before a byte.
        out.append({"start": int(chars[start]), "stop": int(chars[stop]), "p": float(chances[run].max())})
    return out


def score_texts(docs: DataFrame, field: Field, score: str, spans: str) -> DataFrame:
    """``docs`` with the toxicity ``score`` of each whole text and the ``spans`` (code point offsets) that offend.

    Null and empty texts have no words: they get the score of a text without
    any sign of toxicity, and no spans. All columns are kept; nothing is shuffled.
    """
    at = docs.columns.index("text")
    shared = docs.sparkSession.sparkContext.broadcast(field)
    schema = docs.select("*", F.lit(0.0).alias(score), F.lit(None).cast(SPANS).alias(spans)).schema
    kind = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("p", pa.float64())]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        emissions = Emissions(model)

        for batch in batches:
            for part, texts in slices(batch, at, TEXT_BYTES):
                chances = marginals([emissions(split_words(t)) for t in texts], model.moves)
                found = pa.array([_spans(t or b"", c) for t, c in zip(texts, chances)], kind)
                columns = [*part.columns, pa.array(model.score(document_signs(chances, model.base))), found]
                yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, score, spans])

    return docs.mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted, spans`` of every document.

    Scores see nothing but the text. Repeated rows each get a row, null ids
    count as held out, an empty table gives an empty result. Ids with several labels are toxic if one label
    says so. Texts of equal words get equal scores.
    """
    field = train_field(docs, labels)
    scored = score_texts(docs.select("doc_id", "text"), field, "score", "spans")
    return scored.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "spans"
    )


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` with a score under a half, with the columns of ``docs``."""
    score, spans = free_name(docs.columns, "_score"), free_name(docs.columns, "_spans")
    return score_texts(docs, train_field(docs, labels), score, spans).filter(F.col(score) < 0.5).drop(score, spans)


def op7_toxicity(spark, sf_dir: str) -> DataFrame:
    """Scores of all documents, learned outside the held-out fold."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).drop("spans")


QUERIES = {"op7_toxicity": op7_toxicity}
ORACLES: dict[str, str] = {}
