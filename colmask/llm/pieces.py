"""Unigram encoding into pieces, and decoding, with the vocabulary of a SentencePiece model.

Pieces lie in a double-array trie over UTF-8 bytes, in which the whitespace
marker is the byte of a space. Viterbi picks the segmentation with the largest
sum of log scores. Many texts are cut at once: the trie is walked from all places
of all distinct words together, and the best scores are filled in place by place.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colmask.llm.batches import slices

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARKER = "▁"
#: A character without a piece of its own costs this much more than the rarest piece.
FALLBACK_COST = 10.0
#: Places tried for the children of a trie node before they are put at the end.
TRIES = 64
#: Bytes of words and their pieces that a task remembers; beyond, it forgets all and starts anew.
CACHE_BYTES = 48 << 20
#: Longer words are not remembered.
CACHE_WORD = 64
#: What a remembered word takes beside its own bytes and those of its pieces.
CACHE_ENTRY = 160
#: Words of more bytes are cut by themselves.
LONG_WORD = 2048
#: Bytes of distinct words that are cut at once.
CUT_BYTES = 1 << 18
#: Words of neighbouring texts that are looked up together.
WORDS_AT_ONCE = 200_000


@dataclass(frozen=True)
class Trie:
    """Double-array trie: from node ``s`` byte ``c`` leads to ``t = base[s] + c + 1`` if ``check[t] == s``."""

    base: np.ndarray
    check: np.ndarray
    value: np.ndarray

    @classmethod
    def of(cls, keys: dict[bytes, int]) -> "Trie":
        children: list[dict[int, int]] = [{}]
        values = [-1]
        for key, value in keys.items():
            node = 0
            for c in key:
                if c not in children[node]:
                    children[node][c] = len(children)
                    children.append({})
                    values.append(-1)
                node = children[node][c]
            values[node] = value
        base, check, value = [0], [-1], [values[0]]
        taken = bytearray(b"\x01")
        slots = [(0, 0)]
        hole = near_end = 257  # above the largest code, so that no place is below 0
        for at, node in slots:
            if not children[node]:
                continue
            codes = [c + 1 for c in sorted(children[node])]
            while hole < len(taken) and taken[hole]:
                hole += 1
            # An only child fills the first hole; more children are tried at a few places and else put at the end.
            place = max(0, (hole if len(codes) == 1 else max(hole, near_end)) - codes[0])
            tries = 0
            while any(place + c < len(taken) and taken[place + c] for c in codes):
                tries += 1
                place = place + 1 if tries < TRIES or len(codes) == 1 else max(place + 1, len(taken) - codes[0])
            if tries >= TRIES // 4:
                near_end = max(near_end, place + codes[0] - 256)
            more = place + codes[-1] + 1 - len(taken)
            if more > 0:
                taken += bytes(more)
                base += [0] * more
                check += [-1] * more
                value += [-1] * more
            base[at] = place
            for code in codes:
                to, child = place + code, children[node][code - 1]
                taken[to], check[to], value[to] = 1, at, values[child]
                slots.append((to, child))
        # Any byte may be tried at the last node.
        pad = 257
        base, check, value = (
            np.array(x + [f] * pad, np.int64) for x, f in ((base, 0), (check, -1), (value, -1))
        )
        return cls(base, check, value)


@dataclass(frozen=True)
class Vocabulary:
    """Pieces as bytes (marker as a space), their log scores, and the ids of the 256 byte pieces."""

    pieces: list[bytes]
    scores: np.ndarray
    byte_ids: np.ndarray
    trie: Trie

    @classmethod
    def load(cls, path: str = MODEL) -> "Vocabulary":
        """From a SentencePiece model file.

        Log scores are the file's. Where those are merge ranks (0, -1, -2, ...), as in
        models of merged pairs, the log score follows Zipf's law: -ln(rank + 1).
        """
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces: list[bytes] = []
        byte_ids = np.full(256, -1, np.int32)
        normal: list[int] = []
        for i in range(model.get_piece_size()):
            name = model.id_to_piece(i)
            if model.is_byte(i):
                byte_ids[int(name[1:-1], 16)] = i
                pieces.append(bytes([int(name[1:-1], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                pieces.append(b"")
            else:
                pieces.append(name.replace(MARKER, " ").encode())
                normal.append(i)
        if (byte_ids < 0).any():
            raise ValueError("the model has no byte pieces to fall back to")
        return cls.of(pieces, {i: model.get_score(i) for i in normal}, byte_ids)

    @classmethod
    def of(cls, pieces: list[bytes], given: dict[int, float], byte_ids: np.ndarray) -> "Vocabulary":
        # Scores of longer pieces are 0, -1, -2, ... exactly if they are merge ranks.
        raw = [s for s in given.values()]
        ranks = all(s == int(s) for s in raw) and min(raw, default=0) <= -len(raw) / 2
        scores = np.zeros(len(pieces))
        for i, s in given.items():
            scores[i] = -np.log1p(-s) if ranks else s
        if ranks:
            # Single characters that no merge made have no rank: they come last.
            lowest = -np.log1p(len(raw))
            for i in given:
                scores[i] = max(scores[i], lowest)
        return cls(pieces, scores, byte_ids, Trie.of({pieces[i]: i for i in given if pieces[i]}))

    @cached_property
    def trie_lists(self) -> tuple[list[int], list[int], list[int]]:
        return self.trie.base.tolist(), self.trie.check.tolist(), self.trie.value.tolist()

    @cached_property
    def score_list(self) -> list[float]:
        return self.scores.tolist()

    @cached_property
    def fallback(self) -> float:
        return float(self.scores.min()) - FALLBACK_COST

    @cached_property
    def words(self) -> re.Pattern:
        """Cuts a text where no piece can reach across.

        Before a space that follows another character, unless a piece has a space inside; around ASCII bytes that
        are in no longer piece.
        """
        if any(b" " in p.lstrip(b" ") for p in self.pieces):
            return re.compile(rb"(?s).+")
        joined = {c for p in self.pieces if len(p) > 1 for c in p}
        alone = b"".join(re.escape(bytes([c])) for c in range(128) if c != 32 and c not in joined)
        if not alone:
            return re.compile(rb" *[^ ]+| +")
        return re.compile(rb" *[^ " + alone + rb"]+| +|[" + alone + rb"]")


def cut(words: list[bytes], vocab: Vocabulary) -> list[bytes]:
    """The best pieces of each word (not empty), as the bytes of 32-bit ids.

    Of segmentations with equal scores the one whose last piece is longest is taken, and so on backwards.
    """
    trie = vocab.trie
    text = np.frombuffer(b"".join(words), np.uint8)
    lengths = np.array([len(w) for w in words])
    firsts = np.cumsum(lengths) - lengths
    unit = np.repeat(np.arange(len(words)), lengths)
    end = (firsts + lengths)[unit]
    begins = np.flatnonzero((text & 0xC0) != 0x80)
    if len(words) and not np.isin(firsts, begins).all():
        raise ValueError("a word begins inside a character")
    next_begin = np.append(begins[1:], len(text))

    # All pieces from all places.
    starts, stops, ids = [], [], []
    alone = np.zeros(len(text), bool)
    char_stop = np.zeros(len(text), np.int64)
    char_stop[begins] = next_begin
    code = text.astype(np.int64) + 1
    at, node, till, depth = begins, np.zeros(len(begins), np.int64), end[begins], 0
    while len(at):
        to = trie.base.take(node) + code.take(at + depth)
        goes = np.flatnonzero(trie.check.take(to) == node)
        at, node, till = at.take(goes), to.take(goes), till.take(goes)
        depth += 1
        value = trie.value.take(node)
        whole = np.flatnonzero(value >= 0)
        start = at.take(whole)
        starts.append(start)
        stops.append(start + depth)
        ids.append(value.take(whole))
        alone[start[char_stop.take(start) == start + depth]] = True
        inside = np.flatnonzero(at + depth < till)
        at, node, till = at.take(inside), node.take(inside), till.take(inside)
    lone = begins[~alone[begins]]
    starts.append(lone)
    stops.append(char_stop[lone])
    ids.append(np.full(len(lone), -1, np.int64))
    start, stop, piece = np.concatenate(starts), np.concatenate(stops), np.concatenate(ids)
    gain = np.where(piece >= 0, vocab.scores[piece], vocab.fallback)

    # Best score of each place: by the places' distance from the word's begin, longer pieces first. The pieces
    # of one length that end at one distance have different ends, so each such group is one step.
    owner = unit[start]
    size = stop - start
    wide = int(size.max(initial=0)) + 1
    rank = (stop - firsts[owner]) * wide + (wide - 1 - size)
    rank = rank.astype(np.uint16) if rank.max(initial=0) < 1 << 16 else rank
    order = np.argsort(rank, kind="stable")
    rank, piece, gain = rank[order], piece[order], gain[order]
    source = (start + owner)[order]
    target = source + size[order]
    best = np.full(len(text) + len(words), -np.inf)
    best[firsts + np.arange(len(words))] = 0.0
    via = np.full(len(best), -1, np.int64)
    cuts = np.flatnonzero(np.diff(rank)) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(rank)]):
        total, to = best[source[a:b]] + gain[a:b], target[a:b]
        better = total > best[to]
        to = to[better]
        best[to] = total[better]
        via[to] = np.flatnonzero(better) + a

    # Back from the ends, all words at once.
    here = firsts + lengths + np.arange(len(words))
    going = np.arange(len(words))
    steps, by = [], []
    while len(going):
        edge = via[here]
        steps.append(edge)
        by.append(going)
        here = source[edge]
        left = here > firsts[going] + going
        here, going = here[left], going[left]
    if not steps:
        return []
    edges, words_of = np.concatenate(steps), np.concatenate(by)
    # Steps go backwards: the last comes first.
    order = np.argsort(words_of[::-1], kind="stable")
    edges, words_of = edges[::-1][order], words_of[::-1][order]
    begin, size = source[edges] - words_of, target[edges] - source[edges]
    widths = np.where(piece[edges] >= 0, 1, size)
    out = np.repeat(piece[edges], widths)
    lost = np.flatnonzero(out < 0)
    if len(lost):
        inside = np.arange(len(out)) - np.repeat(np.cumsum(widths) - widths, widths)
        out[lost] = vocab.byte_ids[text[np.repeat(begin, widths)[lost] + inside[lost]]]
    counts = np.bincount(words_of, weights=widths, minlength=len(words)).astype(np.int64)
    raw, marks = out.astype(np.int32).tobytes(), (4 * np.cumsum(counts)).tolist()
    return [raw[a:b] for a, b in zip([0, *marks], marks)]


def cut_long(word: bytes, vocab: Vocabulary) -> bytes:
    """``cut`` for one long word: the same scores and ties, place by place.

    ``cut`` makes a step for each distance from a word's begin, which pays only where many words share it.
    """
    base, check, value = vocab.trie_lists
    scores, n = vocab.score_list, len(word)
    best, source, piece = [-math.inf] * (n + 1), [0] * (n + 1), [-1] * (n + 1)
    best[0] = 0.0
    for i in range(n):
        if word[i] & 0xC0 == 0x80:
            continue
        after = i + 1
        while after < n and word[after] & 0xC0 == 0x80:
            after += 1
        node, alone, so_far = 0, False, best[i]
        for j in range(i, n):
            to = base[node] + word[j] + 1
            if check[to] != node:
                break
            node, v = to, value[to]
            if v >= 0:
                alone |= j + 1 == after
                total = so_far + scores[v]
                if total > best[j + 1]:
                    best[j + 1], source[j + 1], piece[j + 1] = total, i, v
        if not alone and so_far + vocab.fallback > best[after]:
            best[after], source[after], piece[after] = so_far + vocab.fallback, i, -1
    out: list[int] = []
    at = n
    while at:
        start = source[at]
        out += [piece[at]] if piece[at] >= 0 else [int(vocab.byte_ids[b]) for b in reversed(word[start:at])]
        at = start
    return np.array(out[::-1], np.int32).tobytes()


class Encoder:
    """Encodes texts; remembers the pieces of usual words it has seen."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self.known: dict[bytes, bytes] = {}
        self.size = 0

    def _pieces(self, words: set[bytes]) -> dict[bytes, bytes]:
        """The pieces of these words."""
        out = {w: self.known[w] for w in words.intersection(self.known)}
        part, size = [], 0
        for word in words.difference(out):
            if len(word) > LONG_WORD:
                out[word] = cut_long(word, self.vocab)
                continue
            part.append(word)
            size += len(word)
            if size >= CUT_BYTES:
                self._learn(part, out)
                part, size = [], 0
        if part:
            self._learn(part, out)
        return out

    def _learn(self, words: list[bytes], out: dict[bytes, bytes]) -> None:
        for word, pieces in zip(words, cut(words, self.vocab)):
            out[word] = pieces
            if len(word) <= CACHE_WORD:
                taken = len(word) + len(pieces) + CACHE_ENTRY
                if self.size + taken > CACHE_BYTES:
                    self.known, self.size = {}, 0
                self.known[word] = pieces
                self.size += taken

    def encode(self, texts: list[bytes | None]) -> list[bytes | None]:
        """Ids of each whole text as bytes; no ids for an empty text, None for null."""
        out: list[bytes | None] = []
        find = self.vocab.words.findall
        held: list[list[bytes] | None] = []
        n = 0
        for i, text in enumerate(texts):
            # A text begins with a marker, as after a space.
            held.append(None if text is None else find(b" " + text) if text else [])
            n += len(held[-1] or ())
            if n >= WORDS_AT_ONCE or i == len(texts) - 1:
                words = set().union(*(w for w in held if w))
                get = self._pieces(words).__getitem__
                out += [None if w is None else b"".join(map(get, w)) for w in held]
                held, n = [], 0
        return out


def encode_pieces(docs: DataFrame, text: str, out: str, vocab: Vocabulary) -> DataFrame:
    """``docs`` with the piece ids of each whole text in column ``out`` (array of int).

    Every text can be encoded: a character without a piece becomes its UTF-8
    bytes' pieces, so decoding gives the text back exactly. An empty text has
    no ids, a null text null. All columns are kept; nothing is shuffled.
    """
    at = docs.columns.index(text)
    shared = docs.sparkSession.sparkContext.broadcast(vocab)
    schema = docs.select("*", F.lit(None).cast("array<int>").alias(out)).schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value)
        for batch in batches:
            for part, texts in slices(batch, at):
                ids = _lists(encoder.encode(texts))
                yield pa.RecordBatch.from_arrays([*part.columns, ids], names=[*batch.schema.names, out])

    return docs.mapInArrow(run, schema)


def _lists(ids: list[bytes | None]) -> pa.Array:
    offsets = np.cumsum([0] + [len(x or b"") // 4 for x in ids])
    values = pa.array(np.frombuffer(b"".join(x for x in ids if x), np.int32))
    null = np.append([x is None for x in ids], False)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32(), mask=null.astype(bool)), values)


def decode(ids: np.ndarray, pieces: list[bytes]) -> bytes:
    """The UTF-8 text of piece ids: markers become spaces, but for the one before the text."""
    return b"".join(map(pieces.__getitem__, ids.tolist())).removeprefix(b" ")


def decode_pieces(df: DataFrame, ids: str, out: str, vocab: Vocabulary) -> DataFrame:
    """``df`` with the text of the ids in column ``out``: markers become spaces, but for the one before the text.

    Byte pieces join into characters; bytes that make none become U+FFFD, which
    encoding never gives. Control pieces have no text. Null ids give null.
    """
    at = df.columns.index(ids)
    shared = df.sparkSession.sparkContext.broadcast(vocab.pieces)
    schema = df.select("*", F.lit(None).cast("string").alias(out)).schema

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = shared.value
        for batch in batches:
            texts = [
                decode(row.values.to_numpy(), pieces).decode("utf-8", "replace") if row.is_valid else None
                for row in batch.column(at)
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*batch.schema.names, out])

    return df.mapInArrow(run, schema)


def encoded_documents(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """``doc_id, n_pieces, n_bytes, ids, round_trip`` of every document.

    ``n_bytes`` counts byte pieces; ``round_trip`` says that decoding the ids
    gave the text back, which is tried for every text in the pass that encodes it. Null texts have null ids, no pieces and a round trip;
    repeated rows each get a row, other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Vocabulary.load(model))
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = shared.value
        encoder = Encoder(vocab)
        in_bytes = np.zeros(len(vocab.pieces), bool)
        in_bytes[vocab.byte_ids] = True
        for batch in batches:
            for part, texts in slices(batch, 1):
                encoded = encoder.encode(texts)
                ids = [np.frombuffer(x or b"", np.int32) for x in encoded]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([len(i) for i in ids], pa.int64()),
                        pa.array([int(in_bytes[i].sum()) for i in ids], pa.int64()),
                        _lists(encoded),
                        pa.array([t is None or decode(i, vocab.pieces) == t for i, t in zip(ids, texts)], pa.bool_()),
                    ],
                    names=["doc_id", "n_pieces", "n_bytes", "ids", "round_trip"],
                )

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {id_type}, n_pieces bigint, n_bytes bigint, ids array<int>, round_trip boolean"
    )


def op4_pieces(spark, sf_dir: str) -> DataFrame:
    """All documents in pieces, decoded back."""
    return encoded_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op4_pieces": op4_pieces}
ORACLES: dict[str, str] = {}
