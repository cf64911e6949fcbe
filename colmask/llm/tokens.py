"""Token counts of sections: whole texts are encoded once and their tokens attributed.

Counting the tokens of cut-out sections would miss tokens that reach across a
cut, and add others. Here a text's tokens keep their character spans, the spans
are joined with the sections by position, and a rule says which section gets a
token that lies in more than one.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from colmask.llm.batches import slices

RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Pretokenizer of the vocabulary in ``RANKS``; fixed value, published with it.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: White space of the pattern's ``\\s``; fixed value.
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Longer stretches of white space are cut out beforehand: the pattern tries every end of a stretch, which takes its matcher's stack.
LONG_SPACE = 1000
RULES = ("first", "last", "largest")
#: Section number of tokens that lie in no section.
OUTSIDE = -1


_LONG_SPACE = re.compile(f"[{SPACE}]{{{LONG_SPACE},}}")


class Tokenizer:
    """Byte-level BPE from a file of ranks; ``spans`` gives the tokens' places."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN):
        self.encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.whole = tiktoken.Encoding("whole", pat_str=r"(?s).+", mergeable_ranks=ranks, special_tokens={})
        self.width = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self.width[rank] = len(token)

    def byte_stops(self, text: str) -> np.ndarray:
        """Where each token of the whole text ends, in bytes.

        In the pattern a stretch of white space is one piece, but for its last character where a word
        follows; a long one is given to the merges as that piece, and what is before and
        after it is encoded apart, with the same tokens.
        """
        ids: list[int] = []
        at = 0
        for stretch in _LONG_SPACE.finditer(text):
            ids += self.encoding.encode_ordinary(text[at : stretch.start()])
            at = stretch.end() - (stretch.end() < len(text))
            ids += self.whole.encode_ordinary(text[stretch.start() : at])
        ids += self.encoding.encode_ordinary(text[at:])
        return np.cumsum(self.width[np.array(ids, np.int64)])


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def line_sections(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Byte spans of the lines, line ends included; an empty text has none."""
    if not text:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    breaks = np.flatnonzero(np.frombuffer(text, np.uint8) == 10) + 1
    stops = breaks if len(breaks) and breaks[-1] == len(text) else np.append(breaks, len(text))
    return np.append(0, stops[:-1]), stops


def attribute(
    starts: np.ndarray, stops: np.ndarray, begins: np.ndarray, ends: np.ndarray, rule: str
) -> tuple[np.ndarray, np.ndarray]:
    """Section of each token (``OUTSIDE`` for none), and whether the token reaches over a section's edge.

    Tokens ``[starts, stops)`` and sections ``[begins, ends)`` are in order and
    without overlap. ``first``: the section of the token's first character;
    ``last``: of its last; ``largest``: the section with most of its characters, the
    earlier of equals. Under each rule a token goes to one section or outside; a
    token whose deciding character is outside goes outside, under ``largest``
    only if it touches no section at all.
    """
    if not len(begins):
        return np.full(len(starts), OUTSIDE), np.zeros(len(starts), bool)

    def holder(place: np.ndarray) -> np.ndarray:
        at = np.searchsorted(begins, place, "right") - 1
        inside = (at >= 0) & (place < ends[np.maximum(at, 0)])
        return np.where(inside, at, OUTSIDE)

    first, last = holder(starts), holder(stops - 1)
    crossing = (first != last) | ((first != OUTSIDE) & (stops > ends[np.maximum(first, 0)]))
    if rule == "first":
        return first, crossing
    if rule == "last":
        return last, crossing
    out = first.copy()
    # Tokens that touch several sections, or sections between characters outside, are few.
    low, high = np.searchsorted(ends, starts, "right"), np.searchsorted(begins, stops, "left")
    crossing |= (first == OUTSIDE) & (high > low)
    for i in np.flatnonzero(crossing):
        s = np.arange(low[i], high[i])
        shared = np.minimum(stops[i], ends[s]) - np.maximum(starts[i], begins[s])
        out[i] = s[np.argmax(shared)] if len(s) else OUTSIDE
    return out, crossing


def _chars(text: bytes) -> np.ndarray:
    """For each byte (and the end) the number of characters that begin before it."""
    begins = (np.frombuffer(text, np.uint8) & 0xC0) != 0x80
    return np.concatenate([[0], np.cumsum(begins)])


def token_counts(
    docs: DataFrame, sections: str | None = None, rule: str = "first", ranks: str = RANKS, pattern: str = PATTERN
) -> DataFrame:
    """Tokens of each section of each document.

    ``sections`` names a column of ``array<struct<start, stop>>`` in code points
    (fields of a joined text, parts, ...), in order and without overlap; spans past
    the end are cut there, null and empty spans have no tokens. Without it the lines are
    the sections, line ends included. Returns ``doc_id, section, start, stop,
    n_tokens, n_crossing``: a row per section, also for those without tokens, and
    a row ``section = -1`` (null start and stop) for the tokens outside all sections if there
    are any. ``n_crossing`` counts those of ``n_tokens`` that reach over an edge. The
    counts of a document add up to the tokens of its whole text.

    A token that holds part of a character only counts as lying at that character. Null and
    empty texts have no lines, hence no rows, and only empty sections. Repeated
    rows each get their rows, an empty table gives an empty result; other columns
    are not read. Nothing is shuffled.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    given = F.col(sections).cast("array<struct<start:bigint,stop:bigint>>") if sections else None
    columns = [F.col("doc_id"), F.col("text")] + ([given.alias("sections")] if sections else [])
    table = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks))
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def of(tokenizer: Tokenizer, text: bytes, parts) -> tuple[list[np.ndarray], int, int]:
        chars = _chars(text)
        stops = tokenizer.byte_stops(text.decode()) if text else np.zeros(0, np.int64)
        starts = np.append(0, stops[:-1]) if len(stops) else stops
        # The character a token begins in, and the one after the last it has a byte of.
        first = chars[starts + 1] - 1 if len(stops) else stops
        after = chars[stops]
        if parts is None:
            begins, ends = line_sections(text)
            begins, ends = chars[begins], chars[ends]
        else:
            spans = np.array([((p or {}).get("start") or 0, (p or {}).get("stop") or 0) for p in parts], np.int64)
            begins, ends = np.clip(spans.reshape(-1, 2), 0, chars[-1]).T
            ends = np.maximum(begins, ends)
        held, crossing = attribute(first, after, begins, ends, rule)
        counts = np.bincount(held + 1, minlength=len(begins) + 1)
        crossed = np.bincount(held[crossing] + 1, minlength=len(begins) + 1)
        return [begins, ends, counts[1:], crossed[1:]], int(counts[0]), int(crossed[0])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = Tokenizer(table.value, pattern)
        for part, texts in (p for batch in batches for p in slices(batch, 1)):
            rows, numbers, parts, outside = [], [], [[], [], [], []], []
            for i, text in enumerate(texts):
                spans = None if not sections else part.column(2)[i].as_py() or []
                found, n, crossed = of(tokenizer, text or b"", spans)
                rows.append(np.full(len(found[0]), i))
                numbers.append(np.arange(len(found[0])))
                for held, values in zip(parts, found):
                    held.append(values)
                if n:
                    outside.append((i, n, crossed))
            extra = np.array(outside, np.int64).reshape(-1, 3)
            at = np.concatenate([*rows, extra[:, 0]]).astype(np.int64)
            begins, ends, counts, crossings = (np.concatenate(p).astype(np.int64) for p in parts)
            null = np.concatenate([np.zeros(len(begins), bool), np.ones(len(extra), bool)])
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0).take(pa.array(at)),
                    pa.array(np.concatenate([*numbers, np.full(len(extra), OUTSIDE)]).astype(np.int32)),
                    pa.array(np.concatenate([begins, extra[:, 0]]), mask=null),
                    pa.array(np.concatenate([ends, extra[:, 0]]), mask=null),
                    pa.array(np.concatenate([counts, extra[:, 1]])),
                    pa.array(np.concatenate([crossings, extra[:, 2]])),
                ],
                names=["doc_id", "section", "start", "stop", "n_tokens", "n_crossing"],
            )

    schema = f"doc_id {id_type}, section int, start bigint, stop bigint, n_tokens bigint, n_crossing bigint"
    return docs.select(*columns).mapInArrow(run, schema)


def op3_token_counts(spark, sf_dir: str) -> DataFrame:
    """Tokens of every line of every document."""
    return token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES = {"op3_token_counts": op3_token_counts}
ORACLES: dict[str, str] = {}
