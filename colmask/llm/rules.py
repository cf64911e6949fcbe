"""Quality rules learned as an ordered list of threshold conjunctions.

Sequential covering: a rule grows by the threshold test with the largest
information gain until it covers no good text, is cut back on rows it was not
grown from, and then leaves the rows it covers to the next rule. The finished
list is one Spark CASE expression. Everything here is DataFrame operations; the
driver only sees counts by feature and bin.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from colmask.functions.names import free_name
from colmask.session import stored

WORD_GAP = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
REPEAT_WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

#: What the tests of a rule may look at.
FEATURES = (
    "n_words", "mean_word_chars", "symbol_share", "upper_share", "digit_share", "bang_share",
    "dup_line_share", "repeat_share", "distinct_share", "words_per_line",
)
#: Quantiles of bad and of good rows that become cut points, together with both ends and the points halfway between.
BINS = 16
#: A rule has at most this many tests; a tighter test of the same feature and direction replaces the wider one.
MAX_TESTS = 4
#: A rule is kept if, on rows it was not grown from, this share of what it covers is bad.
MIN_PRECISION = 0.98
#: ... and it covers at least this many bad rows there.
MIN_COVERED = 3
#: ... and, from the fifth rule weighed on, the chance that one of those tried covers such rows by luck is at most this.
MAX_LUCK = 0.05


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _repeated_words(windows: Column) -> Column:
    """Words inside windows that occur twice or more, from the windows' hashes in text order."""

    def covered(starts: Column) -> Column:
        new = F.transform(
            starts,
            lambda p, i: F.when(i == 0, F.lit(REPEAT_WINDOW)).otherwise(
                F.least(F.lit(REPEAT_WINDOW), p - F.get(starts, i - 1))
            ),
        )
        return F.aggregate(new, F.lit(0).cast("bigint"), lambda acc, x: acc + x)

    def twins(by_hash: Column) -> Column:
        def has_twin(x: Column, i: Column) -> Column:
            same = F.get(by_hash, i - 1)["h"].eqNullSafe(x["h"]) | F.get(by_hash, i + 1)["h"].eqNullSafe(x["h"])
            return same

        starts = F.transform(F.filter(by_hash, has_twin), lambda x: x["i"])
        return _let(F.sort_array(starts), covered)

    by_hash = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    # Most texts repeat no window, which a hash set shows without sorting.
    return F.when(F.size(F.array_distinct(windows)) < F.size(windows), _let(by_hash, twins)).otherwise(
        F.lit(0).cast("bigint")
    )


def with_stats(df: DataFrame, text: str, out: str) -> DataFrame:
    """Add the struct column ``out`` of the base counts and the features of each whole text.

    Base counts: ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words``
    (long). Features are shares or means derived from counts; a share of nothing
    is 0. A null text counts as empty. Texts of any length are taken whole;
    windows are compared by a 64-bit hash of their words' hashes.
    """
    words, hashes, windows, counts = (free_name(df.columns, n) for n in ("_words", "_hashes", "_windows", "_counts"))
    whole = F.coalesce(F.col(text), F.lit(""))
    df = df.withColumn(words, F.array_remove(F.split(whole, WORD_GAP), ""))
    df = df.withColumn(hashes, F.transform(F.col(words), lambda w: F.xxhash64(w)))
    last = F.size(hashes) - REPEAT_WINDOW
    hashed = F.col(hashes)
    window = F.when(
        last >= 0,
        F.transform(
            F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
            lambda i: F.xxhash64(*[F.get(hashed, i + k) for k in range(REPEAT_WINDOW)]),
        ),
    ).otherwise(F.array().cast("array<bigint>"))
    df = df.withColumn(windows, window)
    lines = F.filter(F.split(whole, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    df = df.withColumn(
        counts,
        F.struct(
            F.size(words).cast("bigint").alias("n_words"),
            F.char_length(F.array_join(F.col(words), "")).cast("bigint").alias("word_chars"),
            F.regexp_count(whole, F.lit(SYMBOLS)).cast("bigint").alias("n_symbols"),
            _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
            _repeated_words(F.col(windows)).alias("n_repeat_words"),
            F.size(F.array_distinct(words)).alias("n_distinct"),
            _let(lines, lambda x: F.size(x)).alias("n_lines"),
            F.regexp_count(whole, F.lit("[A-Z]")).alias("n_upper"),
            F.regexp_count(whole, F.lit("[0-9]")).alias("n_digits"),
            F.regexp_count(whole, F.lit("[!?]")).alias("n_bangs"),
        ),
    )

    def share(part: str, of: str) -> Column:
        whole_count = F.col(f"{counts}.{of}")
        return F.when(whole_count > 0, F.col(f"{counts}.{part}") / whole_count).otherwise(F.lit(0.0))

    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    features = {
        "mean_word_chars": share("word_chars", "n_words"),
        "symbol_share": share("n_symbols", "word_chars"),
        "upper_share": share("n_upper", "word_chars"),
        "digit_share": share("n_digits", "word_chars"),
        "bang_share": share("n_bangs", "word_chars"),
        "dup_line_share": share("n_dup_lines", "n_lines"),
        "repeat_share": share("n_repeat_words", "n_words"),
        "distinct_share": share("n_distinct", "n_words"),
        "words_per_line": share("n_words", "n_lines"),
    }
    made = [F.col(f"{counts}.{n}").alias(n) for n in base] + [c.alias(n) for n, c in features.items()]
    # The generator keeps the optimizer from moving filters on the counts below them, where
    # every mention of a count would be a count of its own.
    return df.withColumn(out, F.explode(F.array(F.struct(*made)))).drop(words, hashes, windows, counts)


def base_failed(stats: str) -> Column:
    """The fixed rule: fewer than 20 words, or over 30 % of the words in repeated windows."""
    n_words, repeated = F.col(f"{stats}.n_words"), F.col(f"{stats}.n_repeat_words")
    return (n_words < MIN_WORDS) | (100 * repeated > MAX_REPEAT_PERCENT * n_words)


@dataclass(frozen=True)
class Cut:
    """``feature <= threshold`` (``below``) or ``feature > threshold``."""

    feature: str
    below: bool
    threshold: float

    def column(self, stats: str) -> Column:
        value = F.col(f"{stats}.{self.feature}")
        return value <= self.threshold if self.below else value > self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'<=' if self.below else '>'} {self.threshold:.6g}"


@dataclass(frozen=True)
class DecisionList:
    """Ordered rules; the first whose tests all hold rejects a text, and texts no rule covers are kept."""

    rules: tuple[tuple[Cut, ...], ...]

    def rejected_by(self, stats: str) -> Column:
        """Number of the first rule that holds, from 1 on, or 0."""
        out = F.lit(0)
        for number, rule in reversed(list(enumerate(self.rules, 1))):
            out = F.when(_all(rule, stats), F.lit(number)).otherwise(out)
        return out

    def kept(self, stats: str) -> Column:
        return ~base_failed(stats) & (self.rejected_by(stats) == 0)

    def __str__(self) -> str:
        return "\n".join(f"{i}. reject if {' and '.join(map(str, r))}" for i, r in enumerate(self.rules, 1)) or "keep"


def _all(tests: Sequence[Cut], stats: str) -> Column:
    out = F.lit(True)
    for test in tests:
        out = out & test.column(stats)
    return out


def _any(rules: Sequence[Sequence[Cut]], stats: str) -> Column:
    out = F.lit(False)
    for rule in rules:
        out = out | _all(rule, stats)
    return out


def _thresholds(rows: DataFrame, stats: str) -> tuple[dict[str, list[float]], int, int]:
    """Cut points of each feature, and the numbers of bad and of good rows.

    Cut points are quantiles and both ends of the bad and of the good rows, so that
    rare bad rows get cuts too, and the points halfway between.
    """
    at = F.array(*[F.lit((i + 0.5) / (BINS // 2)) for i in range(BINS // 2)])
    found = rows.groupBy("bad").agg(
        F.count(F.lit(1)).alias("n"),
        *[
            F.concat(
                F.percentile_approx(F.col(f"{stats}.{f}").cast("double"), at, 1000),
                F.array(F.min(f"{stats}.{f}"), F.max(f"{stats}.{f}")).cast("array<double>"),
            ).alias(f)
            for f in FEATURES
        ],
    ).collect()  # two rows
    cuts = {}
    for feature in FEATURES:
        values = sorted({v for row in found for v in row[feature] or [] if v is not None})
        cuts[feature] = sorted({*values, *((a + b) / 2 for a, b in zip(values, values[1:]))})
    sizes = {row["bad"]: row["n"] for row in found}
    return cuts, sizes.get(True, 0), sizes.get(False, 0)


def _gain(p: int, n: int, p0: int, n0: int) -> float:
    """Information gained on the bad rows when a rule goes from covering (p0, n0) to covering (p, n)."""
    if not p:
        return 0.0
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0)))


def _luck(p: int, n: int, share: float) -> float:
    """A bound of the chance that so many of p + n rows are bad if each is with probability ``share``."""
    said = p / (p + n)
    if said <= share:
        return 1.0
    other = (1 - said) * math.log((1 - said) / (1 - share)) if n else 0.0
    return math.exp(-(p + n) * (said * math.log(said / share) + other))


def _tightened(tests: tuple[Cut, ...], test: Cut) -> tuple[Cut, ...]:
    """``tests`` and ``test``, which takes the place of a wider test of its feature and direction."""
    wider = [t for t in tests if (t.feature, t.below) == (test.feature, test.below)]
    return tuple(test if t in wider else t for t in tests) if wider else (*tests, test)


def learn_rules(labelled: DataFrame, stats: str) -> DecisionList:
    """A decision list from rows ``(doc_id, quality, <stats>)``; 0 is bad, anything else but null is good.

    All labelled rows are counted: each step is two aggregations, one for the cut
    points of the rows a rule still covers and one by feature and bin, so the driver sees at most
    features x bins counts whatever the number of rows, and a kind of bad text that is
    rare among all rows gets cuts of its own. A third of the rows, by a hash of their id and counts, is left out of
    growing and used to prune. Where a rule fails there, the next best feature or direction starts another;
    the list ends when none passes. No labels, or none of one kind, give an empty
    list (everything is kept). Ties go to the feature named first, then the test
    ``<=``; of cuts that cover the same rows the middle one is taken.
    """
    rows = labelled.filter(F.col("quality").isNotNull()).select(
        stats,
        (F.col("quality") == 0).alias("bad"),
        (F.pmod(F.xxhash64("doc_id", f"{stats}.n_words", f"{stats}.word_chars"), F.lit(3)) == 0).alias("held"),
    ).filter(~base_failed(stats))
    rows = stored(rows, "rules")

    def best_tests(df: DataFrame) -> list[tuple[float, Cut, int, int]]:
        """The best test of each feature and direction with a gain on ``df``, best first, with what it covers."""
        cuts, p0, n0 = _thresholds(df, stats)
        if not p0 or not n0:
            return []

        def bin_of(feature: str) -> Column:
            """How many cuts lie below the value: ``value <= cuts[i]`` is the same as ``bin <= i``."""
            value = F.col(f"{stats}.{feature}").cast("double")
            points = F.array(*[F.lit(c) for c in cuts[feature]])
            return F.array_position(F.sort_array(F.concat(points, F.array(value))), value) - 1

        counts = (
            df.select("bad", F.posexplode(F.array(*[bin_of(f) for f in FEATURES])).alias("f", "bin"))
            .groupBy("f", "bin")
            .agg(F.count_if("bad").alias("p"), F.count_if(~F.col("bad")).alias("n"))
            .collect()  # at most features x (bins + 1) rows
        )
        table = {(r["f"], r["bin"]): (r["p"], r["n"]) for r in counts}
        out = []
        for f, feature in enumerate(FEATURES):
            for below in (True, False):
                best, ties = None, []
                p = n = 0
                for i, cut in enumerate(cuts[feature]):
                    more = table.get((f, i), (0, 0))
                    p, n = p + more[0], n + more[1]
                    covered = (p, n) if below else (p0 - p, n0 - n)
                    gain = _gain(*covered, p0, n0)
                    if gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                        best, ties = (gain, *covered), []
                    if best and best[1:] == covered:
                        ties.append(cut)
                if best:
                    out.append((best[0], Cut(feature, below, ties[len(ties) // 2]), *best[1:]))
        return sorted(out, key=lambda found: -round(found[0], 9))

    def grown(df: DataFrame, found: tuple[float, Cut, int, int]) -> list[tuple[Cut, ...]]:
        """The rules on the way from the test found first to one that covers no good row."""
        steps: list[tuple[Cut, ...]] = []
        while found:
            _, test, p, n = found
            steps.append(_tightened(steps[-1], test) if steps else (test,))
            df = df.filter(test.column(stats))
            more = best_tests(df) if p and n else []
            found = next((x for x in more if len(_tightened(steps[-1], x[1])) <= MAX_TESTS), None)
        return steps

    def next_rule(left: DataFrame) -> tuple[Cut, ...] | None:
        grow, held = left.filter(~F.col("held")), left.filter("held")
        all_held = held.agg(F.count_if("bad").alias("p"), F.count(F.lit(1)).alias("all")).first()
        if all_held["p"] < MIN_COVERED:
            return None
        tried = 0
        for start in best_tests(grow):
            steps = grown(grow, start)
            tried += len(steps)
            # Cut the last tests off as long as the held rows are told apart no worse without them.
            seen = held.agg(
                *[
                    F.count_if(_all(step, stats) & (F.col("bad") == bad)).alias(f"{'p' if bad else 'n'}{k}")
                    for k, step in enumerate(steps)
                    for bad in (True, False)
                ]
            ).first()
            worth = []
            for k in range(len(steps)):
                p, n = seen[f"p{k}"], seen[f"n{k}"]
                good = p >= MIN_PRECISION * (p + n) and p >= MIN_COVERED
                # Of many rules weighed on the same rows, some look good by luck.
                if good and (tried <= MAX_TESTS or tried * _luck(p, n, all_held["p"] / all_held["all"]) <= MAX_LUCK):
                    worth.append(((p - n) / (p + n), p, -k))
            if worth:
                return steps[-max(worth)[2]]
        return None

    rules: list[tuple[Cut, ...]] = []
    while rule := next_rule(rows.filter(~_any(rules, stats))):
        rules.append(rule)
    return DecisionList(tuple(rules))


def quality_labels(labels: DataFrame) -> DataFrame:
    """One ``quality`` per id: 0 if any label of the id says so; labels without id or quality are left out."""
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
    return known.groupBy("doc_id").agg(F.min("quality").alias("quality"))


def quality_verdicts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id``, base counts, ``base_failed`` and ``kept`` of every document, by rules learned from ``labels``.

    The counts are made once and written to the shared work folder; learning and
    the verdict read them there. Repeated rows each get a row, ids may be null
    (such rows learn nothing but are judged), an empty table gives an empty
    result, and columns other than id and text are not read.
    """
    rows = stored(with_stats(docs.select("doc_id", "text"), "text", "stats").drop("text"), "stats")
    learned = learn_rules(rows.join(quality_labels(labels), "doc_id"), "stats")
    return rows.select(
        "doc_id",
        *[F.col(f"stats.{n}") for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
        base_failed("stats").alias("base_failed"),
        learned.kept("stats").alias("kept"),
    )


def keep_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the learned rules keep, with the columns of ``docs``.

    The rows are written once with their counts. Learning reads the counts
    alone, so no text is shuffled, and the verdict follows from the counts that are there. Nulls, repeated rows and empty tables as
    in ``quality_verdicts``; helper columns take names that ``docs`` does not use.
    """
    out = free_name(docs.columns, "_stats")
    rows = stored(with_stats(docs, "text", out), "stats")
    known = rows.select("doc_id", F.col(out).alias("stats")).join(quality_labels(labels), "doc_id")
    return rows.filter(learn_rules(known, "stats").kept(out)).drop(out)


def op8_quality_rules(spark, sf_dir: str) -> DataFrame:
    """Counts and verdicts of all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return quality_verdicts(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


QUERIES = {"op8_quality_rules": op8_quality_rules}
ORACLES: dict[str, str] = {}
