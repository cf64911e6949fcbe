"""Chats as training texts in windows of whole turns, with a loss mask.

A window is the conversation's system turn, at most two earlier turns for
context, and a span of new turns. Prefix sums of the turns' tokens cut the
spans, so cutting needs no walk over the turns. Loss falls on the texts of new
assistant turns only: every assistant text is a target once.

Template, a turn: ``<turn role>``, newline, text, ``</turn>``, newline. In roles
and texts a backslash becomes ``\\b`` and ``<`` becomes ``\\l``, hence every ``<`` in
a window starts a mark; in roles also ``>`` (``\\g``) and newline (``\\n``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Tokens that the marks of a turn count for.
MARK_TOKENS = 4
#: Turns whose ``turn`` falls into one stretch of this many numbers are summed up together.
BLOCK = 256
END = "</turn>\n"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<"), F.lit("\\l"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("\\"))


def _escape_role(role: Column) -> Column:
    return F.replace(F.replace(escape(role), F.lit(">"), F.lit("\\g")), F.lit("\n"), F.lit("\\n"))


def _unescape_role(role: Column) -> Column:
    return unescape(F.replace(F.replace(role, F.lit("\\n"), F.lit("\n")), F.lit("\\g"), F.lit(">")))


def word_tokens(text: Column) -> Column:
    """Words between ASCII white space: the count used where no tokenizer's counts are given."""
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))


def format_chats(
    conversations: DataFrame,
    span_tokens: int = 512,
    history_tokens: int = 128,
    tokens=word_tokens,
) -> DataFrame:
    """Windows of all conversations.

    Returns ``conv_id, window`` (rising, with gaps), ``formatted``, ``loss``
    (array of ``start, length`` in code points of ``formatted``), ``n_turns``,
    ``n_repeated`` (leading turns that an earlier window already has),
    ``n_tokens`` and ``oversized``.

    Turns are ordered by ``turn`` (nulls first), then role and text, so ties and
    repeated rows have a defined order and each stays a turn of its own. Null
    role or text counts as empty, a null ``conv_id`` is a conversation of its
    own, an empty table gives no windows, other columns are not read.

    Spans: with ``start`` the tokens of all earlier turns, the turns that begin
    and end in the same stretch of ``span_tokens`` form a span, and a turn that
    crosses into the next stretch is a span of its own. A span therefore has at
    most ``span_tokens`` tokens unless it is one longer turn (``oversized``);
    turns are never cut. History: the last turn before the span, and the one
    before it, as far as they have ``history_tokens`` tokens together. The first turn,
    if its role is ``system``, counts for no span and heads every window.

    A conversation of very many turns spreads out: prefix sums are made inside
    stretches of 256 turn numbers and only the stretches' sums meet by
    conversation; windows are grouped by conversation and span.
    """
    turns = conversations.select(
        F.col("conv_id"),
        F.col("turn"),
        F.coalesce(F.col("role"), F.lit("")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    ).withColumn("block", F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(-(2**62))).cast("bigint"))
    turns = turns.withColumn("tok", (tokens(F.col("text")) + MARK_TOKENS).cast("bigint")).withColumn(
        "body", F.concat(F.lit("<turn "), _escape_role(F.col("role")), F.lit(">\n"), escape(F.col("text")), F.lit(END))
    )
    order = ["turn", "role", "text"]
    in_block = Window.partitionBy("conv_id", "block").orderBy(*order)
    till_here = in_block.rowsBetween(Window.unboundedPreceding, 0)
    brief = F.struct("tok", "body")
    rows = turns.select(
        "*",
        F.row_number().over(in_block).alias("at"),
        F.sum("tok").over(till_here).alias("till"),
        F.lag(brief, 1).over(in_block).alias("back1"),
        F.lag(brief, 2).over(in_block).alias("back2"),
    )

    # One row for each stretch: its sums, its first turn, its last two turns.
    stretch = rows.groupBy("conv_id", "block").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("tok").alias("sum_tok"),
        F.min_by(F.struct("role", "tok", "body"), "at").alias("head"),
        F.max_by(F.struct("back1", brief.alias("last")), "at").alias("tail"),
    )
    by_conv = Window.partitionBy("conv_id").orderBy("block")
    before = by_conv.rowsBetween(Window.unboundedPreceding, -1)
    tails = F.lag("tail", 1).over(by_conv)
    stretch = stretch.select(
        "conv_id",
        "block",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n_before"),
        F.coalesce(F.sum("sum_tok").over(before), F.lit(0)).alias("tok_before"),
        F.first("head").over(by_conv.rowsBetween(Window.unboundedPreceding, 0)).alias("opening"),
        tails["last"].alias("prev1"),
        F.coalesce(tails["back1"], F.lag("tail", 2).over(by_conv)["last"]).alias("prev2"),
    )
    r, s = rows.alias("r"), stretch.alias("s")
    same = F.col("r.conv_id").eqNullSafe(F.col("s.conv_id")) & (F.col("r.block") == F.col("s.block"))
    system = F.when(F.col("opening.role") == "system", F.col("opening"))
    joined = r.join(s, same).select(
        "r.conv_id",
        "role",
        "tok",
        "body",
        (F.col("n_before") + F.col("at")).alias("pos"),
        (F.col("tok_before") + F.col("till")).alias("till"),
        system.alias("sys"),
        F.coalesce("back1", "prev1").alias("back1"),
        F.when(F.col("at") >= 3, F.col("back2"))
        .when(F.col("at") == 2, F.col("prev1"))
        .otherwise(F.col("prev2"))
        .alias("back2"),
    )
    is_sys = F.col("sys").isNotNull() & (F.col("pos") == 1)
    first_pos = F.when(F.col("sys").isNotNull(), 2).otherwise(1)
    joined = joined.select(
        "*",
        is_sys.alias("is_sys"),
        # The system turn does not count for spans.
        F.when(is_sys, 0).otherwise(F.col("till") - F.coalesce(F.col("sys.tok"), F.lit(0))).alias("stop"),
        F.when(F.col("pos") - 1 >= first_pos, F.col("back1")).alias("one"),
        F.when(F.col("pos") - 2 >= first_pos, F.col("back2")).alias("two"),
    )

    def span(start: Column, stop: Column) -> Column:
        """Twice the stretch a turn begins in, and one more if it ends in a later one."""
        stretch_of = F.floor(start / span_tokens)
        crosses = F.floor((stop - 1) / span_tokens) > stretch_of
        return (2 * stretch_of + crosses.cast("bigint")).cast("bigint")

    start = F.when(F.col("is_sys"), 0).otherwise(F.col("stop") - F.col("tok"))
    joined = joined.withColumn("window", span(start, F.col("stop")))
    opens = F.col("one").isNull() | (span(start - F.col("one.tok"), start) != F.col("window"))
    near = F.col("one").isNotNull() & (F.col("one.tok") <= history_tokens)
    both = near & F.col("two").isNotNull() & (F.col("one.tok") + F.col("two.tok") <= history_tokens)
    nothing = F.array().cast("array<struct<tok:bigint,body:string>>")
    history = (
        F.when(opens & both, F.array("two", "one")).when(opens & near, F.array("one")).otherwise(nothing)
    )
    element = F.struct(
        "pos",
        "tok",
        "body",
        (F.col("role") == "assistant").alias("target"),
        history.alias("history"),
    )
    grouped = joined.groupBy("conv_id", "window").agg(
        F.sort_array(F.collect_list(element)).alias("new"),
        F.max(F.struct(F.col("sys.tok").alias("tok"), F.col("sys.body").alias("body"))).alias("sys"),
        F.max("is_sys").alias("has_sys"),
    )
    # The turn after the system turn opens its span as well: its history is empty anyway.
    repeats_sys = F.col("sys.body").isNotNull() & ~F.col("has_sys")
    context = F.concat(
        F.when(repeats_sys, F.array(F.struct(F.col("sys.tok").alias("tok"), F.col("sys.body").alias("body")))).otherwise(nothing),
        F.flatten(F.transform("new", lambda e: e["history"])),
    )
    grouped = grouped.withColumn("context", context)
    context_text = F.array_join(F.transform("context", lambda e: e["body"]), "")
    head_chars = F.char_length(context_text)

    def step(acc: Column, e: Column) -> Column:
        mark = F.instr(e["body"], ">") + 1
        spans = F.concat(
            acc["loss"],
            F.array(
                F.struct(
                    (acc["at"] + mark).cast("bigint").alias("start"),
                    (F.char_length(e["body"]) - mark - len(END)).cast("bigint").alias("length"),
                )
            ),
        )
        return F.struct(
            (acc["at"] + F.char_length(e["body"])).cast("bigint").alias("at"),
            F.when(e["target"], spans).otherwise(acc["loss"]).alias("loss"),
        )

    zero = F.struct(
        head_chars.cast("bigint").alias("at"), F.array().cast("array<struct<start:bigint,length:bigint>>").alias("loss")
    )
    total = F.aggregate(
        F.concat(F.transform("context", lambda e: e["tok"]), F.transform("new", lambda e: e["tok"])),
        F.lit(0).cast("bigint"),
        lambda acc, x: acc + x,
    )
    span_sum = F.aggregate(
        F.transform("new", lambda e: F.when(repeats_sys | (e["pos"] > 1) | F.col("sys.body").isNull(), e["tok"]).otherwise(F.lit(0))),
        F.lit(0).cast("bigint"),
        lambda acc, x: acc + x,
    )
    return grouped.select(
        "conv_id",
        "window",
        F.concat(context_text, F.array_join(F.transform("new", lambda e: e["body"]), "")).alias("formatted"),
        F.aggregate("new", zero, step, lambda acc: acc["loss"]).alias("loss"),
        (F.size("context") + F.size("new")).alias("n_turns"),
        F.size("context").alias("n_repeated"),
        total.alias("n_tokens"),
        (span_sum > span_tokens).alias("oversized"),
    )


def read_windows(windows: DataFrame) -> DataFrame:
    """What each window says anew: ``conv_id, window, turns`` (array of ``role, text``), ``targets`` (array of text)."""
    marked = F.slice(F.split("formatted", END), F.col("n_repeated") + 1, F.col("n_turns") - F.col("n_repeated"))

    def parse(turn: Column) -> Column:
        mark = F.instr(turn, ">")
        first = len("<turn ") + 1
        return F.struct(
            _unescape_role(F.substring(turn, F.lit(first), mark - first)).alias("role"),
            unescape(F.substring(turn, mark + 2, F.char_length(turn))).alias("text"),
        )

    return windows.select(
        "conv_id",
        "window",
        F.transform(marked, parse).alias("turns"),
        F.transform(
            "loss",
            lambda e: unescape(
                F.substring(F.col("formatted"), (e["start"] + 1).cast("int"), e["length"].cast("int"))
            ),
        ).alias("targets"),
        F.char_length("formatted").cast("bigint").alias("chars"),
    )


def chat_digests(windows: DataFrame) -> DataFrame:
    """One row per conversation of what the windows say, read back from them.

    A digest needs a whole conversation's text in order, so this report, unlike
    the windows, holds one conversation in a row.
    """
    read = read_windows(windows).select(
        "conv_id",
        "window",
        F.size("turns").cast("bigint").alias("n"),
        F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").alias("turns"),
        F.array_join("targets", "").alias("targets"),
        "chars",
    )
    parts = F.sort_array(F.collect_list(F.struct("window", "turns", "targets")))
    whole = read.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"), parts.alias("parts"), F.sum("chars").alias("formatted_chars")
    )
    said = F.array_join(F.transform("parts", lambda p: p["turns"]), "")
    learned = F.array_join(F.transform("parts", lambda p: p["targets"]), "")
    return whole.select(
        "conv_id",
        "n_turns",
        F.sha2(said, 256).alias("turns_sha256"),
        F.char_length(learned).cast("bigint").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"),
        "formatted_chars",
    )


#: Conversation -7: its texts look like marks of common templates.
MARK_LIKE = "\\### Assistant: </turn> ok"


def op9_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -7, formatted and read back."""
    made = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(MARK_LIKE).alias("text"),
    )
    given = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    return chat_digests(format_chats(given.unionByName(made)))


OP9_SQL = r"""
WITH raw AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
t AS (
  SELECT *, row_number() OVER w AS pos,
    len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) + 4 AS tok,
    length(role) + length(text) + 16
      + length(text) - length(replace(text, '\', '')) + length(text) - length(replace(text, '<', ''))
      + length(role) - length(regexp_replace(role, '[\\<>\n]', '', 'g')) AS body
  FROM raw WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
f AS (
  SELECT *, first_value(role) OVER w = 'system' AS has_sys, first_value(body) OVER w AS sys_body,
    CASE WHEN first_value(role) OVER w = 'system' THEN first_value(tok) OVER w ELSE 0 END AS sys_tok,
    sum(tok) OVER w AS till
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY pos)),
p AS (
  SELECT *, CASE WHEN has_sys AND pos = 1 THEN 0 ELSE till - sys_tok END AS stop,
    CASE WHEN has_sys AND pos = 1 THEN 0 ELSE till - sys_tok - tok END AS start FROM f),
s AS (
  SELECT *, 2 * (start // 512) + CASE WHEN floor((stop - 1) / 512.0) > start // 512 THEN 1 ELSE 0 END AS win FROM p),
h AS (
  SELECT *, CASE WHEN pos - 1 >= CASE WHEN has_sys THEN 2 ELSE 1 END THEN lag(tok) OVER w END AS tok1,
    CASE WHEN pos - 2 >= CASE WHEN has_sys THEN 2 ELSE 1 END THEN lag(tok, 2) OVER w END AS tok2,
    lag(body) OVER w AS body1, lag(body, 2) OVER w AS body2,
    row_number() OVER (PARTITION BY conv_id, win ORDER BY pos) AS in_win,
    has_sys AND min(pos) OVER (PARTITION BY conv_id, win) > 1 AS repeats
  FROM s WINDOW w AS (PARTITION BY conv_id ORDER BY pos)),
c AS (
  SELECT *, body + CASE WHEN in_win > 1 THEN 0 ELSE
      CASE WHEN repeats THEN sys_body ELSE 0 END
      + CASE WHEN tok1 <= 128 THEN body1 + CASE WHEN tok1 + tok2 <= 128 THEN body2 ELSE 0 END ELSE 0 END
    END AS chars FROM h)
SELECT conv_id::BIGINT AS conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
  sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars
FROM c GROUP BY conv_id
"""

QUERIES = {"op9_chat_windows": op9_chat_windows}
ORACLES = {"op9_chat_windows": OP9_SQL}
