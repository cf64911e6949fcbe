"""Format-preserving masks: a keyed Feistel network over the digits and letters of a value.

Digits stay digits, capital letters capital and small letters small, and all other
characters stay as they are, so the result has the length and the form of the value. Within a
form the mask is a bijection, and the key takes it back.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Rounds of the network; an even number, so that both halves end where they began.
ROUNDS = 10
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_DIGITS = "0123456789"
_KEPT = "[0-9A-Za-z]"
#: Characters that one digest shifts, by eight hex digits each.
_BLOCK = 8


def _shift(char: str, by: str, sign: str) -> str:
    def within(first: str, radix: int) -> str:
        return f"chr(CAST({ord(first)} + pmod(ascii({char}) - {ord(first)} {sign} {by}, {radix}) AS INT))"

    return f"CASE WHEN {char} <= '9' THEN {within('0', 10)} WHEN {char} <= 'Z' THEN {within('A', 26)} ELSE {within('a', 26)} END"


def preserve_sql(text: str, key: str, restore: bool = False) -> str:
    """The mask of a text expression, or with ``restore`` the text that has this mask, as SQL text.

    The characters to mask are dealt into two halves by turns. In each round a half is shifted, character by
    character, by a keyed SHA-256 of the other half, of the round and of the value's form, and the
    halves change places; going back subtracts in the opposite order. ``key`` goes in front twice, as in the ``hash``
    strategy. A value with one character to mask is only shifted by its form, so it is no better
    protected than its form lets it be; few characters can be tried one by one by whoever has the key's results.
    NULL stays NULL.
    """
    layout = f"translate({text}, '{_DIGITS}{_UPPER}{_UPPER.lower()}', '{'n' * 10}{'X' * 26}{'x' * 26}')"
    kept = f"regexp_extract_all({text}, '{_KEPT}', 0)"
    start = (
        f"named_struct('a', filter({kept}, (c, i) -> i % 2 = 0), 'b', filter({kept}, (c, i) -> i % 2 = 1), "
        f"'l', {layout}, 'k', {key}, 'p', split({text}, '{_KEPT}', -1))"
    )
    moved, other, sign, rounds = ("s.a", "s.b", "+", f"0, {ROUNDS - 1}") if not restore else ("s.b", "s.a", "-", f"{ROUNDS - 1}, 0, -1")
    message = f"concat_ws('|', CAST(r AS STRING), CAST(d AS STRING), s.l, array_join({other}, ''))"
    digests = (
        f"transform(sequence(0, CAST(greatest(size({moved}) - 1, 0) DIV {_BLOCK} AS INT)), "
        f"d -> sha2(concat(s.k, sha2(concat(s.k, {message}), 256)), 256))"
    )
    by = f"CAST(conv(substring(h[CAST(i DIV {_BLOCK} AS INT)], CAST(i % {_BLOCK} AS INT) * 8 + 1, 8), 16, 10) AS BIGINT)"
    shifted = f"transform(array({digests}), h -> transform({moved}, (c, i) -> {_shift('c', by, sign)}))[0]"
    halves = f"'a', s.b, 'b', {shifted}" if not restore else f"'a', {shifted}, 'b', s.a"
    step = f"named_struct({halves}, 'l', s.l, 'k', s.k, 'p', s.p)"
    chars = (
        "transform(sequence(0, size(s.a) + size(s.b) - 1), "
        "i -> CASE WHEN i % 2 = 0 THEN s.a[CAST(i DIV 2 AS INT)] ELSE s.b[CAST(i DIV 2 AS INT)] END)"
    )
    finish = f"array_join(zip_with(s.p, {chars}, (x, y) -> concat(x, coalesce(y, ''))), '')"
    network = f"aggregate(sequence({rounds}), {start}, (s, r) -> {step}, s -> {finish})"
    return f"CASE WHEN {text} RLIKE '{_KEPT}' THEN {network} ELSE {text} END"


def restore_expr(masked: str, key: str) -> Column:
    """The text whose mask is in a column, for who has the key; ``key`` is an SQL expression."""
    return F.expr(preserve_sql(masked, key, restore=True))
