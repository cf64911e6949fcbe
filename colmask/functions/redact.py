"""Masks as native expressions.

Every mask returns STRING, for authorised readers too, so the schema of a
masked column does not depend on who reads it. Masks are built as SQL text:
tables have thousands of columns, and one text costs the driver far less than
a tree of column objects.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from colmask.functions.names import base_type
from colmask.functions.preserve import preserve_sql

# Mask function by data type, and the constant redaction.
MASK_FUNCTIONS = {
    "int": "tc_int_mask",
    "bigint": "tc_bigint_mask",
    "decimal": "tc_decimal_type_mask",
    "double": "tc_double_mask",
    "float": "tc_float_mask",
    "date": "tc_date_mask",
    "timestamp": "tc_timestamp_mask",
    "string": "tc_string_mask",
    "boolean": "tc_boolean_mask",
}
FULL_MASK = "****"

# Optional extra row for tables that store local timestamps.
LOCAL_TIMESTAMP = {"timestamp_ntz": "tc_timestamp_mask"}


class UnsupportedTypeError(ValueError):
    """A column was to be masked whose type has no mask function."""


def text_sql(value: str) -> str:
    return f"CAST({value} AS STRING)"


def keep_first_sql(value: str) -> str:
    """First character, then one ``*`` per remaining character; NULL stays NULL."""
    text = text_sql(value)
    return f"left({text}, 1) || repeat('*', char_length({text}) - 1)"


def _redact_time_sql(value: str, dtype: str) -> str:
    """``keep_first_sql`` that formats only unusual values.

    A date in a year of four digits has ten characters, and a timestamp
    without a fraction has nineteen.
    """
    usual, stars = f"year({value}) BETWEEN 1000 AND 9999", "*" * 9
    if dtype != "date":
        usual += f" AND unix_micros(CAST({value} AS TIMESTAMP)) % 1000000 = 0"
        stars = "*" * 18
    return (
        f"CASE WHEN {usual} THEN CAST(year({value}) DIV 1000 AS STRING) || '{stars}' "
        f"ELSE {keep_first_sql(value)} END"
    )


def redact_sql(value: str, dtype: str) -> str:
    """First character kept, or the constant for booleans."""
    kind = base_type(dtype)
    if kind == "boolean":
        return f"'{FULL_MASK}'"
    if kind in ("date", "timestamp", "timestamp_ntz"):
        return _redact_time_sql(value, kind)
    return keep_first_sql(value)


def survives_redaction_sql(value: str, dtype: str) -> str:
    """Whether the redacted text is the stored text; cheap, as most values are not."""
    kind = base_type(dtype)
    if kind in ("int", "bigint"):
        return f"{value} BETWEEN 0 AND 9"
    if kind in ("boolean", "date", "double", "float", "timestamp", "timestamp_ntz"):
        return "false"
    text = text_sql(value)
    return (
        f"(left({text}, 1) = {text} "
        f"OR substring({text}, 2, 1) = '*' AND {keep_first_sql(value)} = {text})"
    )


def mask_sql(value: str, dtype: str, strategy: str = "redact", key: str | None = None) -> str:
    """The mask of an SQL expression as SQL text.

    ``redact`` keeps the first character, ``full`` nothing, ``shape`` turns
    letters into ``X``/``x`` and digits into ``n``, and ``hash`` is SHA-256 keyed
    by ``key``, an SQL expression too: the key goes in front of the value, and
    again in front of the hash of both, so nothing can be appended to a value. ``preserve``
    encrypts digits and letters in their places, see ``preserve_sql``; it needs a key as well.
    """
    if strategy == "redact":
        return redact_sql(value, dtype)
    if strategy == "full":
        return f"'{FULL_MASK}'"
    if strategy == "shape":
        return f"mask({text_sql(value)})"
    if strategy == "hash":
        if key is None:
            raise ValueError("the hash strategy needs a key")
        return f"sha2(concat({key}, sha2(concat({key}, {text_sql(value)}), 256)), 256)"
    if strategy == "preserve":
        if key is None:
            raise ValueError("the preserve strategy needs a key")
        return preserve_sql(text_sql(value), key)
    raise ValueError(f"unknown strategy: {strategy}")


def shown_sql(
    value: str,
    dtype: str,
    authorized: bool | str = False,
    strategy: str = "redact",
    key: str | None = None,
    functions: Mapping[str, str] = MASK_FUNCTIONS,
) -> str:
    """What a reader sees of an SQL expression: its text if authorised, else its mask.

    ``authorized`` may be an SQL condition.
    """
    if base_type(dtype) not in functions:
        raise UnsupportedTypeError(f"Unsupported data type: {dtype.lower()}")
    if authorized is True:
        return text_sql(value)
    masked = mask_sql(value, dtype, strategy, key)
    if authorized is False:
        return masked
    return f"CASE WHEN {authorized} THEN {text_sql(value)} ELSE {masked} END"


def mask_expr(value: str, dtype: str, authorized: bool | str = False, **options) -> Column:
    """``shown_sql`` as a column."""
    return F.expr(shown_sql(value, dtype, authorized, **options))
