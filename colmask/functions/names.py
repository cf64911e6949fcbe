"""Identifiers and type names."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quote_ident(name: str) -> str:
    """``name`` in backticks, inner backticks doubled."""
    return "`" + name.replace("`", "``") + "`"


_PART = re.compile(r"`((?:[^`]|``)*)`|([^.]+)")


def quote_table(name: str) -> str:
    """A stored table name with every part in backticks.

    Parts are separated by dots; a part that has a dot or a backtick itself is
    stored in backticks, see ``qualified_name``.
    """
    parts = [
        quoted.replace("``", "`") if quoted or not plain else plain for quoted, plain in _PART.findall(name)
    ]
    return ".".join(quote_ident(part) for part in parts)


def qualified_name(catalog: Column, schema: Column, table: Column) -> Column:
    """The stored name of a table: its parts joined by dots, in backticks where a part needs them."""

    def part(name: Column) -> Column:
        quoted = F.concat(F.lit("`"), F.replace(name, F.lit("`"), F.lit("``")), F.lit("`"))
        return F.when(name.rlike("[.`]"), quoted).otherwise(name)

    return F.concat_ws(".", part(catalog), part(schema), part(table))


def quote_text(text: str) -> str:
    """An SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def free_name(taken: Iterable[str], name: str) -> str:
    """``name``, lengthened until no column has it in any case."""
    used = {t.lower() for t in taken}
    while name.lower() in used:
        name += "_"
    return name


def find_column(df: DataFrame, name: str) -> str:
    """The column of ``df`` with that name in any case; an error if there is none, or more than one."""
    found = [c for c in df.columns if c.lower() == name.lower()]
    if len(found) != 1:
        raise ValueError(f"{'no such' if not found else 'ambiguous'} column: {name}")
    return found[0]


def base_type(dtype: str) -> str:
    """Type name that masks are looked up by: lowercase, decimals without precision."""
    dtype = dtype.lower()
    return "decimal" if dtype.startswith("decimal") else dtype


def base_type_column(dtype: Column) -> Column:
    """``base_type`` as a column expression."""
    dtype = F.lower(dtype)
    return F.when(dtype.startswith("decimal"), F.lit("decimal")).otherwise(dtype)
