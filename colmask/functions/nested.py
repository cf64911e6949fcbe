"""Fields inside structs, arrays and maps: their paths, and masks that reach them.

A path is the names from the column to the field, joined by dots: ``person.home.zip``. What an array holds is
``element``, what a map holds ``key`` and ``value``, as in ``phones.element.number``. A name that has a dot or a
backtick itself stands in backticks.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass

from pyspark.sql.types import ArrayType, DataType, MapType, StructType

from colmask.functions.names import quote_ident, quote_text

#: Strategy of a field that a copy leaves out.
OMIT = "omit"
#: Strategies that keep different keys of a map different.
KEY_STRATEGIES = ("hash", "preserve", OMIT)


@dataclass(frozen=True)
class Leaf:
    """A field that holds no other fields.

    ``names`` are the names on its path from its own outward, without
    ``element``, ``key`` and ``value``. ``values`` is the SQL of an array of what one row holds there.
    """

    path: str
    dtype: str
    names: tuple[str, ...]
    values: str


def path_part(name: str) -> str:
    return quote_ident(name) if re.search("[.`]", name) else name


def _parts(dtype: DataType) -> list[tuple[str, DataType, str]]:
    """What an array or map holds: the part's name, its type, and a template of the array with it."""
    if isinstance(dtype, ArrayType):
        return [("element", dtype.elementType, "{}")]
    return [("key", dtype.keyType, "map_keys({})"), ("value", dtype.valueType, "map_values({})")]


def _walk(value: str, dtype: DataType, path: str, names: tuple[str, ...], depth: int) -> Iterator[Leaf]:
    if isinstance(dtype, StructType):
        for field in dtype.fields:
            inner = f"{value}.{quote_ident(field.name)}"
            yield from _walk(inner, field.dataType, f"{path}.{path_part(field.name)}", (field.name, *names), depth)
    elif isinstance(dtype, ArrayType | MapType):
        for part, held, template in _parts(dtype):
            items, item = template.format(value), f"_x{depth}"
            for leaf in _walk(item, held, f"{path}.{part}", names, depth + 1):
                lists = f"filter(transform({items}, {item} -> {leaf.values}), {item} -> {item} IS NOT NULL)"
                values = items if leaf.values == f"array({item})" else f"flatten({lists})"
                yield Leaf(leaf.path, leaf.dtype, leaf.names, values)
    else:
        yield Leaf(path, dtype.simpleString(), names, f"array({value})")


def leaves(schema: StructType) -> Iterator[Leaf]:
    """Every field of a table that holds no other fields, in order; a plain column is one."""
    for field in schema.fields:
        yield from _walk(quote_ident(field.name), field.dataType, path_part(field.name), (field.name,), 0)


def is_nested(dtype: DataType) -> bool:
    return isinstance(dtype, StructType | ArrayType | MapType)


def _below(path: str, wanted: Mapping[str, str]) -> bool:
    return any(p.startswith(f"{path.lower()}.") for p in wanted)


def masked_sql(
    value: str,
    dtype: DataType,
    path: str,
    wanted: Mapping[str, str],
    shown: Callable[[str, str, str], str],
    strategy: str | None = None,
    in_key: bool = False,
    depth: int = 0,
) -> str | None:
    """SQL of a value in which the fields at the ``wanted`` paths are masked; None if nothing of it is left.

    ``wanted`` has a strategy by lowercase path. The path of a struct, array or map with ``.*`` behind it stands for all
    fields in it that have no strategy of their own. ``shown`` makes the SQL of one field from its value, type and
    strategy. A NULL struct, array or map stays NULL (what becomes of a field's NULL is up to its mask), and arrays and maps keep their size. A map's keys take only
    strategies that keep them apart; an omitted key or value omits the map.
    """
    strategy = wanted.get(path.lower(), wanted.get(f"{path.lower()}.*", strategy))
    if strategy is None and not _below(path, wanted):
        return value
    if strategy == OMIT:
        return None

    def inside(inner: str, held: DataType, part: str, key: bool = in_key) -> str | None:
        return masked_sql(inner, held, f"{path}.{part}", wanted, shown, strategy, key, depth + 1)

    if isinstance(dtype, StructType):
        made = [
            (field.name, inside(f"{value}.{quote_ident(field.name)}", field.dataType, path_part(field.name)))
            for field in dtype.fields
        ]
        kept = ", ".join(f"{quote_text(name)}, {sql}" for name, sql in made if sql is not None)
        if not kept:
            return None if made else value
        return f"CASE WHEN {value} IS NOT NULL THEN named_struct({kept}) END"
    if isinstance(dtype, ArrayType):
        item = f"_x{depth}"
        element = inside(item, dtype.elementType, "element")
        return None if element is None else f"transform({value}, {item} -> {element})"
    if isinstance(dtype, MapType):
        key, item = f"_k{depth}", f"_x{depth}"
        keys = inside(key, dtype.keyType, "key", True)
        values = inside(item, dtype.valueType, "value")
        if keys is None or values is None:
            return None
        if keys != key:
            value = f"transform_keys({value}, ({key}, {item}) -> {keys})"
        return value if values == item else f"transform_values({value}, ({key}, {item}) -> {values})"
    if in_key and strategy not in KEY_STRATEGIES:
        raise ValueError(f"keys of a map need a strategy that keeps them apart ({', '.join(KEY_STRATEGIES)}): {path}")
    return shown(value, dtype.simpleString(), strategy)


def paths(schema: StructType) -> Iterator[tuple[str, DataType]]:
    """Path and type of every column and of every field inside one, in order; a container comes before what is in it."""

    def visit(dtype: DataType, path: str) -> Iterator[tuple[str, DataType]]:
        yield path, dtype
        if isinstance(dtype, StructType):
            for field in dtype.fields:
                yield from visit(field.dataType, f"{path}.{path_part(field.name)}")
        elif isinstance(dtype, ArrayType | MapType):
            for part, held, _ in _parts(dtype):
                yield from visit(held, f"{path}.{part}")

    for field in schema.fields:
        yield from visit(field.dataType, path_part(field.name))
