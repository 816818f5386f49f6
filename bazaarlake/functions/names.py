"""Column naming: every raw spelling becomes snake_case, nested fields too."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Where a row stood in its feed. Orders duplicates; never part of an output table.
FEED_POSITION = "feed_position"
# How many rows of a key a builder merged into one.
FEED_COPIES = "feed_copies"

_SEPARATORS = re.compile("[^0-9A-Za-z]+")
_HUMP = re.compile("(?<=[0-9a-z])(?=[A-Z])")


def snake(name: object) -> str:
    """``orderId`` -> ``order_id``, ``Total-VND`` -> ``total_vnd``."""
    words = [w for part in _SEPARATORS.split(str(name)) for w in _HUMP.split(part) if w]
    return "_".join(words).lower()


def quoted(name: str) -> str:
    """A column name as SQL text."""
    return "`" + name.replace("`", "``") + "`"


def _by_snake_name(names: list[str]) -> dict[str, list[str]]:
    groups: dict[str, list[str]] = {}
    for name in names:
        key = name if name == FEED_POSITION else snake(name)
        groups.setdefault(key, []).append(name)
    return groups


def _has_foreign_name(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.ArrayType):
        return _has_foreign_name(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return any(snake(f.name) != f.name or _has_foreign_name(f.dataType) for f in dtype)
    return False


def _first_value(values: list[str], types: list[T.DataType]) -> str:
    if len(values) == 1:
        return values[0]
    if any(t != types[0] for t in types):
        values = [f"cast({v} as string)" for v in values]
    return f"coalesce({', '.join(values)})"


def _snake_value(value: str, dtype: T.DataType, depth: int = 0) -> str:
    """SQL that renames the fields inside a nested value; scalars pass through untouched."""
    if not _has_foreign_name(dtype):
        return value
    if isinstance(dtype, T.ArrayType):
        item = f"item{depth}"
        return f"transform({value}, {item} -> {_snake_value(item, dtype.elementType, depth + 1)})"
    fields = []
    for name, spellings in _by_snake_name(dtype.names).items():
        types = [dtype[s].dataType for s in spellings]
        found = [_snake_value(f"{value}.{quoted(s)}", t, depth)
                 for s, t in zip(spellings, types)]
        fields.append(f"'{name}', {_first_value(found, types)}")
    return f"if({value} is null, null, named_struct({', '.join(fields)}))"


def standardize_names(df: DataFrame) -> DataFrame:
    """Snake-case all column and nested field names.

    Two spellings of one name (``orderId`` and ``order_id``) are coalesced.
    """
    columns = []
    for name, spellings in _by_snake_name(df.columns).items():
        types = [df.schema[s].dataType for s in spellings]
        values = [_snake_value(quoted(s), t) for s, t in zip(spellings, types)]
        columns.append(f"{_first_value(values, types)} as {quoted(name)}")
    return df.selectExpr(*columns)


def rename_columns(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)
