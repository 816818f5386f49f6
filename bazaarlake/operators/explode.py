"""Nested lists to rows."""

from __future__ import annotations

import logging
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from bazaarlake.functions.names import FEED_POSITION, quoted
from bazaarlake.operators.dedupe import with_position

log = logging.getLogger(__name__)


def _flat(value: str, dtype: T.StructType, path: str = "") -> Iterator[tuple[str, str]]:
    """Leaf fields of a struct; a field ``y`` inside ``x`` is named ``x_y``."""
    for field in dtype:
        name, inner = path + field.name, f"{value}.{quoted(field.name)}"
        if isinstance(field.dataType, T.StructType):
            yield from _flat(inner, field.dataType, name + "_")
        else:
            yield name, inner


def explode_items(
    df: DataFrame, list_column: str, keep: Sequence[str], prefix: str = "parent_"
) -> DataFrame:
    """One row per list element, parents kept as ``parent_*``.

    An empty or null list gives no row. The place in the list extends the feed
    position, so later "first row wins" rules stay deterministic.
    """
    parents = [f"{quoted(c)} as {quoted(prefix + c)}" for c in keep]
    if list_column not in df.columns:
        log.warning("list column %r not found", list_column)
        return df.selectExpr(*parents).limit(0)
    placed = with_position(df)
    item_type = df.schema[list_column].dataType.elementType
    # A bare column would get a filter on its size, which works the list out once more.
    rows = placed.selectExpr(
        *[quoted(c) for c in keep], FEED_POSITION,
        f"posexplode(coalesce({quoted(list_column)}, array())) as (_at, _item)")
    found: dict[str, list[str]] = {}
    if isinstance(item_type, T.StructType):
        for name, value in _flat("_item", item_type):
            found.setdefault(name, []).append(value)
    else:
        found[list_column] = ["_item"]
    items = []
    for name, values in found.items():
        texts = ", ".join(f"cast({v} as string)" for v in values)
        value = values[0] if len(values) == 1 else f"coalesce({texts})"
        items.append(f"{value} as {quoted(name)}")
    position = f"named_struct('row', {FEED_POSITION}, 'item', _at) as {FEED_POSITION}"
    return rows.selectExpr(*parents, *items, position)
