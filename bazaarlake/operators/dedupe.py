"""Duplicates: keep the first row of a key, flag the later ones, or count them."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaarlake.functions.columns import conform
from bazaarlake.functions.names import FEED_COPIES, FEED_POSITION

log = logging.getLogger(__name__)


def with_position(df: DataFrame) -> DataFrame:
    """Make sure rows carry their place in the feed.

    Readers set it from file and place in file. Frames built by hand get Spark's
    row id, which follows the order of the rows as long as nothing was shuffled.
    """
    if FEED_POSITION in df.columns:
        return df
    return df.withColumn(FEED_POSITION, F.monotonically_increasing_id())


def _payload(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c != FEED_POSITION]


def keep_first(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """First row per key by feed position; null keys form one group.

    ``row_number() = 1`` plans to a WindowGroupLimit on both sides of the
    exchange: each map task sends one row per key, so a key with a third of all
    rows costs one row per map task in the shuffle.
    """
    placed = with_position(df)
    first = Window.partitionBy(*(keys or _payload(placed))).orderBy(FEED_POSITION)
    return (
        placed.withColumn("_nth", F.row_number().over(first))
        .filter(F.col("_nth") == 1)
        .drop("_nth")
    )


def keep_first_counted(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keep_first`` with ``FEED_COPIES``, the number of rows that the key had.

    The first row and the count are one aggregate, merged map-side, so removal and count
    take one exchange, and a hot key sends one row per map task. Keys and position are sent
    once, not in the row again; a caller that drops the position has it in the order alone.
    """
    placed = with_position(df)
    rest = [c for c in placed.columns if c not in (*keys, FEED_POSITION)]
    row = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(rest)])
    first = [F.min_by(row, FEED_POSITION).alias("_row")] if rest else []
    found = placed.groupBy(*[F.col(f"`{k}`").alias(f"_key_{i}") for i, k in enumerate(keys)]).agg(
        *first, F.min(FEED_POSITION).alias("_at"), F.count(F.lit(1)).alias(FEED_COPIES))
    places = {**{c: f"_row.c{i}" for i, c in enumerate(rest)}, FEED_POSITION: "_at",
              **{k: f"_key_{i}" for i, k in enumerate(keys)}}
    return found.select(*[F.col(places[c]).alias(c) for c in placed.columns], FEED_COPIES)


def _same(left: str, right: str, keys: Sequence[str]) -> Column:
    pairs = [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys]
    return reduce(lambda a, b: a & b, pairs)


def flag_duplicates(
    df: DataFrame, keys: Sequence[str] | None = None, flag: str = "is_duplicate"
) -> DataFrame:
    """Mark every row of a key but the first.

    With a feed position, the first positions are aggregated map-side and joined back,
    so the rows of a hot key stay spread (AQE splits the probe side). Without one the
    rows have no order that two evaluations would agree on, so a window over a single
    evaluation numbers them: exactly one row of each key stays unmarked.
    """
    keys = list(keys or _payload(df))
    if FEED_POSITION not in df.columns:
        order = Window.partitionBy(*keys).orderBy(FEED_POSITION)
        return with_position(df).withColumn(flag, F.row_number().over(order) > 1).drop(
            FEED_POSITION)
    placed = df
    firsts = placed.groupBy(*keys).agg(F.min(FEED_POSITION).alias("_first"))
    joined = placed.alias("r").join(firsts.alias("f"), _same("r", "f", keys), "inner")
    return joined.select(
        *[F.col(f"r.{c}") for c in placed.columns],
        (F.col(f"r.{FEED_POSITION}") != F.col("f._first")).alias(flag),
    )


def duplicate_count(df: DataFrame, keys: Sequence[str] | None = None) -> DataFrame:
    """One row: how many rows are second or later of their key."""
    return (
        df.groupBy(*(keys or _payload(df)))
        .agg(F.count(F.lit(1)).alias("rows"))
        .agg(F.coalesce(F.sum(F.col("rows") - 1), F.lit(0)).alias("duplicate_count"))
    )


def check_duplicates(
    df: DataFrame,
    subset: Sequence[str] | None = None,
    remove_duplicates: bool = False,
    flag_column: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(rows, one-row count). Flag and removal are both optional; all lazy."""
    counted = duplicate_count(df, subset)
    if remove_duplicates:
        rows = keep_first(df, subset)
        # Rows that survive are firsts.
        return (rows.withColumn(flag_column, F.lit(False)) if flag_column else rows), counted
    return (flag_duplicates(df, subset, flag_column) if flag_column else df), counted


def combine_frames(
    frames: Sequence[DataFrame],
    schema: T.StructType | None = None,
    dedupe_on: Sequence[str] | None = None,
    counted: bool = False,
) -> DataFrame:
    """UNION ALL BY NAME; on a shared key the earlier frame wins.

    The rank of the frame leads the feed position, so the outcome does not
    depend on how the union is partitioned. Without ``schema`` all columns stay.
    ``counted`` adds ``FEED_COPIES`` where duplicates leave.
    """
    placed = [with_position(frame) for frame in frames]
    types = [frame.schema[FEED_POSITION].dataType.simpleString() for frame in placed]
    ranked = []
    for rank, frame in enumerate(placed):
        # Feeds may count positions in different types: each type has a field of its own.
        places = ", ".join(
            f"'at_{n}', " + (FEED_POSITION if t == types[rank] else f"cast(null as {t})")
            for n, t in enumerate(dict.fromkeys(types)))
        position = F.expr(f"named_struct('rank', {rank}, {places})")
        ranked.append(frame.withColumn(FEED_POSITION, position))
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), ranked)
    if dedupe_on:
        missing = [c for c in dedupe_on if c not in rows.columns]
        if missing:
            log.warning("columns %s not found; no duplicates removed", missing)
        else:
            rows = keep_first_counted(rows, dedupe_on) if counted else keep_first(rows, dedupe_on)
    kept = [c for c in (FEED_POSITION, FEED_COPIES) if c in rows.columns]
    return rows if schema is None else conform(rows, schema, keep=kept)
