"""Ordering the touches of each customer: numbers, next channel, sequence text.

Ordinary customers take one hash exchange and one window. Customers too heavy
for one task (see ``operators.skew``) take a second way that never gathers
their history in one task:

1. equal touches (same time, channel, type) are counted map-side into runs;
2. runs are numbered inside (customer, minute), which time resolution bounds;
3. minutes are numbered inside the customer, one row per minute;
4. minute offsets plus local numbers give the exact global number, and runs are
   unfolded again in pieces spread over the cluster.

Both ways give the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaarlake.fixed_values import UNKNOWN
from bazaarlake.operators.skew import ROWS_PER_TASK, heavy_keys, split_by_weight

_ORDER = ("touchpoint_time", "touchpoint_channel", "event_type")
_OUTPUT = (
    "customer_id", "touchpoint_time", "touchpoint_channel", "event_type",
    "touchpoint_number", "next_touchpoint_channel", "total_touchpoints",
)
_PIECE = 1_000_000  # most copies of one run unfolded by one task


def touches(events: DataFrame) -> DataFrame:
    """Events of known customers, unnamed channel and type as ``unknown``."""
    return events.filter(F.col("customer_id").isNotNull()).select(
        "customer_id",
        F.col("event_timestamp").alias("touchpoint_time"),
        F.coalesce("source", F.lit(UNKNOWN)).alias("touchpoint_channel"),
        F.coalesce("event_type", F.lit(UNKNOWN)).alias("event_type"),
    )


def _runs(rows: DataFrame) -> DataFrame:
    minute = F.date_trunc("minute", "touchpoint_time").alias("minute")
    return rows.groupBy("customer_id", minute, *_ORDER).agg(F.count(F.lit(1)).alias("copies"))


def number_in_one_window(rows: DataFrame) -> DataFrame:
    """Number, next channel and total over one exchange and one sort."""
    mine = Window.partitionBy("customer_id")
    ordered = mine.orderBy(*_ORDER)
    return rows.select(
        "customer_id", *_ORDER,
        F.row_number().over(ordered).cast("long").alias("touchpoint_number"),
        F.lead("touchpoint_channel").over(ordered).alias("next_touchpoint_channel"),
        F.count(F.lit(1)).over(mine).alias("total_touchpoints"),
    ).select(*_OUTPUT)


def _sum_before(value: str, window: Window) -> Column:
    before = window.rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(value).over(before), F.lit(0))


def number_by_minute(rows: DataFrame) -> DataFrame:
    """The same numbering for histories of any length."""
    runs = _runs(rows)
    in_minute = Window.partitionBy("customer_id", "minute").orderBy(*_ORDER)
    local = runs.select(
        "*",
        _sum_before("copies", in_minute).alias("run_start"),
        F.lead("touchpoint_channel").over(in_minute).alias("next_in_minute"),
    )
    in_history = Window.partitionBy("customer_id").orderBy("minute")
    minutes = runs.groupBy("customer_id", "minute").agg(
        F.sum("copies").alias("copies"),
        F.min(F.struct(*_ORDER)).getField("touchpoint_channel").alias("first_channel"),
    )
    offsets = minutes.select(
        "customer_id", "minute",
        _sum_before("copies", in_history).alias("minute_start"),
        F.lead("first_channel").over(in_history).alias("next_minute_channel"),
        F.sum("copies").over(Window.partitionBy("customer_id")).alias("total_touchpoints"),
    )
    same_minute = (F.col("l.customer_id") == F.col("o.customer_id")) & F.col(
        "l.minute").eqNullSafe(F.col("o.minute"))
    placed = local.alias("l").join(offsets.alias("o"), same_minute).select(
        "l.customer_id", *_ORDER, "l.copies", "o.total_touchpoints",
        (F.col("minute_start") + F.col("run_start")).alias("before"),
        F.coalesce("next_in_minute", "next_minute_channel").alias("after_run"),
    )
    last_piece = F.greatest(F.col("copies") - 1, F.lit(0))
    pieces = placed.withColumn(
        "piece", F.explode(F.sequence(F.lit(0).cast("long"), last_piece, F.lit(_PIECE)))
    ).repartition("customer_id", "before", "piece")
    copy_end = F.least(F.col("piece") + _PIECE, F.col("copies")) - 1
    unfolded = pieces.withColumn("copy", F.explode(F.sequence("piece", copy_end)))
    is_last_copy = F.col("copy") == F.col("copies") - 1
    return unfolded.select(
        "customer_id", *_ORDER,
        (F.col("before") + F.col("copy") + 1).alias("touchpoint_number"),
        F.when(is_last_copy, F.col("after_run")).otherwise(F.col("touchpoint_channel"))
        .alias("next_touchpoint_channel"),
        "total_touchpoints",
    ).select(*_OUTPUT)


def split_ordered(
    events: DataFrame, rows_per_task: int = ROWS_PER_TASK
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(numbered touches of ordinary customers, of heavy customers, heavy ids)."""
    rows = touches(events)
    heavy = heavy_keys(rows, "customer_id", rows_per_task)
    ordinary, bulky = split_by_weight(rows, heavy, "customer_id")
    return number_in_one_window(ordinary), number_by_minute(bulky), heavy


def ordered_touchpoints(events: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    ordinary, bulky, _ = split_ordered(events, rows_per_task)
    return ordinary.unionByName(bulky)


def sequence_chunks(
    events: DataFrame, touches_per_chunk: int = 10_000, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """``touchpoint_sequence`` in pieces: (customer_id, chunk, touches, text, first and last time).

    Touches are numbered in the order of the sequence, and each chunk (from 0) joins so many
    of them, so no buffer grows with a customer's history. ``join_chunks`` gives the whole
    text back on demand.
    """
    tokens = touches(events).select(
        "customer_id", "touchpoint_time", F.concat("touchpoint_channel", F.lit(":"),
                                                   "event_type").alias("touchpoint_channel"),
        F.lit("").alias("event_type"))
    heavy = heavy_keys(tokens, "customer_id", rows_per_task)
    ordinary, bulky = split_by_weight(tokens, heavy, "customer_id")
    numbered = number_in_one_window(ordinary).unionByName(number_by_minute(bulky))
    chunk = F.floor((F.col("touchpoint_number") - 1) / touches_per_chunk)
    return numbered.groupBy("customer_id", chunk.alias("chunk")).agg(
        F.count(F.lit(1)).alias("touches"),
        _sequence("touchpoint_channel", "touchpoint_number").alias("text"),
        F.min("touchpoint_time").alias("first_touch_time"),
        F.max("touchpoint_time").alias("last_touch_time"))


def join_chunks(chunks: DataFrame) -> DataFrame:
    """One row per customer from its chunks; the columns of ``touchpoint_sequence``."""
    return chunks.groupBy("customer_id").agg(
        _sequence("text", "chunk").alias("touchpoint_sequence"),
        F.min("first_touch_time").alias("first_touch_time"),
        F.max("last_touch_time").alias("last_touch_time"))


def _sequence(text: str, *order: str) -> Column:
    keys = ", ".join(order)
    return F.expr(f"listagg({text}, ' > ') within group (order by {keys})")


def touchpoint_sequence(events: DataFrame, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Per customer: ``source:type`` texts in time order, first and last touch.

    The text of one customer is one value, so it must end in one row; for heavy
    customers it is joined from minute texts, which keeps every buffer small
    until that last step.
    """
    rows = touches(events).select(
        "customer_id", "touchpoint_time",
        F.concat("touchpoint_channel", F.lit(":"), "event_type").alias("token"),
    )
    heavy = heavy_keys(rows, "customer_id", rows_per_task)
    ordinary, bulky = split_by_weight(rows, heavy, "customer_id")
    bounds = (
        F.min("touchpoint_time").alias("first_touch_time"),
        F.max("touchpoint_time").alias("last_touch_time"),
    )
    short = ordinary.groupBy("customer_id").agg(
        _sequence("token", "touchpoint_time", "token").alias("touchpoint_sequence"), *bounds
    )
    minute = F.date_trunc("minute", "touchpoint_time").alias("minute")
    runs = bulky.groupBy("customer_id", minute, "touchpoint_time", "token").agg(
        F.count(F.lit(1)).cast("int").alias("copies")
    )
    text = "concat(token, repeat(concat(' > ', token), copies - 1))"
    minutes = runs.groupBy("customer_id", "minute").agg(
        _sequence(text, "touchpoint_time", "token").alias("part"), *bounds
    )
    long = minutes.groupBy("customer_id").agg(
        _sequence("part", "minute").alias("touchpoint_sequence"),
        F.min("first_touch_time").alias("first_touch_time"),
        F.max("last_touch_time").alias("last_touch_time"),
    )
    return short.unionByName(long)
