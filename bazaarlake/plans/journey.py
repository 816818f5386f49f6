"""Customer journey and journey edges (Sankey)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bazaarlake.operators.skew import ROWS_PER_TASK
from bazaarlake.operators.touchpoints import (
    sequence_chunks,
    split_ordered,
    touchpoint_sequence,
    touches,
)


def purchase_summary(orders: DataFrame) -> DataFrame:
    """Per known customer: first and last order, number of orders, revenue.

    The distinct count plans to (customer, order) first, so a customer with a
    third of all orders is spread over the cluster before the final merge.
    """
    value = F.coalesce("total_vnd", F.lit(0).cast("decimal(18,2)"))
    return orders.filter(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(
        F.min("order_date").alias("first_purchase_time"),
        F.max("order_date").alias("last_purchase_time"),
        F.count_distinct("order_key").alias("total_orders"),
        F.sum(value).alias("total_revenue_vnd"),
    )


def first_purchases(orders: DataFrame) -> DataFrame:
    return orders.filter(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(
        F.min("order_date").alias("first_purchase_time")
    )


def customer_journey(
    events: DataFrame, orders: DataFrame, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """One row per customer with a touch.

    Touches and orders are each reduced to one row per customer before they
    meet, so the join cannot fan out or skew.
    """
    journeys = touchpoint_sequence(events, rows_per_task)
    return journeys.join(purchase_summary(orders), "customer_id", "left").select(
        "customer_id", "touchpoint_sequence", "first_touch_time", "last_touch_time",
        "first_purchase_time", "last_purchase_time", "total_orders", "total_revenue_vnd",
    )


def customer_journey_chunks(
    events: DataFrame, orders: DataFrame, touches_per_chunk: int = 10_000,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """The journey with its sequence in chunks: rows per (customer, chunk), none unbounded."""
    chunks = sequence_chunks(events, touches_per_chunk, rows_per_task)
    return chunks.join(purchase_summary(orders), "customer_id", "left")


def _edges(ordered: DataFrame) -> DataFrame:
    """Numbered touches with ``first_purchase_time`` to their one outgoing edge.

    A touch with a successor goes to it. A last touch goes to ``purchase`` when
    the first purchase is at or after it, to ``drop_off`` when it is earlier or
    absent, and nowhere (null type) when the touch has no time but a purchase exists.
    """
    touch, buy = F.col("touchpoint_time"), F.col("first_purchase_time")
    kind = (
        F.when(F.col("next_touchpoint_channel").isNotNull(), "touchpoint")
        .when(buy.isNotNull() & (buy >= touch), "purchase")
        .when(buy.isNull() | (buy < touch), "drop_off")
    )
    return ordered.select(
        "customer_id",
        F.col("touchpoint_number").alias("source_stage_number"),
        F.col("touchpoint_channel").alias("source_channel"),
        F.when(kind == "touchpoint", F.col("next_touchpoint_channel")).otherwise(kind)
        .alias("target_channel"),
        kind.alias("edge_type"),
    )


def _edge_rows(events: DataFrame, orders: DataFrame, rows_per_task: int) -> DataFrame:
    ordinary, bulky, heavy = split_ordered(events, rows_per_task)
    buys = first_purchases(orders)
    # Same key as the window's exchange: the join adds no shuffle of the touches.
    many = ordinary.join(buys, "customer_id", "left")
    # Spark broadcasts this side while it is small and splits hot customers beyond that.
    few_buys = buys.join(heavy, "customer_id", "left_semi")
    return _edges(many).unionByName(_edges(bulky.join(few_buys, "customer_id", "left")))


def _stage(number: Column) -> Column:
    # Two characters, as published: stage 100 reads "10".
    return F.concat(F.lit("Touch "), F.lpad(number.cast("string"), 2, "0"))


def _labels(edges: DataFrame) -> dict[str, Column]:
    source = F.col("source_stage_number")
    target = source + 1
    return {
        "source_stage_label": _stage(source),
        "target_stage_number": target,
        "target_stage_label": _stage(target),
        "source_node": F.concat(_stage(source), F.lit(" - "), F.col("source_channel")),
        "target_node": F.concat(_stage(target), F.lit(" - "), F.col("target_channel")),
    }


def customer_edges(
    events: DataFrame, orders: DataFrame, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Every step of every customer, with stage labels and node names."""
    edges = _edge_rows(events, orders, rows_per_task).filter(F.col("edge_type").isNotNull())
    return edges.withColumns(_labels(edges)).select(
        "customer_id", "source_stage_number", "source_stage_label", "target_stage_number",
        "target_stage_label", "source_node", "target_node", "source_channel", "target_channel",
        "edge_type",
    )


def total_touch_customers(events: DataFrame) -> DataFrame:
    return touches(events).agg(F.count_distinct("customer_id").alias("total_customers"))


def touch_customer_sketches(events: DataFrame) -> DataFrame:
    """(day, sketch): per day a mergeable sketch of the customers with a touch (days may be null).

    Sketches are small and of fixed size, so they can be kept and united over any days.
    """
    rows = touches(events)
    return rows.groupBy(F.to_date("touchpoint_time").alias("day")).agg(
        F.hll_sketch_agg("customer_id", F.lit(14)).alias("sketch"))


def approximate_touch_customers(
    sketches: DataFrame, first: object = None, last: object = None
) -> DataFrame:
    """One row, ``total_customers`` over the days from ``first`` to ``last``, to about one percent.

    Without bounds all days count, those of touches without a time too.
    """
    day = F.col("day")
    if first is not None:
        sketches = sketches.filter(day >= F.lit(first).cast("date"))
    if last is not None:
        sketches = sketches.filter(day <= F.lit(last).cast("date"))
    return sketches.agg(F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("sketch")), F.lit(0))
                        .alias("total_customers"))


def _edge_counts(edges: DataFrame) -> DataFrame:
    """Customers per edge.

    A customer has one touch per stage number and one edge out of each touch,
    so counting rows is counting distinct customers, without a distinct shuffle.
    """
    return edges.groupBy(
        "source_stage_number", "source_channel", "target_channel", "edge_type"
    ).agg(F.count(F.lit(1)).alias("customer_count"))


def stage_totals(
    events: DataFrame, orders: DataFrame, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Customers leaving each node."""
    edges = _edge_rows(events, orders, rows_per_task).filter(F.col("edge_type").isNotNull())
    counts = edges.groupBy("source_stage_number", "source_channel").agg(
        F.count(F.lit(1)).alias("source_stage_customer_count")
    )
    node = F.concat(_stage(F.col("source_stage_number")), F.lit(" - "), F.col("source_channel"))
    return counts.select(
        "source_stage_number", node.alias("source_node"), "source_stage_customer_count"
    )


def customer_journey_sankey(
    events: DataFrame, orders: DataFrame, rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Edge list with customer counts and shares.

    Stage totals are sums of the edge counts of a node, so they come from a
    window over the aggregated edges (a few targets per node) and not from a
    second pass and a join. Every customer has one first touch, so the overall total is the
    sum of the counts of stage one, those without an edge included.
    """
    counts = _edge_counts(_edge_rows(events, orders, rows_per_task))
    node = Window.partitionBy("source_stage_number", "source_channel")
    leads_on = F.col("edge_type").isNotNull()
    first = F.when(F.col("source_stage_number") == 1, F.col("customer_count"))
    # Both read the one exchange of edge counts: the filter comes after the window.
    total = counts.agg(F.sum(first).alias("total_customers")).scalar()
    known = counts.withColumn("source_stage_customer_count", F.sum(
        F.when(leads_on, F.col("customer_count"))).over(node)).filter(leads_on)
    known = known.withColumn("total_customers", total)
    known = known.withColumns(_labels(known))
    return known.select(
        "source_stage_number", "source_stage_label", "target_stage_number",
        "target_stage_label", "source_node", "target_node", "source_channel", "target_channel",
        "edge_type", "customer_count", "source_stage_customer_count", "total_customers",
        F.try_divide("customer_count", "source_stage_customer_count").alias("pct_of_source_stage"),
        F.try_divide("customer_count", "total_customers").alias("pct_of_total_customers"),
    )
