"""Customer lifetime aggregates and segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlake.fixed_values import SEGMENTS, UNKNOWN
from bazaarlake.plans.journey import purchase_summary
from bazaarlake.schemas import TABLES


def _segment(orders: Column, value: Column, current: Column) -> Column:
    label = None
    for name, least_orders, least_value in SEGMENTS:
        reached = orders >= least_orders
        if least_value is not None:
            reached = reached | (value >= least_value)
        label = F.when(reached, name) if label is None else label.when(reached, name)
    return label.otherwise(F.coalesce(current, F.lit(UNKNOWN)))


def merge_customer_aggregates(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Customers with order aggregates set where orders exist, plus ``is_matched``.

    Both sides hold one row per customer when they meet. Customers without an
    order keep every value, their segment included.
    """
    found = purchase_summary(orders).select(
        "customer_id",
        *[F.col(c).alias(f"_{c}") for c in (
            "first_purchase_time", "last_purchase_time", "total_orders", "total_revenue_vnd")],
    )
    hit = F.col("_total_orders").isNotNull()
    new = {
        "customer_segment": _segment(
            F.col("_total_orders"), F.col("_total_revenue_vnd"), F.col("customer_segment")),
        "lifetime_value_vnd": F.col("_total_revenue_vnd"),
        "total_orders": F.col("_total_orders"),
        "first_order_date": F.col("_first_purchase_time"),
        "last_order_date": F.col("_last_purchase_time"),
    }
    schema = TABLES["dim_customers"].schema
    columns = [
        (F.when(hit, new[f.name]).otherwise(F.col(f.name)) if f.name in new else F.col(f.name))
        .cast(f.dataType).alias(f.name)
        for f in schema
    ]
    joined = customers.join(found, "customer_id", "left")
    return joined.select(*columns, hit.alias("is_matched"))


def customer_aggregates(customers: DataFrame, orders: DataFrame) -> DataFrame:
    return merge_customer_aggregates(customers, orders).drop("is_matched")


def matched_customers(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """One row: customers the merge touches."""
    ids = orders.filter(F.col("customer_id").isNotNull()).select("customer_id").distinct()
    return customers.join(ids, "customer_id", "left_semi").agg(
        F.count(F.lit(1)).alias("affected_rows")
    )
