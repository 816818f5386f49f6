"""Daily cashflow and payment status."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlake import fixed_values as fixed


def _money(value: object) -> Column:
    return F.coalesce(value, F.lit(0).cast("decimal(18,2)"))


def daily_order_revenue(orders: DataFrame) -> DataFrame:
    """Sales per order day; orders without a date form one group."""
    return orders.groupBy(F.col("order_date_key").alias("activity_date")).agg(
        F.sum(_money("total_vnd")).alias("sales_revenue_vnd")
    )


def daily_payments(payments: DataFrame) -> DataFrame:
    return payments.groupBy(F.col("payment_date_key").alias("activity_date")).agg(
        F.sum(_money("amount_vnd")).alias("payment_received_vnd")
    )


def daily_bank_flows(bank: DataFrame) -> DataFrame:
    """Inflow above zero, outflow below zero (kept negative)."""
    amount = _money("amount_vnd")
    zero = F.lit(0).cast("decimal(18,2)")
    return bank.groupBy(F.col("transaction_date_key").alias("activity_date")).agg(
        F.sum(F.when(amount > 0, amount).otherwise(zero)).alias("bank_inflow_vnd"),
        F.sum(F.when(amount < 0, amount).otherwise(zero)).alias("bank_outflow_vnd"),
    )


def union_distinct_dates(orders: DataFrame, payments: DataFrame, bank: DataFrame) -> DataFrame:
    """Every day with an order, payment or bank movement; one null row if any lacks a date."""
    return (
        orders.select(F.col("order_date_key").alias("activity_date"))
        .union(payments.select("payment_date_key"))
        .union(bank.select("transaction_date_key"))
        .distinct()
    )


_FLOWS = ("sales_revenue_vnd", "payment_received_vnd", "bank_inflow_vnd", "bank_outflow_vnd")


def cashflow_daily(orders: DataFrame, payments: DataFrame, bank: DataFrame) -> DataFrame:
    """Sales, payments and bank flows side by side per day.

    The three sources are reduced to days first, then lined up by one grouped
    union: one small exchange in place of a distinct and three joins. Rows
    without a date keep their row but match nothing, so it shows zeros.
    """
    days = daily_order_revenue(orders)
    for part in (daily_payments(payments), daily_bank_flows(bank)):
        days = days.unionByName(part, allowMissingColumns=True)
    dated = F.col("activity_date").isNotNull()
    lined_up = days.groupBy("activity_date").agg(
        *[F.coalesce(F.sum(F.when(dated, F.col(c))), F.lit(0)).alias(c) for c in _FLOWS]
    )
    net = F.col("payment_received_vnd") + F.col("bank_inflow_vnd") + F.col("bank_outflow_vnd")
    return lined_up.select("activity_date", *_FLOWS, net.alias("net_cashflow_vnd"))


_PAYMENT_COLUMNS = (
    "payment_key", "payment_gateway", "payment_method", "payment_status", "payment_date",
)


def join_order_payment(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """Orders with each of their payments, matched on the transaction.

    A left join lets AQE split a hot transaction on the order side only.
    Written as matches plus orders without a match, both sides can be split:
    the match is an inner join, and the rest is an anti join against distinct
    transactions (pre-aggregated, so at most one row per key and map task).
    Orders without a transaction never match and skip both shuffles. Columns are
    renamed last: both joins then ask for the same exchange of orders, which
    Spark reuses.
    """
    left = orders.select(
        "order_key", "order_id", "transaction_id", "customer_id", "order_date", "status",
        "total_vnd",
    )
    right = payments.filter(F.col("transaction_id").isNotNull()).select(
        "transaction_id", *_PAYMENT_COLUMNS, F.col("amount_vnd").alias("payment_amount_vnd")
    )
    named = left.filter(F.col("transaction_id").isNotNull())
    paid = named.join(right, "transaction_id", "inner")
    unpaid = named.join(right.select("transaction_id").distinct(), "transaction_id", "left_anti")
    unnamed = left.filter(F.col("transaction_id").isNull())
    joined = paid.unionByName(unpaid, allowMissingColumns=True).unionByName(
        unnamed, allowMissingColumns=True
    )
    return joined.withColumnsRenamed({"status": "order_status", "total_vnd": "order_total_vnd"})


def payment_status(
    orders: DataFrame, payments: DataFrame, as_of: dt.date | str | None = None
) -> DataFrame:
    """One row per order and payment with delay, open amount and category.

    ``as_of`` is the day overdue orders are judged on, today by default.
    """
    rows = join_order_payment(orders, payments)
    today = F.current_date() if as_of is None else F.to_date(F.lit(as_of))
    status = F.lower(F.coalesce("payment_status", F.lit("")))
    overdue = F.col("payment_date").isNull() & (
        F.to_date("order_date") < F.date_sub(today, fixed.OVERDUE_AFTER_DAYS)
    )
    category = (
        F.when(status.isin(*fixed.VIEW_PAID), "Paid")
        .when(overdue, "Overdue")
        .when(status.isin(*fixed.VIEW_PENDING), "Pending")
        .when(status.isin(*fixed.VIEW_FAILED), "Failed")
        .otherwise("Pending")
    )
    open_amount = F.greatest(
        _money("order_total_vnd") - _money("payment_amount_vnd"), F.lit(0).cast("decimal(19,2)")
    )
    return rows.select(
        "order_key", "order_id", "transaction_id", "customer_id", "order_date", "order_status",
        "order_total_vnd", *_PAYMENT_COLUMNS, "payment_amount_vnd",
        F.timestamp_diff("HOUR", F.col("order_date"), F.col("payment_date"))
        .alias("payment_delay_hours"),
        open_amount.alias("outstanding_amount"),
        category.alias("payment_status_category"),
    )
