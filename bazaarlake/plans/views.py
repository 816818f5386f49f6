"""The four analysis views as SQL, for users of the catalog.

They give the rows of ``plans.journey`` and ``plans.finance``; the DataFrame
functions are the same logic for users of the API. The journey views carry the
second way for heavy customers too (see ``operators.touchpoints``).
"""

from __future__ import annotations

import logging

from pyspark.sql import SparkSession

from bazaarlake import fixed_values as fixed
from bazaarlake.operators.skew import ROWS_PER_TASK

log = logging.getLogger(__name__)

VIEW_TABLES = {
    "vw_customer_journey": ("fact_cart_events", "fact_orders"),
    "vw_customer_journey_sankey": ("fact_cart_events", "fact_orders"),
    "vw_cashflow_daily": ("fact_orders", "fact_payments", "fact_bank_transactions"),
    "vw_payment_status": ("fact_orders", "fact_payments"),
}


def _words(values: tuple[str, ...]) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _touches(schema: str, rows_per_task: int) -> str:
    """Touches split into ordinary customers and those with more rows than a task's."""
    return f"""
    touches AS (
        SELECT customer_id, event_timestamp AS touch_time,
               coalesce(source, '{fixed.UNKNOWN}') AS channel,
               coalesce(event_type, '{fixed.UNKNOWN}') AS kind
        FROM {schema}.fact_cart_events WHERE customer_id IS NOT NULL
    ),
    heavy AS (
        SELECT customer_id FROM touches GROUP BY customer_id
        HAVING count(*) > {rows_per_task}
    ),
    ordinary AS (
        SELECT t.* FROM touches t LEFT ANTI JOIN heavy h
        ON t.customer_id = h.customer_id
    ),
    runs AS (
        SELECT t.customer_id, date_trunc('minute', touch_time) AS minute,
               touch_time, channel, kind, count(*) AS copies
        FROM touches t LEFT SEMI JOIN heavy h ON t.customer_id = h.customer_id
        GROUP BY ALL
    )"""


def journey_sql(schema: str, rows_per_task: int = ROWS_PER_TASK) -> str:
    return f"""
    WITH {_touches(schema, rows_per_task)},
    short AS (
        SELECT customer_id,
               listagg(concat(channel, ':', kind), ' > ')
                   WITHIN GROUP (ORDER BY touch_time, concat(channel, ':', kind)) AS sequence,
               min(touch_time) AS first_touch_time, max(touch_time) AS last_touch_time
        FROM ordinary GROUP BY customer_id
    ),
    minute_texts AS (
        SELECT customer_id, minute,
               listagg(concat(channel, ':', kind,
                              repeat(concat(' > ', channel, ':', kind), int(copies) - 1)), ' > ')
                   WITHIN GROUP (ORDER BY touch_time, concat(channel, ':', kind)) AS part,
               min(touch_time) AS first_touch_time, max(touch_time) AS last_touch_time
        FROM (SELECT customer_id, minute, touch_time, channel, kind, copies FROM runs)
        GROUP BY customer_id, minute
    ),
    journeys AS (
        SELECT * FROM short
        UNION ALL
        SELECT customer_id, listagg(part, ' > ') WITHIN GROUP (ORDER BY minute),
               min(first_touch_time), max(last_touch_time)
        FROM minute_texts GROUP BY customer_id
    ),
    purchases AS (
        SELECT customer_id, min(order_date) AS first_purchase_time,
               max(order_date) AS last_purchase_time,
               count(DISTINCT order_key) AS total_orders,
               sum(coalesce(total_vnd, 0)) AS total_revenue_vnd
        FROM {schema}.fact_orders WHERE customer_id IS NOT NULL GROUP BY customer_id
    )
    SELECT j.customer_id, j.sequence AS touchpoint_sequence, j.first_touch_time,
           j.last_touch_time, p.first_purchase_time, p.last_purchase_time, p.total_orders,
           p.total_revenue_vnd
    FROM journeys j LEFT JOIN purchases p ON j.customer_id = p.customer_id"""


def sankey_sql(schema: str, rows_per_task: int = ROWS_PER_TASK) -> str:
    before = "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    stage = "concat('Touch ', lpad(string({n}), 2, '0'))"
    source, target = stage.format(n="stage"), stage.format(n="stage + 1")
    piece = ROWS_PER_TASK
    edge = """
        SELECT customer_id, stage, channel AS source_channel,
               CASE WHEN next_channel IS NOT NULL THEN next_channel
                    WHEN buy_time >= touch_time THEN 'purchase'
                    WHEN buy_time IS NULL OR buy_time < touch_time THEN 'drop_off'
               END AS target_channel,
               CASE WHEN next_channel IS NOT NULL THEN 'touchpoint'
                    WHEN buy_time >= touch_time THEN 'purchase'
                    WHEN buy_time IS NULL OR buy_time < touch_time THEN 'drop_off'
               END AS edge_type"""
    return f"""
    WITH {_touches(schema, rows_per_task)},
    purchases AS (
        SELECT customer_id, min(order_date) AS buy_time
        FROM {schema}.fact_orders WHERE customer_id IS NOT NULL GROUP BY customer_id
    ),
    heavy_purchases AS (
        SELECT p.* FROM purchases p LEFT SEMI JOIN heavy h
        ON p.customer_id = h.customer_id
    ),
    numbered AS (
        SELECT customer_id, touch_time, channel,
               row_number() OVER (PARTITION BY customer_id ORDER BY touch_time, channel, kind)
                   AS stage,
               lead(channel) OVER (PARTITION BY customer_id ORDER BY touch_time, channel, kind)
                   AS next_channel
        FROM ordinary
    ),
    local_runs AS (
        SELECT *,
               coalesce(sum(copies) OVER (PARTITION BY customer_id, minute
                   ORDER BY touch_time, channel, kind {before}), 0) AS run_start,
               lead(channel) OVER (PARTITION BY customer_id, minute
                   ORDER BY touch_time, channel, kind) AS next_in_minute
        FROM runs
    ),
    minutes AS (
        SELECT customer_id, minute, sum(copies) AS copies,
               min(struct(touch_time, channel, kind)).channel AS first_channel
        FROM runs GROUP BY customer_id, minute
    ),
    offsets AS (
        SELECT customer_id, minute,
               coalesce(sum(copies) OVER (PARTITION BY customer_id ORDER BY minute {before}), 0)
                   AS minute_start,
               lead(first_channel) OVER (PARTITION BY customer_id ORDER BY minute)
                   AS next_minute_channel
        FROM minutes
    ),
    placed AS (
        SELECT l.customer_id, touch_time, channel, copies, minute_start + run_start AS run_before,
               coalesce(next_in_minute, next_minute_channel) AS after_run
        FROM local_runs l JOIN offsets o
        ON l.customer_id = o.customer_id AND l.minute <=> o.minute
    ),
    pieces AS (
        SELECT /*+ REPARTITION(customer_id, run_before, piece) */ *
        FROM (SELECT *, explode(sequence(0L, greatest(copies - 1, 0L), {piece}L)) AS piece
              FROM placed)
    ),
    unfolded AS (
        SELECT customer_id, touch_time, channel, run_before + copy + 1 AS stage,
               CASE WHEN copy = copies - 1 THEN after_run ELSE channel END AS next_channel
        FROM (SELECT *, explode(sequence(piece, least(piece + {piece}, copies) - 1)) AS copy
              FROM pieces)
    ),
    edges AS (
        {edge.replace("customer_id", "n.customer_id")}
        FROM numbered n LEFT JOIN purchases p ON n.customer_id = p.customer_id
        UNION ALL
        {edge.replace("SELECT customer_id", "SELECT /*+ BROADCAST(p) */ u.customer_id")}
        FROM unfolded u LEFT JOIN heavy_purchases p ON u.customer_id = p.customer_id
    ),
    counted AS (
        SELECT stage, source_channel, target_channel, edge_type, count(*) AS customer_count
        FROM edges WHERE edge_type IS NOT NULL
        GROUP BY stage, source_channel, target_channel, edge_type
    ),
    totals AS (
        SELECT *, sum(customer_count) OVER (PARTITION BY stage, source_channel) AS node_count,
               (SELECT count(DISTINCT customer_id) FROM touches) AS total_customers
        FROM counted
    )
    SELECT bigint(stage) AS source_stage_number, {source} AS source_stage_label,
           bigint(stage + 1) AS target_stage_number, {target} AS target_stage_label,
           concat({source}, ' - ', source_channel) AS source_node,
           concat({target}, ' - ', target_channel) AS target_node,
           source_channel, target_channel, edge_type, customer_count,
           node_count AS source_stage_customer_count, total_customers,
           try_divide(customer_count, node_count) AS pct_of_source_stage,
           try_divide(customer_count, total_customers) AS pct_of_total_customers
    FROM totals"""


def cashflow_sql(schema: str) -> str:
    return f"""
    WITH days AS (
        SELECT order_date_key AS activity_date, sum(coalesce(total_vnd, 0)) AS sales,
               NULL AS paid, NULL AS inflow, NULL AS outflow
        FROM {schema}.fact_orders GROUP BY order_date_key
        UNION ALL
        SELECT payment_date_key, NULL, sum(coalesce(amount_vnd, 0)), NULL, NULL
        FROM {schema}.fact_payments GROUP BY payment_date_key
        UNION ALL
        SELECT transaction_date_key, NULL, NULL,
               sum(CASE WHEN amount_vnd > 0 THEN amount_vnd ELSE 0 END),
               sum(CASE WHEN amount_vnd < 0 THEN amount_vnd ELSE 0 END)
        FROM {schema}.fact_bank_transactions GROUP BY transaction_date_key
    ),
    lined_up AS (
        SELECT activity_date,
               coalesce(sum(sales) FILTER (WHERE activity_date IS NOT NULL), 0)
                   AS sales_revenue_vnd,
               coalesce(sum(paid) FILTER (WHERE activity_date IS NOT NULL), 0)
                   AS payment_received_vnd,
               coalesce(sum(inflow) FILTER (WHERE activity_date IS NOT NULL), 0)
                   AS bank_inflow_vnd,
               coalesce(sum(outflow) FILTER (WHERE activity_date IS NOT NULL), 0)
                   AS bank_outflow_vnd
        FROM days GROUP BY activity_date
    )
    SELECT *, payment_received_vnd + bank_inflow_vnd + bank_outflow_vnd AS net_cashflow_vnd
    FROM lined_up"""


def payment_status_sql(schema: str, as_of: str | None = None) -> str:
    today = f"date'{as_of}'" if as_of else "current_date()"
    payment = "payment_key, payment_gateway, payment_method, payment_status, payment_date"
    order = "order_key, order_id, transaction_id, customer_id, order_date, status"
    every = f"{order}, total_vnd, {payment}, payment_amount_vnd"
    alone = (
        f"{order}, total_vnd, string(NULL) AS payment_key, "
        "string(NULL) AS payment_gateway, string(NULL) AS payment_method, "
        "string(NULL) AS payment_status, timestamp(NULL) AS payment_date, "
        "NULL AS payment_amount_vnd"
    )
    return f"""
    WITH orders AS (
        SELECT {order}, total_vnd FROM {schema}.fact_orders
    ),
    payments AS (
        SELECT transaction_id, {payment}, amount_vnd AS payment_amount_vnd
        FROM {schema}.fact_payments WHERE transaction_id IS NOT NULL
    ),
    joined AS (
        SELECT {every} FROM orders JOIN payments USING (transaction_id)
        UNION ALL
        SELECT {alone} FROM orders LEFT ANTI JOIN (SELECT DISTINCT transaction_id FROM payments)
        USING (transaction_id) WHERE transaction_id IS NOT NULL
        UNION ALL
        SELECT {alone} FROM orders WHERE transaction_id IS NULL
    )
    SELECT {order} AS order_status, total_vnd AS order_total_vnd, {payment}, payment_amount_vnd,
           timestampdiff(HOUR, order_date, payment_date) AS payment_delay_hours,
           greatest(coalesce(total_vnd, 0) - coalesce(payment_amount_vnd, 0), 0)
               AS outstanding_amount,
           CASE WHEN lower(coalesce(payment_status, '')) IN ({_words(fixed.VIEW_PAID)})
                    THEN 'Paid'
                WHEN payment_date IS NULL
                     AND to_date(order_date) < date_sub({today}, {fixed.OVERDUE_AFTER_DAYS})
                    THEN 'Overdue'
                WHEN lower(coalesce(payment_status, '')) IN ({_words(fixed.VIEW_PENDING)})
                    THEN 'Pending'
                WHEN lower(coalesce(payment_status, '')) IN ({_words(fixed.VIEW_FAILED)})
                    THEN 'Failed'
                ELSE 'Pending'
           END AS payment_status_category
    FROM joined"""


_VIEW_SQL = {
    "vw_customer_journey": journey_sql,
    "vw_customer_journey_sankey": sankey_sql,
    "vw_cashflow_daily": cashflow_sql,
    "vw_payment_status": payment_status_sql,
}


def create_views(spark: SparkSession, schema: str) -> int:
    """Create or replace each view whose tables exist; returns how many."""
    created = 0
    for view, tables in VIEW_TABLES.items():
        missing = [t for t in tables if not spark.catalog.tableExists(f"{schema}.{t}")]
        if missing:
            log.warning("view %s skipped, tables missing: %s", view, missing)
            continue
        spark.sql(f"CREATE OR REPLACE VIEW {schema}.{view} AS {_VIEW_SQL[view](schema)}")
        created += 1
    return created
