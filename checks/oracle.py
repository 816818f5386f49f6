"""The registered queries restated as SQL over the base tables.

``with_tables("fact_orders", "select ...")`` prepends the common table
expressions a query needs. Money is summed as DECIMAL and shown as DOUBLE, days
are shown as text, so both engines print the same values.
"""

from __future__ import annotations

import re

from bazaarlake.operators.quality import quality_rules
from bazaarlake.schemas import TABLES

AS_OF = "2026-06-01"
NOW = "2027-01-01 00:00:00"

_CTES = {
    "raw_orders": """
        SELECT o_orderkey AS k, o_custkey AS customer,
               CASE WHEN o_orderkey % 50 <> 0 THEN 'TXN-' || o_orderkey END AS txn,
               o_orderdate + INTERVAL 344 MONTH AS moment,
               o_totalprice AS total, floor(o_totalprice / 250) / 100 AS usd,
               'City ' || (o_orderkey % 10) AS city, 'Street ' || (o_orderkey % 100) AS street,
               CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending' END AS state,
               CASE WHEN o_orderkey % 7 <> 0 THEN 'paid' END AS paid,
               substr(o_orderpriority, 1, 1) AS p
        FROM orders""",
    "fact_orders": """
        SELECT k || '_' || coalesce(txn, '') AS order_key, k::VARCHAR AS order_id,
               txn AS transaction_id, customer AS customer_id, moment::DATE AS order_date_key,
               moment AS order_date,
               CASE k % 3 WHEN 0 THEN 'shopify' WHEN 1 THEN 'sapo_pos' ELSE 'online' END
                   AS channel,
               CASE k % 3 WHEN 0 THEN 'shopify' WHEN 1 THEN 'sapo' ELSE 'online_orders' END
                   AS source,
               city AS shipping_city, street AS shipping_address,
               coalesce(state, 'unknown') AS status,
               CASE WHEN k % 3 = 1 THEN 'unknown' ELSE coalesce(paid, 'unknown') END
                   AS payment_status,
               total::DECIMAL(18,2) AS total_vnd,
               CASE WHEN k % 3 = 1 THEN 0 ELSE usd END::DECIMAL(18,2) AS total_usd
        FROM raw_orders
        QUALIFY row_number() OVER (PARTITION BY order_key ORDER BY k % 3, k) = 1""",
    "raw_lines": """
        SELECT o.*, l_partkey AS product, l_quantity AS quantity,
               (floor(l_extendedprice * 100 / l_quantity) / 100)::DECIMAL(18,2) AS price,
               CASE WHEN l_linenumber <> 1 THEN l_extendedprice END AS line_total,
               l_linenumber, l_suppkey, l_extendedprice
        FROM raw_orders o JOIN lineitem ON l_orderkey = k""",
    "fact_order_items": """
        SELECT order_key || '_' || product || '_' || coalesce(txn, '') AS order_item_key,
               order_key, txn AS transaction_id, product AS product_id,
               moment::DATE AS order_date_key, quantity, price AS unit_price_vnd,
               coalesce(line_total, quantity * price::DOUBLE)::DECIMAL(18,2) AS line_total_vnd
        FROM (SELECT *, k || '_' || coalesce(txn, '') AS order_key FROM raw_lines)
        QUALIFY row_number() OVER (
            PARTITION BY order_item_key
            ORDER BY k % 3, l_linenumber, l_suppkey, l_extendedprice, quantity) = 1""",
    "raw_payments": """
        SELECT gateway, n, k, customer, coalesce(txn, 'PAY-' || k) AS txn,
               [' Success ', 'completed', 'pending', 'error', 'refunded'][p::INT] AS word,
               CASE WHEN k % 17 <> 0 THEN moment + to_hours(k % 200) END AS moment,
               CASE WHEN k % 3 = 0 THEN total ELSE floor(total * 50) / 100 END AS amount
        FROM raw_orders, (VALUES ('momo', 0), ('odoo', 1), ('paypal', 2), ('sapo', 3),
                                 ('zalopay', 4)) g(gateway, n)
        WHERE (k % 4 <> 0 AND k % 5 = n) OR (n = 1 AND k % 22 = 2)""",
    "payment_words": """
        SELECT *, CASE lower(trim(word)) WHEN 'success' THEN 'paid' WHEN 'completed' THEN 'paid'
                       WHEN 'pending' THEN 'pending' WHEN 'error' THEN 'failed'
                       ELSE word END AS said
        FROM raw_payments""",
    "fact_payments": """
        SELECT txn || '_' || gateway || '_' || k AS payment_key, txn AS transaction_id,
               k::VARCHAR AS order_id, customer AS customer_id, gateway AS payment_gateway,
               CASE gateway WHEN 'momo' THEN 'wallet' WHEN 'odoo' THEN 'card'
                    WHEN 'sapo' THEN 'counter' ELSE 'unknown' END AS payment_method,
               amount::DECIMAL(18,2) AS amount_vnd,
               CASE WHEN gateway = 'momo' AND k % 10 = 0 THEN 'paid'
                    WHEN gateway = 'momo' AND k % 3 <> 0 THEN 'failed'
                    WHEN gateway = 'momo' THEN 'pending'
                    WHEN gateway = 'zalopay' AND k % 2 = 0 THEN 'paid'
                    WHEN gateway = 'zalopay' AND k % 3 = 0 THEN 'failed'
                    ELSE said END AS payment_status,
               moment::DATE AS payment_date_key, moment AS payment_date
        FROM payment_words""",
    "fact_bank_transactions": """
        SELECT c_custkey || '_' || c_nationkey AS transaction_key,
               c_custkey::VARCHAR AS transaction_id, c_nationkey::VARCHAR AS account_id,
               CASE WHEN c_acctbal < 0 THEN 'transfer' ELSE 'unknown' END AS transaction_type,
               c_acctbal::DECIMAL(18,2) AS amount_vnd,
               CASE WHEN c_custkey % 5 <> 0 THEN 'settled' ELSE 'unknown' END AS status,
               transaction_date::DATE AS transaction_date_key, transaction_date
        FROM (SELECT *, CASE WHEN c_custkey % 97 <> 0 THEN
                        (DATE '2023-09-01' + (c_custkey % 365)::INT)::TIMESTAMP END
                        AS transaction_date FROM customer)""",
    "fact_cart_events": """
        SELECT event_id || '_' || session_id AS event_key, event_id::VARCHAR AS event_id,
               session_id, CASE WHEN event_id % 13 <> 0 THEN user_id END AS customer_id,
               event_type, ts::DATE AS event_date_key, ts AS event_timestamp,
               event_id % 100 AS product_id,
               CASE pick WHEN 0 THEN 'ads' WHEN 1 THEN 'email' WHEN 2 THEN 'organic' END
                   AS source,
               CASE WHEN event_id % 2 = 0 THEN 'mobile' END AS device, 'chrome' AS browser,
               NULL::VARCHAR AS utm_source,
               CASE WHEN pick = 0 THEN 'spring' END AS utm_campaign
        FROM (SELECT *, user_id || '-' || strftime(ts, '%Y%m%d') AS session_id,
                     regexp_extract(props, '([0-9]+)', 1)::INT % 4 AS pick FROM events)""",
    "dim_customers": """
        SELECT c_custkey AS customer_id,
               CASE WHEN c_custkey % 9 <> 0 THEN 'user' || c_custkey || '@example.com' END
                   AS email,
               c_name AS full_name, NULL::VARCHAR AS phone, NULL::VARCHAR AS city,
               n_name AS country,
               (DATE '2023-01-01' + (c_custkey % 700)::INT)::TIMESTAMP AS created_at,
               CASE WHEN c_custkey % 3 <> 0 THEN lower(c_mktsegment) ELSE 'unknown' END
                   AS customer_segment,
               0::DECIMAL(18,2) AS lifetime_value_vnd, 0 AS total_orders,
               NULL::TIMESTAMP AS first_order_date, NULL::TIMESTAMP AS last_order_date
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "raw_products": """
        SELECT p_partkey AS id, p_name AS name, 'SKU-' || p_partkey AS sku,
               p_type AS category, p_brand AS brand,
               CASE WHEN p_partkey % 11 <> 0 THEN p_retailprice END AS price_vnd,
               CASE WHEN p_partkey % 7 <> 0 THEN p_size END AS stock_quantity,
               CASE p_partkey % 5 WHEN 0 THEN ' No ' WHEN 1 THEN 'yes' END AS is_active
        FROM part""",
    "dim_products": """
        SELECT id AS product_id, name AS product_name, sku, NULL::VARCHAR AS barcode, category,
               brand, coalesce(price_vnd, 0)::DECIMAL(18,2) AS price_vnd,
               0::DECIMAL(18,2) AS price_usd, coalesce(stock_quantity, 0) AS stock_quantity,
               is_active IS NULL OR is_active = 'yes' AS is_active
        FROM raw_products""",
    "sapo_locations": """
        SELECT s_suppkey AS location_id, 'S' || s_suppkey AS location_code,
               s_name AS location_name,
               CASE WHEN s_suppkey % 3 = 0 THEN 'warehouse' ELSE 'store' END AS location_type,
               n_name AS city, NULL::VARCHAR AS address, NULL::VARCHAR AS phone,
               s_acctbal >= 0 AS is_active
        FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey""",
    "order_locations": """
        SELECT k, (1000 + k % 20)::VARCHAR AS location_id, 'LC' || (k % 20) AS location_code,
               'Store ' || (k % 20) AS location_name, 'store' AS location_type,
               'City ' || (k % 20) AS city, NULL::VARCHAR AS address, NULL::VARCHAR AS phone,
               true AS is_active
        FROM raw_orders WHERE k % 3 = 2 AND k % 4 <> 0""",
    "dim_locations": """
        SELECT * EXCLUDE (rank, k) FROM (
            SELECT 0 AS rank, location_id AS k, * FROM sapo_locations
            UNION ALL
            SELECT 1, k, location_id::BIGINT, * EXCLUDE (k, location_id) FROM order_locations)
        QUALIFY row_number() OVER (PARTITION BY location_id ORDER BY rank, k) = 1""",
    "dim_staff": """
        SELECT s_suppkey AS staff_id, NULL::VARCHAR AS staff_code, s_name AS full_name,
               CASE WHEN s_suppkey % 4 <> 0 THEN 'clerk' ELSE 'unknown' END AS position,
               NULL::VARCHAR AS email, NULL::VARCHAR AS phone, s_suppkey % 10 AS location_id,
               (DATE '2022-01-01' + (s_suppkey % 500)::INT)::TIMESTAMP AS hire_date,
               s_suppkey % 6 <> 0 AS is_active
        FROM supplier""",
    "fact_ranges": """
        SELECT min(order_date) AS lo, max(order_date) AS hi FROM fact_orders
        UNION ALL SELECT min(payment_date), max(payment_date) FROM fact_payments
        UNION ALL SELECT min(event_timestamp), max(event_timestamp) FROM fact_cart_events
        UNION ALL SELECT min(transaction_date), max(transaction_date)
        FROM fact_bank_transactions""",
    "dim_date": """
        SELECT strftime(d, '%Y%m%d')::INT AS date_key, d::DATE AS full_date, year(d) AS year,
               quarter(d) AS quarter, month(d) AS month, monthname(d) AS month_name,
               weekofyear(d) AS week, day(d) AS day_of_month, isodow(d) AS day_of_week,
               dayname(d) AS day_name, isodow(d) >= 6 AS is_weekend,
               d::DATE IN (DATE '2024-01-01', DATE '2024-12-25') AS is_holiday,
               year(d) AS fiscal_year, quarter(d) AS fiscal_quarter
        FROM (SELECT unnest(generate_series((SELECT min(lo)::DATE::TIMESTAMP FROM fact_ranges),
                                            (SELECT max(hi)::DATE::TIMESTAMP FROM fact_ranges),
                                            INTERVAL 1 DAY)) AS d)""",
    "purchases": """
        SELECT customer_id, min(order_date) AS first_purchase_time,
               max(order_date) AS last_purchase_time,
               count(DISTINCT order_key) AS total_orders,
               sum(coalesce(total_vnd, 0)) AS total_revenue_vnd
        FROM fact_orders WHERE customer_id IS NOT NULL GROUP BY customer_id""",
    "sequences": """
        SELECT customer_id,
               string_agg(token, ' > ' ORDER BY event_timestamp NULLS FIRST, token)
                   AS touchpoint_sequence,
               min(event_timestamp) AS first_touch_time, max(event_timestamp) AS last_touch_time
        FROM (SELECT *, coalesce(source, 'unknown') || ':' || coalesce(event_type, 'unknown')
                        AS token FROM fact_cart_events WHERE customer_id IS NOT NULL)
        GROUP BY customer_id""",
    "ordered": """
        SELECT customer_id, event_timestamp AS touchpoint_time,
               coalesce(source, 'unknown') AS touchpoint_channel,
               coalesce(event_type, 'unknown') AS event_type,
               row_number() OVER w AS touchpoint_number,
               lead(coalesce(source, 'unknown')) OVER w AS next_touchpoint_channel,
               count(*) OVER (PARTITION BY customer_id) AS total_touchpoints
        FROM fact_cart_events WHERE customer_id IS NOT NULL
        WINDOW w AS (PARTITION BY customer_id
                     ORDER BY event_timestamp NULLS FIRST, coalesce(source, 'unknown'),
                              coalesce(event_type, 'unknown'))""",
    "edge_rows": """
        SELECT customer_id, touchpoint_number AS source_stage_number,
               touchpoint_number + 1 AS target_stage_number,
               touchpoint_channel AS source_channel, next_touchpoint_channel AS target_channel,
               'touchpoint' AS edge_type
        FROM ordered WHERE next_touchpoint_channel IS NOT NULL
        UNION ALL
        SELECT t.customer_id, total_touchpoints, total_touchpoints + 1, touchpoint_channel,
               'purchase', 'purchase'
        FROM ordered t JOIN purchases p ON t.customer_id = p.customer_id
        WHERE touchpoint_number = total_touchpoints AND first_purchase_time IS NOT NULL
              AND first_purchase_time >= touchpoint_time
        UNION ALL
        SELECT t.customer_id, total_touchpoints, total_touchpoints + 1, touchpoint_channel,
               'drop_off', 'drop_off'
        FROM ordered t LEFT JOIN purchases p ON t.customer_id = p.customer_id
        WHERE touchpoint_number = total_touchpoints
              AND (first_purchase_time IS NULL OR first_purchase_time < touchpoint_time)""",
    "edges": """
        SELECT customer_id, source_stage_number,
               'Touch ' || lpad(source_stage_number::VARCHAR, 2, '0') AS source_stage_label,
               target_stage_number,
               'Touch ' || lpad(target_stage_number::VARCHAR, 2, '0') AS target_stage_label,
               'Touch ' || lpad(source_stage_number::VARCHAR, 2, '0') || ' - ' || source_channel
                   AS source_node,
               'Touch ' || lpad(target_stage_number::VARCHAR, 2, '0') || ' - ' || target_channel
                   AS target_node,
               source_channel, target_channel, edge_type
        FROM edge_rows""",
    "node_totals": """
        SELECT source_stage_number, source_node,
               count(DISTINCT customer_id) AS source_stage_customer_count
        FROM edges GROUP BY ALL""",
    "revenue_days": """
        SELECT order_date_key AS activity_date, sum(coalesce(total_vnd, 0)) AS sales_revenue_vnd
        FROM fact_orders GROUP BY 1""",
    "payment_days": """
        SELECT payment_date_key AS activity_date,
               sum(coalesce(amount_vnd, 0)) AS payment_received_vnd
        FROM fact_payments GROUP BY 1""",
    "bank_days": """
        SELECT transaction_date_key AS activity_date,
               sum(CASE WHEN coalesce(amount_vnd, 0) > 0 THEN amount_vnd ELSE 0 END)
                   AS bank_inflow_vnd,
               sum(CASE WHEN coalesce(amount_vnd, 0) < 0 THEN amount_vnd ELSE 0 END)
                   AS bank_outflow_vnd
        FROM fact_bank_transactions GROUP BY 1""",
    "all_days": """
        SELECT activity_date FROM revenue_days UNION SELECT activity_date FROM payment_days
        UNION SELECT activity_date FROM bank_days""",
    "merged_customers": """
        SELECT c.* REPLACE (
               coalesce(p.total_revenue_vnd, c.lifetime_value_vnd) AS lifetime_value_vnd,
               coalesce(p.total_orders, c.total_orders) AS total_orders,
               coalesce(p.first_purchase_time, c.first_order_date) AS first_order_date,
               coalesce(p.last_purchase_time, c.last_order_date) AS last_order_date,
               CASE WHEN p.total_orders >= 10 OR p.total_revenue_vnd >= 10000000 THEN 'vip'
                    WHEN p.total_orders >= 5 OR p.total_revenue_vnd >= 5000000 THEN 'loyal'
                    WHEN p.total_orders >= 1 THEN 'active'
                    ELSE coalesce(c.customer_segment, 'unknown') END AS customer_segment)
        FROM dim_customers c LEFT JOIN purchases p ON c.customer_id = p.customer_id""",
    "texts": """
        SELECT o_orderkey AS k,
               CASE o_orderkey % 5 WHEN 0 THEN o_orderkey || '' WHEN 1 THEN o_orderkey || '.0'
                    WHEN 2 THEN o_orderkey || '.5' WHEN 3 THEN 'invalid' END AS number,
               o_orderdate AS moment
        FROM orders""",
}

_NAME = re.compile(r"\b(" + "|".join(_CTES) + r")\b")


def with_tables(query: str) -> str:
    """Prepend the expressions ``query`` names, and what those name, in dependency order."""
    order: list[str] = []

    def need(text: str, me: str = "") -> None:
        for name in dict.fromkeys(_NAME.findall(text)):
            if name != me and name not in order:
                need(_CTES[name], name)
                order.append(name)

    need(query)
    if not order:
        return query
    ctes = ",\n".join(f"{name} AS ({_CTES[name]})" for name in order)
    return f"WITH {ctes}\n{query}"


def _money(*columns: str) -> str:
    return "* REPLACE (" + ", ".join(columns) + ")"


def _double(*columns: str) -> list[str]:
    return [f"{c}::DOUBLE AS {c}" for c in columns]


def _day(*columns: str) -> list[str]:
    return [f"{c}::VARCHAR AS {c}" for c in columns]


def _table(name: str, money: tuple[str, ...] = (), days: tuple[str, ...] = ()) -> str:
    changes = _double(*money) + _day(*days)
    return f"SELECT {_money(*changes) if changes else '*'} FROM {name}"


ORDERS = _table("fact_orders", ("total_vnd", "total_usd"), ("order_date_key",))
ITEMS = _table("fact_order_items", ("unit_price_vnd", "line_total_vnd"), ("order_date_key",))
PAYMENTS = _table("fact_payments", ("amount_vnd",), ("payment_date_key",))
BANK = _table("fact_bank_transactions", ("amount_vnd",), ("transaction_date_key",))
EVENTS = _table("fact_cart_events", (), ("event_date_key",))
CUSTOMERS = _table("dim_customers", ("lifetime_value_vnd",))
MERGED = _table("merged_customers", ("lifetime_value_vnd",))
JOURNEY = """
    SELECT s.customer_id, touchpoint_sequence, first_touch_time, last_touch_time,
           first_purchase_time, last_purchase_time, total_orders,
           total_revenue_vnd::DOUBLE AS total_revenue_vnd
    FROM sequences s LEFT JOIN purchases p ON s.customer_id = p.customer_id"""
SANKEY = """
    SELECT e.source_stage_number, source_stage_label, target_stage_number, target_stage_label,
           e.source_node, target_node, source_channel, target_channel, edge_type,
           count(DISTINCT e.customer_id) AS customer_count, s.source_stage_customer_count,
           t.total_customers,
           round(count(DISTINCT e.customer_id) / s.source_stage_customer_count, 6)
               AS pct_of_source_stage,
           round(count(DISTINCT e.customer_id) / t.total_customers, 6) AS pct_of_total_customers
    FROM edges e
    JOIN node_totals s ON e.source_stage_number = s.source_stage_number
                       AND e.source_node = s.source_node
    CROSS JOIN (SELECT count(DISTINCT customer_id) AS total_customers FROM ordered) t
    GROUP BY e.source_stage_number, source_stage_label, target_stage_number, target_stage_label,
             e.source_node, target_node, source_channel, target_channel, edge_type,
             s.source_stage_customer_count, t.total_customers"""
CASHFLOW = """
    SELECT d.activity_date::VARCHAR AS activity_date,
           coalesce(sales_revenue_vnd, 0)::DOUBLE AS sales_revenue_vnd,
           coalesce(payment_received_vnd, 0)::DOUBLE AS payment_received_vnd,
           coalesce(bank_inflow_vnd, 0)::DOUBLE AS bank_inflow_vnd,
           coalesce(bank_outflow_vnd, 0)::DOUBLE AS bank_outflow_vnd,
           (coalesce(payment_received_vnd, 0) + coalesce(bank_inflow_vnd, 0)
            + coalesce(bank_outflow_vnd, 0))::DOUBLE AS net_cashflow_vnd
    FROM all_days d
    LEFT JOIN revenue_days o ON d.activity_date = o.activity_date
    LEFT JOIN payment_days p ON d.activity_date = p.activity_date
    LEFT JOIN bank_days b ON d.activity_date = b.activity_date"""
PAYMENT_STATUS = f"""
    SELECT o.order_key, o.order_id, o.transaction_id, o.customer_id, o.order_date,
           o.status AS order_status, o.total_vnd::DOUBLE AS order_total_vnd, p.payment_key,
           p.payment_gateway, p.payment_method, p.payment_status, p.payment_date,
           p.amount_vnd::DOUBLE AS payment_amount_vnd,
           date_sub('hour', o.order_date, p.payment_date) AS payment_delay_hours,
           greatest(coalesce(o.total_vnd, 0) - coalesce(p.amount_vnd, 0), 0)::DOUBLE
               AS outstanding_amount,
           CASE WHEN lower(coalesce(p.payment_status, '')) IN ('paid', 'completed', 'success')
                    THEN 'Paid'
                WHEN p.payment_date IS NULL
                     AND o.order_date::DATE < DATE '{AS_OF}' - 7 THEN 'Overdue'
                WHEN lower(coalesce(p.payment_status, '')) IN ('pending', 'processing')
                    THEN 'Pending'
                WHEN lower(coalesce(p.payment_status, '')) IN ('failed', 'error') THEN 'Failed'
                ELSE 'Pending' END AS payment_status_category
    FROM fact_orders o LEFT JOIN fact_payments p ON o.transaction_id = p.transaction_id"""


def _amounts(table: str, column: str) -> str:
    return f"""
    SELECT '{column}' AS column_name, count_if(v < 0) AS negative_count,
           count_if(v < q1 - 1.5 * (q3 - q1) OR v > q3 + 1.5 * (q3 - q1)) AS outlier_count,
           round(avg(v), 4) AS mean, round(any_value(q2), 4) AS median,
           round(coalesce(stddev_samp(v), 0), 4) AS std_dev, min(v) AS min, max(v) AS max
    FROM (SELECT {column}::DOUBLE AS v FROM {table} WHERE {column} IS NOT NULL),
         (SELECT quantile_cont({column}::DOUBLE, 0.25) AS q1,
                 quantile_cont({column}::DOUBLE, 0.5) AS q2,
                 quantile_cont({column}::DOUBLE, 0.75) AS q3 FROM {table})"""


def _report(table: str, columns: int, critical: tuple[str, ...], date: str | None,
            amounts: tuple[str, ...], merged: str) -> list[str]:
    def row(section: str, column: str, metric: str, number: str, text: str, source: str) -> str:
        return (f"SELECT '{table}' AS table_name, '{section}' AS section, "
                f"{column} AS column_name, '{metric}' AS metric, ({number})::DOUBLE AS number, "
                f"{text} AS text FROM {source}")

    no = "NULL::VARCHAR"
    rows = [
        row("shape", no, "row_count", "count(*)", no, table),
        row("shape", no, "column_count", str(columns), no, "(SELECT 1)"),
        row("duplicates", no, "duplicate_count", merged, no, "(SELECT 1)"),
    ]
    rows += [
        row("nulls", f"'{c}'", "null_count", "n", no,
            f"(SELECT count_if({c} IS NULL) AS n FROM {table}) WHERE n > 0") for c in critical
    ]
    if date:
        stamp = "strftime({}, '%Y-%m-%d %H:%M:%S')"
        for metric, fn in (("min_date", "min"), ("max_date", "max")):
            rows.append(row("dates", f"'{date}'", metric, "NULL", stamp.format(f"{fn}({date})"),
                            table))
        late = f"count_if({date} > TIMESTAMP '{NOW}')"
        rows += [
            row("dates", f"'{date}'", "future_dates", late, no, table),
            row("dates", f"'{date}'", "below_min_date", "0", no, "(SELECT 1)"),
            row("dates", f"'{date}'", "above_max_date", late, no, table),
        ]
    for c in amounts:
        profile = f"({_amounts(table, c)})"
        rows += [
            row("amounts", f"'{c}'", m, m, no, profile)
            for m in ("negative_count", "outlier_count", "mean", "median", "std_dev", "min", "max")
        ]
    return rows


_LINES = "(SELECT count(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"
# Raw rows beyond the first of a key, where feeds have any.
_MERGED_ROWS = {
    "fact_orders": _LINES,
    "fact_order_items": f"{_LINES} - (SELECT count(*) FROM fact_order_items)",
    "dim_locations": """(SELECT count(*) FROM sapo_locations) + (SELECT count(*) FROM raw_orders
        WHERE k % 3 = 2 AND k % 4 <> 0) + (SELECT count(*) FROM lineitem JOIN raw_orders ON
        l_orderkey = k WHERE k % 3 = 2 AND k % 4 <> 0) - (SELECT count(*) FROM dim_locations)""",
}
QUALITY_REPORT = "\nUNION ALL\n".join(
    row for name, rules in quality_rules().items() for row in _report(
        name, len(TABLES[name].schema), rules.critical_columns, *(rules.date_columns or (None,)),
        rules.amount_columns, _MERGED_ROWS.get(name, "0")))


def _counts(*tables: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{t}' AS name, count(*) AS row_count FROM {t}" for t in tables)


_SUMS = {"string": "length({c})", "timestamp": "floor(epoch({c}))::BIGINT", "boolean": "{c}::INT",
         "date": "date_diff('day', DATE '1970-01-01', {c})"}


def _profiles(*tables: str, **sources: str) -> str:
    """Rows, and per column the values that are not null and a sum over them."""
    def cells(table: str) -> str:
        return ", ".join(
            f"{{'column_name': '{f.name}', 'known': count({f.name}), 'total': coalesce(sum("
            + _SUMS.get(f.dataType.simpleString(), "{c}").format(c=f.name)
            + ")::DOUBLE, 0)}" for f in TABLES[table].schema)

    return " UNION ALL ".join(
        f"SELECT name, row_count, unnest(cells, recursive := true) FROM (SELECT '{t}' AS name, "
        f"count(*) AS row_count, [{cells(t)}] AS cells FROM {sources.get(t, t)})"
        for t in tables)


_FACTS = ("fact_orders", "fact_order_items", "fact_payments", "fact_cart_events",
          "fact_bank_transactions")
_DIMENSIONS = ("dim_customers", "dim_products", "dim_locations", "dim_date")
_GATEWAYS = ("momo", "odoo", "paypal", "sapo", "zalopay")
_BOOL_TEXT = """CASE k % 8 WHEN 0 THEN true WHEN 1 THEN false WHEN 2 THEN true WHEN 3 THEN false
    WHEN 4 THEN true WHEN 7 THEN false END"""
_INT = "CASE WHEN k % 5 < 2 THEN k END"
_FLOAT = "CASE WHEN k % 5 < 2 THEN k::DOUBLE WHEN k % 5 = 2 THEN k + 0.5 END"

SQL = {
    # projections and schema conforming
    "standardize_names": "SELECT * FROM raw_products",
    "rename_columns": "SELECT * RENAME (id AS product_id, name AS product_name) FROM raw_products",
    "ensure_columns": """SELECT * RENAME (id AS product_id, name AS product_name),
        NULL::VARCHAR AS barcode, NULL::DOUBLE AS price_usd FROM raw_products""",
    "conform": """SELECT id AS product_id, name AS product_name, sku, NULL::VARCHAR AS barcode,
        category, brand, price_vnd, NULL::DOUBLE AS price_usd, stock_quantity,
        CASE trim(is_active) WHEN 'yes' THEN true WHEN 'No' THEN false END AS is_active
        FROM raw_products""",
    "coalesce_columns": """SELECT k::VARCHAR AS order_id, txn AS transaction_id, moment AS order_date,
        total AS total_vnd FROM raw_orders""",
    "nested_field": """SELECT k::VARCHAR AS id, customer AS customer_id, city AS shipping_city,
        street AS shipping_address FROM raw_orders""",
    "default_literal": """SELECT event_id, coalesce(source, 'direct') AS source,
        'web' AS medium FROM fact_cart_events""",
    "fill_missing": """SELECT c_custkey AS customer_id, coalesce(email, 'none') AS email,
        customer_segment FROM dim_customers JOIN customer ON c_custkey = customer_id""",
    "compute_line_total": """SELECT k, l_linenumber, product, quantity,
        coalesce(line_total, quantity * price::DOUBLE)::DECIMAL(18,2)::DOUBLE AS line_total_vnd
        FROM raw_lines""",
    # casts
    "cast_int": f"SELECT k, {_INT} AS value FROM texts",
    "cast_float": f"SELECT k, {_FLOAT} AS value FROM texts",
    "cast_numeric": f"SELECT k, {_FLOAT} AS value FROM texts",
    "cast_string": "SELECT k, k::VARCHAR AS value FROM texts",
    "cast_bool": f"SELECT k, {_BOOL_TEXT} AS value FROM texts",
    "cast_timestamp": """SELECT k, CASE WHEN k % 4 = 0 THEN moment + to_hours(k % 24)
        WHEN k % 4 = 1 THEN moment::DATE::TIMESTAMP END AS value FROM texts""",
    "cast_date": """SELECT k, CASE WHEN k % 4 < 2 THEN moment::DATE::VARCHAR END AS value
        FROM texts""",
    "cast_columns": f"""SELECT k, {_INT} AS whole, {_FLOAT} AS amount, {_BOOL_TEXT} AS flag,
        CASE WHEN k % 4 < 2 THEN moment::DATE::VARCHAR END AS day FROM texts""",
    # filters
    "filter_known_customers": "SELECT event_key, customer_id FROM fact_cart_events "
                              "WHERE customer_id IS NOT NULL",
    "drop_all_null_rows": "SELECT location_id, location_code, location_name, location_type, "
                          "city, address, phone, is_active FROM order_locations",
    # keys, nesting, duplicates
    "surrogate_key": """SELECT k::VARCHAR AS code, txn AS txn_id,
        k || '_' || coalesce(txn, '') AS surrogate_key FROM raw_orders""",
    "date_key": "SELECT k::VARCHAR AS code, moment::DATE::VARCHAR AS date_key FROM raw_orders",
    "check_duplicates": """SELECT l_orderkey, l_partkey, l_linenumber, l_suppkey, l_quantity,
        l_extendedprice FROM lineitem QUALIFY row_number() OVER (
            PARTITION BY l_orderkey, l_partkey
            ORDER BY l_linenumber, l_suppkey, l_extendedprice, l_quantity) = 1""",
    "flag_duplicates": """SELECT l_orderkey, l_partkey, l_linenumber, l_suppkey, l_quantity,
        l_extendedprice, row_number() OVER (
            PARTITION BY l_orderkey, l_partkey
            ORDER BY l_linenumber, l_suppkey, l_extendedprice, l_quantity) > 1 AS is_duplicate
        FROM lineitem""",
    "duplicate_count": """SELECT count(*) - count(DISTINCT (l_orderkey, l_partkey))
        AS duplicate_count FROM lineitem""",
    "drop_duplicates": """SELECT o_custkey, o_orderkey, o_orderstatus FROM orders
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) = 1""",
    "explode_items": """SELECT k || '_' || coalesce(txn, '') AS parent_order_key,
        k::VARCHAR AS parent_order_id, product AS variant_id, quantity AS qty,
        price::DOUBLE AS price_vnd, line_total FROM raw_lines""",
    "derive_payment_status": "SELECT payment_key, payment_status FROM fact_payments",
    # set operations
    "combine_frames": """SELECT id, origin FROM (
        SELECT c_custkey AS id, 'customer' AS origin, 0 AS rank FROM customer
        UNION ALL SELECT DISTINCT o_custkey, 'order', 1 FROM orders)
        QUALIFY row_number() OVER (PARTITION BY id ORDER BY rank) = 1""",
    "combine_orders": ORDERS,
    "combine_order_items": ITEMS,
    "combine_payments": PAYMENTS,
    "combine_locations": """SELECT location_id::VARCHAR AS location_id, location_name, city
        FROM sapo_locations UNION ALL
        SELECT location_id, location_name, city FROM order_locations""",
    "union_distinct_dates": "SELECT activity_date::VARCHAR AS activity_date FROM all_days",
    # dimensions
    "dim_customers": CUSTOMERS,
    "dim_products": _table("dim_products", ("price_vnd", "price_usd")),
    "dim_locations": _table("dim_locations"),
    "dim_staff": _table("dim_staff"),
    "dim_date": _table("dim_date", (), ("full_date",)),
    "date_bounds_from_facts": "SELECT min(lo) AS min_date, max(hi) AS max_date FROM fact_ranges",
    "date_bounds_from_tables": """SELECT min(lo)::DATE::VARCHAR AS min_date,
        max(hi)::DATE::VARCHAR AS max_date FROM fact_ranges""",
    "locations_from_orders": "SELECT * EXCLUDE (k) FROM order_locations",
    # facts
    "fact_orders": ORDERS,
    "fact_order_items": ITEMS,
    "fact_payments": PAYMENTS,
    "fact_bank_transactions": BANK,
    "fact_cart_events": EVENTS,
    "build_facts": _profiles(*_FACTS),
    "build_dimensions": _profiles(*_DIMENSIONS),
    # quality
    "null_counts": """SELECT * FROM (
        SELECT 'transaction_id' AS column_name, count_if(transaction_id IS NULL) AS null_count
        FROM fact_orders UNION ALL
        SELECT 'order_key', count_if(order_key IS NULL) FROM fact_orders) WHERE null_count > 0""",
    "date_range_profile": f"""SELECT 'payment_date' AS column_name,
        min(payment_date) AS min_date, max(payment_date) AS max_date,
        count_if(payment_date > TIMESTAMP '{NOW}') AS future_dates,
        count_if(payment_date < TIMESTAMP '2024-06-01') AS below_min_date,
        count_if(payment_date > TIMESTAMP '{NOW}') AS above_max_date FROM fact_payments""",
    "amount_profile": " UNION ALL ".join((_amounts("fact_orders", "total_vnd"),
                                          _amounts("fact_orders", "total_usd"))),
    "amount_profile_items": " UNION ALL ".join((_amounts("fact_order_items", "unit_price_vnd"),
                                                _amounts("fact_order_items", "line_total_vnd"))),
    "amount_profile_doubles": " UNION ALL ".join(
        f"""SELECT column_name, negative_count, outlier_count, round(mean / {unit}, 4) AS mean,
        round(median / {unit}, 4) AS median, round(std_dev / {unit}, 4) AS std_dev,
        min / {unit} AS min, max / {unit} AS max FROM ({_amounts(f"(SELECT {value} AS {name} "
        "FROM lineitem)", name)})""" for name, value, unit in (
            ("thousandths", "l_extendedprice / 1000::DOUBLE - 20", "1"),
            ("huge", "l_extendedprice * 1e13::DOUBLE", "1e13::DOUBLE"))),
    "quality_report": QUALITY_REPORT,
    # aggregates, windows, joins
    "purchase_summary": _table("purchases", ("total_revenue_vnd",)),
    "daily_order_revenue": _table("revenue_days", ("sales_revenue_vnd",), ("activity_date",)),
    "daily_payments": _table("payment_days", ("payment_received_vnd",), ("activity_date",)),
    "daily_bank_flows": _table("bank_days", ("bank_inflow_vnd", "bank_outflow_vnd"),
                               ("activity_date",)),
    "touchpoint_sequence": _table("sequences"),
    "touchpoint_sequence_chunks": """SELECT customer_id, (n - 1) // 25 AS chunk, count(*) AS touches,
        string_agg(token, ' > ' ORDER BY n) AS text, min(event_timestamp) AS first_touch_time,
        max(event_timestamp) AS last_touch_time
        FROM (SELECT *, row_number() OVER (PARTITION BY customer_id
            ORDER BY event_timestamp NULLS FIRST, token) AS n FROM (SELECT *,
            coalesce(source, 'unknown') || ':' || coalesce(event_type, 'unknown') AS token
            FROM fact_cart_events WHERE customer_id IS NOT NULL)) GROUP BY ALL""",
    "ordered_touchpoints": _table("ordered"),
    "ordered_touchpoints_heavy": _table("ordered"),
    "touchpoint_sequence_heavy": _table("sequences"),
    "customer_edges": _table("edges"),
    "stage_totals": _table("node_totals"),
    "total_touch_customers": "SELECT count(DISTINCT customer_id) AS total_customers FROM ordered",
    "join_order_payment": """SELECT o.order_key, o.transaction_id, p.payment_key,
        p.amount_vnd::DOUBLE AS payment_amount_vnd
        FROM fact_orders o LEFT JOIN fact_payments p ON o.transaction_id = p.transaction_id""",
    "customer_aggregates": MERGED,
    "heavy_keys": """SELECT user_id FROM events GROUP BY user_id
        HAVING count(*) > 60""",
    # views
    "vw_customer_journey": JOURNEY,
    "vw_customer_journey_sankey": SANKEY,
    "vw_customer_journey_sankey_heavy": SANKEY,
    "vw_cashflow_daily": CASHFLOW,
    "vw_payment_status": PAYMENT_STATUS,
    # sources
    "list_feed": "SELECT true AS has_files, true AS only_json_gz",
    "read_json_gz": """SELECT count(*) AS row_count, sum(4 + (email IS NOT NULL)::INT
        + (customer_segment <> 'unknown')::INT)::BIGINT AS value_count FROM dim_customers""",
    "unwrap_envelope": """SELECT customer_id::VARCHAR AS id, email, full_name AS name, country,
        nullif(customer_segment, 'unknown') AS customer_segment FROM dim_customers""",
    "scan_customers": CUSTOMERS,
    "scan_products": _table("dim_products", ("price_vnd", "price_usd")),
    "scan_shopify_orders": f"SELECT * FROM ({ORDERS}) WHERE channel = 'shopify'",
    "scan_sapo_orders": f"SELECT * FROM ({ORDERS}) WHERE channel = 'sapo_pos'",
    "scan_online_orders": f"SELECT * FROM ({ORDERS}) WHERE channel = 'online'",
    "scan_order_lines": f"""SELECT i.* FROM ({ITEMS}) i JOIN fact_orders o USING (order_key)
        WHERE channel = 'shopify'""",
    "scan_other_fields": """SELECT k::VARCHAR AS id, 'note ' || k AS gift_note FROM raw_orders
        WHERE k % 3 = 0""",
    "scan_sapo_locations": "SELECT * FROM sapo_locations",
    "scan_shopify_staff": _table("dim_staff"),
    "scan_cart_events": EVENTS,
    "scan_bank_transactions": BANK,
    **{
        f"scan_payments_{g}": f"SELECT * FROM ({PAYMENTS}) WHERE payment_gateway = '{g}'"
        for g in _GATEWAYS
    },
    "scan_all_payments": PAYMENTS,
    "scan_sources": """SELECT 'customers' AS feed, count(*) AS row_count, 6 AS column_count
                       FROM dim_customers
        UNION ALL SELECT 'products', count(*), 8 FROM raw_products
        UNION ALL SELECT 'sapo_locations', count(*), 4 + max(location_type = 'warehouse')::INT
                         + max(NOT is_active)::INT FROM sapo_locations
        UNION ALL SELECT ['shopify_orders', 'sapo_orders', 'online_orders'][k % 3 + 1], count(*),
                         [11, 8, 15][any_value(k % 3) + 1]
                  FROM (SELECT k FROM raw_orders UNION ALL SELECT k FROM raw_lines) GROUP BY 1
        UNION ALL SELECT 'cart_events', count(*), 10 FROM fact_cart_events
        UNION ALL SELECT 'bank_transactions', count(*), 6 FROM fact_bank_transactions
        UNION ALL SELECT 'payments.' || gateway, count(*),
                         CASE gateway WHEN 'momo' THEN 8 WHEN 'odoo' THEN 8 WHEN 'paypal' THEN 6
                              ELSE 7 END FROM raw_payments GROUP BY gateway""",
    "scan_with_bad_files": """SELECT 'customer_bad' AS file, true AS skipped,
        count(*) AS row_count FROM dim_customers""",
    # sinks and whole runs
    "write_table": """SELECT event_type, event_date_key::VARCHAR AS event_date_key,
        2 * count(*) AS row_count FROM fact_cart_events GROUP BY ALL""",
    "run_sql": "SELECT o_orderstatus, count(*) AS row_count FROM orders "
               "WHERE o_totalprice > 1000 GROUP BY o_orderstatus",
    "update_customer_aggregates": MERGED,
    "matched_customers": """SELECT count(*) AS affected_rows FROM dim_customers
        WHERE customer_id IN (SELECT customer_id FROM purchases)""",
    "create_views": f"""SELECT 'vw_customer_journey' AS name, count(*) AS row_count
        FROM ({JOURNEY}) UNION ALL
        SELECT 'vw_customer_journey_sankey', (SELECT count(*) FROM ({SANKEY})) UNION ALL
        SELECT 'vw_cashflow_daily', count(*) FROM ({CASHFLOW}) UNION ALL
        SELECT 'vw_payment_status', count(*) FROM ({PAYMENT_STATUS})""",
    "sql_customer_journey": JOURNEY,
    "sql_customer_journey_sankey": SANKEY,
    "sql_cashflow_daily": CASHFLOW,
    "sql_payment_status": PAYMENT_STATUS,
    "load_warehouse": f"""{_profiles(*_FACTS, *_DIMENSIONS, dim_customers="merged_customers")}
        UNION ALL SELECT 'analysis_views', 4, '', 0, 0
        UNION ALL SELECT 'dim_customers_aggregate_updates', count(*), '', 0, 0
            FROM dim_customers WHERE customer_id IN (SELECT customer_id FROM purchases)""",
    "load_by_day": " UNION ALL ".join(
        f"""SELECT '{t}' AS name, '{TABLES[t].day}' AS partitions, {TABLES[t].day}::VARCHAR AS day,
        count(*) AS row_count FROM {t} GROUP BY {TABLES[t].day}"""
        for t in ("fact_orders", "fact_cart_events", "fact_bank_transactions")),
}


def oracle_sql() -> dict[str, str]:
    return {name: with_tables(query) for name, query in SQL.items()}
