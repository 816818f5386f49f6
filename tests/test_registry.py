"""Registered queries against their SQL on the smallest tables."""

from pathlib import Path

import pytest

from checks import oracle, registry
from checks.compare import compare, connect

FOLDER = "/root/testdata/sf0.001"
QUICK = ("vw_customer_journey", "vw_customer_journey_sankey_heavy", "vw_cashflow_daily",
         "vw_payment_status", "combine_orders", "combine_order_items", "combine_payments",
         "amount_profile", "dim_date", "customer_aggregates", "scan_customers", "flag_duplicates")

needs_tables = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables here")


def test_every_query_has_sql():
    assert set(registry.queries()) == set(oracle.oracle_sql())


@needs_tables
@pytest.mark.parametrize("name", QUICK)
def test_query_equals_sql(spark, name):
    assert compare(spark, connect(FOLDER), FOLDER, name) == ""


@needs_tables
def test_scans_are_pruned(spark):
    data = registry.Data(spark, FOLDER)
    plan = registry._QUERIES["total_touch_customers"](data)._jdf.queryExecution().toString()
    assert "ReadSchema: struct<event_id:bigint" in plan and "event_type:string" not in plan.split(
        "ReadSchema:")[-1].split("\n")[0]
