"""Headline queries on ``local[$BENCH_CPUS]``; prints one JSON line.

Facts are built from the raw feeds and written once (timed as ``build_*``), as a
load would; the analysis queries then read the written tables. Each query runs
once to warm up and once for the clock, to Spark's no-op sink.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from bazaarlake.operators import quality, touchpoints, upsert
from bazaarlake.plans import finance, journey
from bazaarlake.session import build_session
from checks.registry import Data

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def main() -> None:
    spark = build_session("bench", **{
        "spark.master": f"local[{CPUS}]", "spark.sql.shuffle.partitions": CPUS,
        "spark.driver.memory": "16g", "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}

    def clock(name, make, sink) -> None:
        sink(make())
        start = time.perf_counter()
        sink(make())
        times[name] = round(time.perf_counter() - start, 3)

    def discard(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    folder = tempfile.mkdtemp(prefix="bench-")
    data = Data(spark, FOLDER)
    for name in ("orders", "items", "payments", "events", "bank", "customers"):
        path = f"{folder}/{name}"
        clock(f"build_{name}", lambda n=name: getattr(data, n),
              lambda df, p=path: df.write.mode("overwrite").parquet(p))
    orders, items, payments, events, bank, customers = (
        spark.read.parquet(f"{folder}/{n}")
        for n in ("orders", "items", "payments", "events", "bank", "customers"))
    for name, make in {
        "vw_customer_journey": lambda: journey.customer_journey(events, orders),
        "vw_customer_journey_sankey": lambda: journey.customer_journey_sankey(events, orders),
        "vw_cashflow_daily": lambda: finance.cashflow_daily(orders, payments, bank),
        "vw_payment_status": lambda: finance.payment_status(orders, payments, "2026-06-01"),
        "ordered_touchpoints": lambda: touchpoints.ordered_touchpoints(events),
        "ordered_touchpoints_heavy": lambda: touchpoints.ordered_touchpoints(events, 1),
        "customer_aggregates": lambda: upsert.customer_aggregates(customers, orders),
        "amount_profile": lambda: quality.amount_profile(
            items, ["unit_price_vnd", "line_total_vnd"]),
    }.items():
        clock(name, make, discard)
    scale = os.path.basename(FOLDER.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "headline queries, total", "value": round(sum(times.values()), 3),
        "unit": "sec", "queries": times, "sf": scale}))


if __name__ == "__main__":
    main()
