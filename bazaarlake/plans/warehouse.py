"""From raw feeds to a loaded warehouse in one call."""

from __future__ import annotations

import datetime as dt
import logging
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from bazaarlake.operators.quality import negative_amounts, run_quality_checks
from bazaarlake.plans.dimensions import build_dimensions
from bazaarlake.plans.facts import build_facts
from bazaarlake.plans.views import create_views
from bazaarlake.session import remove_folder, shared_folder, write_and_read
from bazaarlake.sinks.tables import (
    ensure_schema,
    load_dimensions,
    load_facts,
    update_customer_aggregates,
    write_mode,
)
from bazaarlake.sources.feeds import feed_report, scan_sources

log = logging.getLogger(__name__)


@dataclass
class Load:
    """What a run did: rows per table, the saved quality report, and per feed its rows,
    columns and skipped files."""

    summary: dict[str, int]
    quality: DataFrame
    feeds: dict[str, dict[str, object]]


def load_warehouse(
    spark: SparkSession,
    root: str,
    schema: str,
    start_date: str | None = None,
    end_date: str | None = None,
    holidays: list[str] | None = None,
    mode: str = "WRITE_TRUNCATE",
    now: dt.datetime | str | None = None,
    day_folders: bool = True,
) -> Load:
    """Scan, build facts and dimensions, check, load, update customers, create views.

    Raw feeds are parsed once and kept as columns; facts and dimensions are written once
    and used for bounds, checks and load. All of that lies in a folder of this run,
    which is removed at its end. The quality report is made here, saved as
    ``quality_report`` beside the tables, and what it finds wrong is logged.
    """
    mode = write_mode(mode)
    folder = f"{shared_folder(spark)}/load-{uuid.uuid4().hex}"
    try:
        return _load(spark, root, schema, start_date, end_date, holidays, mode, now, folder,
                     day_folders)
    finally:
        remove_folder(spark, folder)


def _load(spark, root, schema, start_date, end_date, holidays, mode, now, folder,
          day_folders) -> Load:
    raw = scan_sources(spark, root)
    payments = raw.pop("payments_by_gateway")
    raw = {n: write_and_read(df, f"raw-{n}", folder) for n, df in raw.items()}
    payments = {g: write_and_read(df, f"raw-payments-{g}", folder) for g, df in payments.items()}
    feeds = _report_feeds(spark, root, {**raw, **{f"payments.{g}": df
                                                  for g, df in payments.items()}})
    raw["payments_by_gateway"] = payments
    facts = {n: write_and_read(df, n, folder)
             for n, df in build_facts(raw, counted=True).items()}
    dims = {
        n: write_and_read(df, n, folder)
        for n, df in build_dimensions(raw, facts, start_date, end_date, holidays, schema,
                                      counted=True).items()
    }
    # The builders removed duplicates, and rows say how many: the checks only report.
    checked = run_quality_checks(
        {**dims, **facts}, start_date, end_date, now, remove_duplicates=False
    )
    dims, facts = ({n: checked.tables[n] for n in made} for made in (dims, facts))
    summary = load_dimensions(dims, schema, mode, day_folders)
    summary |= load_facts(facts, schema, mode, day_folders)
    ready = summary["dim_customers"] and summary["fact_orders"]
    if not ready:
        log.warning("no customers or no orders: customer aggregates not updated")
    summary["dim_customers_aggregate_updates"] = (
        update_customer_aggregates(spark, schema) if ready else 0
    )
    summary["analysis_views"] = create_views(spark, schema)
    saved = f"{schema}.quality_report"
    ensure_schema(spark, schema)
    checked.report().coalesce(1).write.mode("overwrite").saveAsTable(saved)
    quality = spark.table(saved)
    for row in negative_amounts(quality).collect():  # one row per amount column at most
        log.warning("%s.%s: %s negative amounts", row.table_name, row.column_name, row.value)
    return Load(summary, quality, feeds)


def _report_feeds(spark: SparkSession, root: str, frames: dict[str, DataFrame]):
    """Log and return what each feed gave; feeds without a row are there with zeros."""
    found = {name: {"rows": 0, "columns": 0, "skipped": []} for name in frames}
    for row in feed_report(spark, root, frames).collect():  # one row per feed
        found[row.feed] = {"rows": row.row_count, "columns": row.column_count,
                           "skipped": row.skipped}
    for name, seen in found.items():
        log.info("feed %s: %s rows, %s columns", name, seen["rows"], seen["columns"])
        for path in seen["skipped"]:
            log.warning("feed %s: nothing read from %s", name, path)
    return found
