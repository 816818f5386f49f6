"""Data-quality profiles in long form: (table_name, column_name, metric, value).

All counts and quartiles are exact (see ``quantiles``). A table's report is one aggregate
over its rows, besides the passes that find quartiles.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlake.functions.names import FEED_COPIES, FEED_POSITION
from bazaarlake.operators.dedupe import check_duplicates
from bazaarlake.operators.quantiles import exact_quantiles, number
from bazaarlake.session import write_and_read

_REPORT = ("table_name", "section", "column_name", "metric", "value")


@dataclass(frozen=True)
class Rules:
    """What to check on one table."""

    critical_columns: tuple[str, ...] = ()
    duplicate_subset: tuple[str, ...] = ()
    date_columns: tuple[str, ...] = ()
    amount_columns: tuple[str, ...] = ()
    allow_negative_amounts: bool = False
    min_date: str | None = None
    max_date: str | None = None
    allow_future_dates: bool = False


def quality_rules(min_date: str | None = None, max_date: str | None = None) -> dict[str, Rules]:
    """The rules per target table; the bounds are those of the run."""
    plain = {
        "dim_customers": Rules(("customer_id", "email"), ("customer_id",)),
        "dim_products": Rules(("product_id", "product_name"), ("product_id",)),
        "dim_locations": Rules(("location_id", "location_name"), ("location_id",)),
        "dim_date": Rules(("date_key",), ("date_key",)),
        "fact_orders": Rules(("order_key", "order_id"), ("order_key",), ("order_date",),
                             ("total_vnd", "total_usd")),
        "fact_order_items": Rules(("order_item_key", "order_key"), ("order_item_key",), (),
                                  ("unit_price_vnd", "line_total_vnd")),
        "fact_payments": Rules(("payment_key", "transaction_id"), ("payment_key",),
                               ("payment_date",), ("amount_vnd",)),
        "fact_cart_events": Rules(("event_key", "event_id"), ("event_key",),
                                  ("event_timestamp",)),
        "fact_bank_transactions": Rules(("transaction_key", "transaction_id"),
                                        ("transaction_key",), ("transaction_date",),
                                        ("amount_vnd",), allow_negative_amounts=True),
    }
    return {
        name: Rules(**{**vars(rule), "min_date": min_date, "max_date": max_date})
        for name, rule in plain.items()
    }


# Aggregates by metric name; a profile has such a set per column.
Metrics = dict[str, Column]


def _null_metrics(column: str) -> Metrics:
    return {"null_count": F.count_if(F.col(f"`{column}`").isNull())}


def _date_metrics(column: str, min_date: str | None, max_date: str | None,
                  allow_future_dates: bool, now: dt.datetime | str | None) -> Metrics:
    value = F.col(f"`{column}`").cast("timestamp")
    upper = F.lit(str(max_date or now)).cast("timestamp") if max_date or now else (
        F.current_timestamp())
    above = F.count_if(value > upper)
    none = F.count_if(F.lit(False))
    return {
        "min_date": F.min(value), "max_date": F.max(value),
        "future_dates": none if allow_future_dates else above,
        "below_min_date": F.count_if(
            value < F.lit(str(min_date)).cast("timestamp")) if min_date else none,
        "above_max_date": above,
    }


def _amount_metrics(column: str, quartiles: list[float] | None) -> Metrics:
    value, known = number(column), F.count(number(column))
    low, median, high = quartiles or (None, None, None)
    outside = F.lit(False)
    if quartiles:
        reach = (high - low) * 1.5
        outside = (value < low - reach) | (value > high + reach)
    return {
        "negative_count": F.count_if(value < 0),
        "outlier_count": F.count_if(outside),
        "mean": F.avg(value),
        "median": F.max(F.lit(median).cast("double")),
        "std_dev": F.when(known > 1, F.stddev_samp(value)).when(known == 1, F.lit(0.0)),
        "min": F.min(value), "max": F.max(value),
    }


def _by_column(df: DataFrame, metrics: dict[str, Metrics]) -> DataFrame:
    """One row per column, all aggregates taken in one pass."""
    wide = df.agg(*[agg.alias(f"{c}.{m}") for c, found in metrics.items()
                    for m, agg in found.items()])
    rows = [F.struct(F.lit(c).alias("column_name"),
                     *[F.col(f"`{c}.{m}`").alias(m) for m in found])
            for c, found in metrics.items()]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def _checked_columns(df: DataFrame, critical_columns: Sequence[str]) -> list[str]:
    if critical_columns:
        return [c for c in critical_columns if c in df.columns]
    return [c for c in df.columns if c not in (FEED_POSITION, FEED_COPIES)]


def null_counts(df: DataFrame, critical_columns: Sequence[str] = ()) -> DataFrame:
    """Columns that hold nulls and how many; all columns when none are named."""
    wanted = _checked_columns(df, critical_columns)
    if not wanted:
        return df.sparkSession.createDataFrame([], "column_name string, null_count bigint")
    return _by_column(df, {c: _null_metrics(c) for c in wanted}).filter(F.col("null_count") > 0)


def date_range_profile(
    df: DataFrame,
    date_columns: Sequence[str],
    min_date: str | None = None,
    max_date: str | None = None,
    allow_future_dates: bool = False,
    now: dt.datetime | str | None = None,
) -> DataFrame:
    """Per date column: smallest, largest, and counts outside the bounds.

    The upper bound is ``max_date``, or ``now``; ``future_dates`` counts what
    lies above it, also when it is in the past.
    """
    return _by_column(df, {c: _date_metrics(c, min_date, max_date, allow_future_dates, now)
                           for c in date_columns if c in df.columns})


def _quartiles(df: DataFrame, columns: Sequence[str]) -> dict[str, list[float] | None]:
    return exact_quantiles(df, columns, (0.25, 0.5, 0.75))


def amount_profile(df: DataFrame, amount_columns: Sequence[str]) -> DataFrame:
    """Per amount column: negatives, outliers beyond 1.5 quartile ranges, mean, spread.

    Amounts are compared as doubles. The quartiles are found at once, by a few jobs whose
    results are as small as the list of columns; the rest is one aggregate. These passes
    read the columns from a copy, so that what makes the rows (joins, removal of
    duplicates) runs once.
    """
    wanted = [c for c in amount_columns if c in df.columns]
    if wanted:
        df = write_and_read(df.select(*[F.col(f"`{c}`") for c in dict.fromkeys(wanted)]), "amounts")
    quartiles = _quartiles(df, wanted)
    return _by_column(df, {c: _amount_metrics(c, quartiles[c]) for c in wanted})


def _long(df: DataFrame, table: str, cells: dict[tuple[str, str | None], Metrics]) -> DataFrame:
    """All aggregates of one pass as (table_name, section, column_name, metric, value)."""
    named = {(*place, metric): agg for place, found in cells.items()
             for metric, agg in found.items()}
    wide = df.agg(*[agg.alias(f"m{i}") for i, agg in enumerate(named.values())])
    rows = [F.struct(
        F.lit(table).alias("table_name"), F.lit(section).alias("section"),
        F.lit(column).cast("string").alias("column_name"), F.lit(metric).alias("metric"),
        F.col(f"m{i}").cast("string").alias("value"))
        for i, (section, column, metric) in enumerate(named)]
    return wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*").filter(
        (F.col("section") != "nulls") | (F.col("value") != "0"))


def data_quality_check(
    df: DataFrame,
    table_name: str,
    rules: Rules = Rules(),
    remove_duplicates: bool = True,
    duplicate_flag_column: str | None = None,
    now: dt.datetime | str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(rows, report). Nulls are counted before, dates and amounts after duplicates leave.

    The report is one aggregate over the rows (one more over the input where duplicates
    leave here), besides the passes that find quartiles. Rows that carry ``FEED_COPIES`` tell
    the duplicates their builder merged; else, where none leave here, keys are counted.
    """
    keys = rules.duplicate_subset or None
    rows, counted = check_duplicates(df, keys, remove_duplicates, duplicate_flag_column)
    shown = [c for c in rows.columns if c not in (FEED_POSITION, FEED_COPIES)]
    dates = [c for c in rules.date_columns if c in shown]
    amounts = [c for c in rules.amount_columns if c in shown]
    quartiles = _quartiles(rows, amounts)
    nulls = {("nulls", c): _null_metrics(c) for c in _checked_columns(df, rules.critical_columns)}
    all_rows = F.count(F.lit(1))
    cells = {
        ("shape", None): {"row_count": all_rows,
                          "column_count": all_rows * 0 + len(shown)},
        **{("dates", c): _date_metrics(c, rules.min_date, rules.max_date,
                                       rules.allow_future_dates, now) for c in dates},
        **{("amounts", c): _amount_metrics(c, quartiles[c]) for c in amounts},
    }
    duplicates = ("duplicates", None)
    if remove_duplicates:
        before = _long(df, table_name, {**nulls, duplicates: {"duplicate_count": all_rows}})
        after = _long(rows, table_name, {**cells, duplicates: {"duplicate_count": -all_rows}})
        left = F.when(F.col("metric") == "duplicate_count", F.sum(
            F.col("value").try_cast("long")).cast("string")).otherwise(F.max("value"))
        report = before.unionByName(after).groupBy(*_REPORT[:-1]).agg(left.alias("value"))
    elif FEED_COPIES in df.columns:
        merged = F.coalesce(F.sum(F.col(FEED_COPIES) - 1), F.lit(0))
        report = _long(df, table_name, {**cells, **nulls, duplicates: {"duplicate_count": merged}})
    else:
        report = _long(df, table_name, {**cells, **nulls}).unionByName(
            _long(counted, table_name, {duplicates: {"duplicate_count": F.max("duplicate_count")}}))
    return rows.select(*shown), report


def negative_amounts(report: DataFrame) -> DataFrame:
    """Report rows with negative amounts in tables whose rules do not allow them."""
    allowed = [n for n, rule in quality_rules().items() if rule.allow_negative_amounts]
    return report.filter((F.col("metric") == "negative_count") & ~F.col("table_name").isin(
        allowed) & (F.col("value").cast("long") > 0))


@dataclass
class QualityRun:
    tables: dict[str, DataFrame] = field(default_factory=dict)
    reports: dict[str, DataFrame] = field(default_factory=dict)

    def report(self) -> DataFrame:
        return reduce(DataFrame.unionByName, self.reports.values())


def run_quality_checks(
    tables: dict[str, DataFrame],
    min_date: str | None = None,
    max_date: str | None = None,
    now: dt.datetime | str | None = None,
    remove_duplicates: bool = True,
) -> QualityRun:
    """Check each table by its rules. Nothing is rejected; only duplicates leave.

    For tables known to be unique, ``remove_duplicates=False`` saves the shuffle
    of the rows; duplicates are counted either way.
    """
    rules = quality_rules(min_date, max_date)
    run = QualityRun()
    for name, df in tables.items():
        run.tables[name], run.reports[name] = data_quality_check(
            df, name, rules.get(name, Rules()), remove_duplicates, now=now)
    return run
