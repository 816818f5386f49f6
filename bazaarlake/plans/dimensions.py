"""Raw feeds to dimension tables, and the calendar."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlake import fixed_values as fixed
from bazaarlake.functions.columns import conform
from bazaarlake.functions.names import FEED_POSITION, standardize_names
from bazaarlake.operators.dedupe import (
    combine_frames,
    keep_first,
    keep_first_counted,
    with_position,
)
from bazaarlake.plans.facts import Field
from bazaarlake.schemas import FACT_DATES, TABLES

_CUSTOMER_FIELDS = (
    Field("customer_id", "int", ("customer_id", "id")),
    Field("email", "string", ("email",)),
    Field("full_name", "string", ("full_name", "name")),
    Field("phone", "string", ("phone",)),
    Field("city", "string", ("city",)),
    Field("country", "string", ("country",)),
    Field("created_at", "datetime", ("created_at",)),
    Field("customer_segment", "string", ("customer_segment",), default=fixed.UNKNOWN),
    Field("lifetime_value_vnd", "numeric", ("lifetime_value_vnd",), default=0),
    Field("total_orders", "int", ("total_orders",), default=0),
    Field("first_order_date", "datetime", ("first_order_date",)),
    Field("last_order_date", "datetime", ("last_order_date",)),
)
_PRODUCT_FIELDS = (
    Field("product_id", "int", ("product_id", "id")),
    Field("product_name", "string", ("product_name", "name")),
    Field("sku", "string", ("sku",)),
    Field("barcode", "string", ("barcode",)),
    Field("category", "string", ("category",)),
    Field("brand", "string", ("brand",)),
    Field("price_vnd", "numeric", ("price_vnd",), default=0),
    Field("price_usd", "numeric", ("price_usd",), default=0),
    Field("stock_quantity", "int", ("stock_quantity",), default=0),
    Field("is_active", "bool", ("is_active",), default=True),
)
_LOCATION_FIELDS = (
    Field("location_id", "int", fixed.LOCATION_ID),
    Field("location_code", "string", fixed.LOCATION_CODE),
    Field("location_name", "string", fixed.LOCATION_NAME),
    Field("location_type", "string", fixed.LOCATION_TYPE, default="store"),
    Field("city", "string", ("city",)),
    Field("address", "string", ("address",)),
    Field("phone", "string", ("phone",)),
    Field("is_active", "bool", fixed.IS_ACTIVE, default=True),
)
_STAFF_FIELDS = (
    Field("staff_id", "int", fixed.STAFF_ID),
    Field("staff_code", "string", fixed.STAFF_CODE),
    Field("full_name", "string", fixed.STAFF_NAME),
    Field("position", "string", fixed.STAFF_POSITION, default=fixed.UNKNOWN),
    Field("email", "string", ("email",)),
    Field("phone", "string", ("phone",)),
    Field("location_id", "int", fixed.STAFF_LOCATION, fixed.STAFF_LOCATION_NESTED),
    Field("hire_date", "datetime", fixed.STAFF_HIRED),
    Field("is_active", "bool", fixed.IS_ACTIVE, default=True),
)


def _dimension(raw: DataFrame, table: str, fields: tuple[Field, ...], counted: bool) -> DataFrame:
    spec = TABLES[table]
    df = with_position(standardize_names(raw))
    rows = df.selectExpr(*[f.read(df) for f in fields], FEED_POSITION)
    keep = keep_first_counted if counted else keep_first
    return keep(conform(rows, spec.schema, keep=[FEED_POSITION]), [spec.key])


def dim_customers(raw: DataFrame, counted: bool = False) -> DataFrame:
    return _dimension(raw, "dim_customers", _CUSTOMER_FIELDS, counted)


def dim_products(raw: DataFrame, counted: bool = False) -> DataFrame:
    return _dimension(raw, "dim_products", _PRODUCT_FIELDS, counted)


def dim_locations(raw: DataFrame, counted: bool = False) -> DataFrame:
    return _dimension(raw, "dim_locations", _LOCATION_FIELDS, counted)


def dim_staff(raw: DataFrame, counted: bool = False) -> DataFrame:
    return _dimension(raw, "dim_staff", _STAFF_FIELDS, counted)


def locations_from_orders(raw: DataFrame) -> DataFrame:
    """Stores named in online orders; rows that say nothing about a store are dropped."""
    df = standardize_names(raw)
    said = {
        "location_id": "location_id", "location_code": "location_code",
        "location_name": "location_name", "city": "location_city",
        "address": "location_address", "phone": "location_phone",
    }
    if not any(c in df.columns for c in said.values()):
        return conform(df, TABLES["dim_locations"].schema).limit(0)
    rows = df.select(
        *[
            (F.col(c) if c in df.columns else F.lit(None)).cast("string").alias(name)
            for name, c in said.items()
        ],
        F.lit("store").alias("location_type"),
        F.lit(True).alias("is_active"),
        *([FEED_POSITION] if FEED_POSITION in df.columns else []),
    ).na.drop(how="all", subset=list(said))
    order = [f.name for f in TABLES["dim_locations"].schema]
    return rows.select(*order, *([FEED_POSITION] if FEED_POSITION in rows.columns else []))


def all_locations(sapo_locations: DataFrame, online_orders: DataFrame) -> DataFrame:
    """Locations feed first, then stores found in orders; names only, no casts yet."""
    listed = standardize_names(sapo_locations)
    found = locations_from_orders(online_orders)
    texts = [
        frame.select(*[
            c if c == FEED_POSITION else F.col(c).cast("string").alias(c) for c in frame.columns
        ])
        for frame in (listed, found)
    ]
    return combine_frames(texts)


def date_bounds_from_facts(facts: dict[str, DataFrame]) -> DataFrame:
    """One row ``min_date, max_date`` (timestamps) over the dated facts given."""
    ranges = [
        facts[table].agg(F.min(column).alias("min_date"), F.max(column).alias("max_date"))
        for table, column in FACT_DATES.items()
        if table in facts and column in facts[table].columns
    ]
    if not ranges:
        raise ValueError("no fact table with a date column given")
    return overall_date_range(ranges)


def overall_date_range(ranges: list[DataFrame]) -> DataFrame:
    """Smallest minimum and largest maximum over per-table ranges that are not null."""
    union = ranges[0]
    for other in ranges[1:]:
        union = union.union(other)
    known = union.filter(F.col("min_date").isNotNull() & F.col("max_date").isNotNull())
    return known.agg(F.min("min_date").alias("min_date"), F.max("max_date").alias("max_date"))


def date_bounds_from_tables(spark: SparkSession, schema: str) -> DataFrame | None:
    """The same in whole days over the saved facts; None when none is saved.

    A fact in day folders tells its days by its list of partitions, without reading rows.
    """
    ranges = [
        _saved_days(spark, f"{schema}.{table}", TABLES[table].day, column).agg(
            F.min("day").alias("min_date"), F.max("day").alias("max_date"))
        for table, column in FACT_DATES.items()
        if spark.catalog.tableExists(f"{schema}.{table}")
    ]
    return overall_date_range(ranges) if ranges else None


def _saved_days(spark: SparkSession, target: str, day: str, column: str) -> DataFrame:
    folders = [c.name for c in spark.catalog.listColumns(target) if c.isPartition]
    if folders != [day]:
        return spark.table(target).select(F.to_date(column).alias("day"))
    listed = spark.sql(f"SHOW PARTITIONS {target}").toDF("partition")
    return listed.select(F.substring_index("partition", "=", -1).try_cast("date").alias("day"))


def _day(value: object) -> dt.date:
    if isinstance(value, dt.datetime):
        return value.date()
    return value if isinstance(value, dt.date) else dt.datetime.fromisoformat(str(value)).date()


def calendar_bounds(
    spark: SparkSession,
    facts: dict[str, DataFrame],
    start: object = None,
    end: object = None,
    schema: str | None = None,
    today: dt.date | None = None,
) -> tuple[dt.date, dt.date]:
    """First and last day of the calendar; one row reaches the driver.

    Order of precedence: explicit bounds, the given facts, saved facts, the
    current year.
    """
    low = high = None
    if start is None or end is None:
        days = [F.to_date("min_date").alias("low"), F.to_date("max_date").alias("high")]
        low, high = date_bounds_from_facts(facts).select(*days).first()
        if low is None and schema is not None:
            saved = date_bounds_from_tables(spark, schema)
            if saved is not None:
                low, high = saved.select(*days).first()
        if low is None:
            year = (today or dt.date.today()).year
            low, high = dt.date(year, 1, 1), dt.date(year, 12, 31)
    low = low if start is None else _day(start)
    high = high if end is None else _day(end)
    if low > high:
        raise ValueError("start date must not be after end date")
    return low, high


def calendar(bounds: DataFrame, holidays: list[object] | None = None) -> DataFrame:
    """One row per day between ``min_date`` and ``max_date``, both included."""
    day = F.col("full_date")
    weekday = F.weekday(day) + 1
    free_days = [_day(h) for h in (holidays or [])]
    days = bounds.select(
        F.explode(F.sequence(F.to_date("min_date"), F.to_date("max_date"))).alias("full_date")
    )
    rows = days.select(
        F.date_format(day, "yyyyMMdd").cast("int").alias("date_key"),
        day,
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.weekofyear(day).alias("week"),
        F.dayofmonth(day).alias("day_of_month"),
        weekday.alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        (weekday >= 6).alias("is_weekend"),
        (day.isin(*free_days) if free_days else F.lit(False)).alias("is_holiday"),
        F.year(day).alias("fiscal_year"),
        F.quarter(day).alias("fiscal_quarter"),
    )
    return conform(rows, TABLES["dim_date"].schema)


def dim_date(
    spark: SparkSession, start: object, end: object, holidays: list[object] | None = None
) -> DataFrame:
    low, high = _day(start), _day(end)
    bounds = spark.range(1).select(F.lit(low).alias("min_date"), F.lit(high).alias("max_date"))
    return calendar(bounds, holidays)


def parse_holidays(text: str | None) -> list[str]:
    return [part.strip() for part in (text or "").split(",") if part.strip()]


def build_dimensions(
    raw: dict[str, object],
    facts: dict[str, DataFrame],
    start: object = None,
    end: object = None,
    holidays: list[object] | None = None,
    schema: str | None = None,
    counted: bool = False,
) -> dict[str, DataFrame]:
    """The four dimensions; the calendar needs the facts for its range.

    ``counted`` adds ``FEED_COPIES`` to those that remove duplicates.
    """
    spark = raw["customers"].sparkSession
    low, high = calendar_bounds(spark, facts, start, end, schema)
    places = all_locations(raw["sapo_locations"], raw["online_orders"])
    return {
        "dim_customers": dim_customers(raw["customers"], counted).drop(FEED_POSITION),
        "dim_products": dim_products(raw["products"], counted).drop(FEED_POSITION),
        "dim_locations": dim_locations(places, counted).drop(FEED_POSITION),
        "dim_date": dim_date(spark, low, high, holidays),
    }
