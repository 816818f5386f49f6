"""One registered query per operator, each over the whole tables of a folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bazaarlake.fixed_values import ORDER_CHANNELS, ORDER_DATE, ORDER_ID
from bazaarlake.fixed_values import ORDER_TOTAL_VND, ORDER_TRANSACTION, PAYMENT_GATEWAYS
from bazaarlake.functions.casts import cast_columns
from bazaarlake.functions.columns import (
    coalesce_columns,
    conform,
    default_literal,
    ensure_columns,
    fill_missing,
    line_total_sql,
    nested_field,
)
from bazaarlake.functions.keys import date_key, surrogate_key
from bazaarlake.functions.names import FEED_POSITION, rename_columns, standardize_names
from bazaarlake.operators import dedupe, quality, skew, touchpoints, upsert
from bazaarlake.operators.explode import explode_items
from bazaarlake.plans import dimensions, facts, finance, journey, views
from bazaarlake.plans.warehouse import load_warehouse
from bazaarlake.schemas import TABLES
from bazaarlake.session import shared_folder, write_and_read
from bazaarlake.sinks import tables
from bazaarlake.sources import feeds as sources
from checks.oracle import AS_OF, NOW
from checks.sample_feeds import SampleFeeds, write_all_feeds, write_feed

HOLIDAYS = ["2024-01-01", "2024-12-25"]
HEAVY_ROWS = 60  # makes a good part of the customers of small tables heavy


def shown(df: DataFrame) -> DataFrame:
    """Engine-neutral types: decimals as double, timestamps without zone, days as text."""
    def show(field: T.StructField) -> Column:
        value, dtype = F.col(f"`{field.name}`"), field.dataType
        if isinstance(dtype, T.DecimalType):
            value = value.cast("double")
        elif isinstance(dtype, T.TimestampType):
            value = value.cast("timestamp_ntz")
        elif isinstance(dtype, T.DateType):
            value = value.cast("string")
        return value.alias(field.name)

    return df.select(*[show(f) for f in df.schema if f.name != FEED_POSITION])


class Data:
    """Feeds and facts over one folder of tables, all lazy."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.feeds = spark, SampleFeeds(spark, folder)

    @property
    def orders(self) -> DataFrame:
        return facts.combine_orders(self.feeds.raw_sources()).drop(FEED_POSITION)

    @property
    def items(self) -> DataFrame:
        return facts.combine_order_items(self.feeds.order_lines()).drop(FEED_POSITION)

    @property
    def payments(self) -> DataFrame:
        return facts.combine_payments(self.feeds.all_payments()).drop(FEED_POSITION)

    @property
    def bank(self) -> DataFrame:
        return facts.fact_bank_transactions(self.feeds.bank_transactions()).drop(FEED_POSITION)

    @property
    def events(self) -> DataFrame:
        return facts.fact_cart_events(self.feeds.cart_events()).drop(FEED_POSITION)

    @property
    def customers(self) -> DataFrame:
        return dimensions.dim_customers(self.feeds.customers()).drop(FEED_POSITION)

    def dated_facts(self) -> dict[str, DataFrame]:
        return {
            "fact_orders": self.orders, "fact_payments": self.payments,
            "fact_cart_events": self.events, "fact_bank_transactions": self.bank,
        }

    def raw(self) -> dict[str, object]:
        """All sources, orders as headers followed by a header per line."""
        found = self.feeds.raw_sources()
        for feed, lines in self.feeds.order_lines().items():
            first = F.expr("struct(0 as l_linenumber, 0L as l_suppkey, 0D as l_extendedprice, "
                           "0D as l_quantity)")
            found[feed] = found[feed].withColumn(FEED_POSITION, first).unionByName(
                lines, allowMissingColumns=True)
        return found

    def new_schema(self) -> str:
        """A fresh catalog schema below the shared folder."""
        name = f"check_{uuid.uuid4().hex[:12]}"
        tables.ensure_schema(self.spark, name, f"{shared_folder(self.spark)}/{name}")
        return name

    def new_root(self) -> str:
        return f"{shared_folder(self.spark)}/feeds-{uuid.uuid4().hex[:12]}"

    def saved(self, *names: str, all_folders: bool = False) -> str:
        """A fresh schema holding the named tables.

        Orders and payments spread over some 2,400 days here; their day folders take most of
        a minute to write, so only ``load_by_day`` asks for those.
        """
        made = {**self.dated_facts(), "dim_customers": self.customers}
        schema = self.new_schema()
        for name in names:
            few = name in ("fact_cart_events", "fact_bank_transactions")
            tables.load_tables({name: made[name]}, schema, day_folders=all_folders or few)
        return schema

    def texts(self) -> DataFrame:
        """Order keys and dates as well and badly formed text."""
        k, at = F.col("o_orderkey"), F.col("o_orderdate")
        text = k.cast("string")
        number = (
            F.when(k % 5 == 0, text).when(k % 5 == 1, F.concat(text, F.lit(".0")))
            .when(k % 5 == 2, F.concat(text, F.lit(".5"))).when(k % 5 == 3, "invalid")
        )
        words = (" TRUE ", "no", "1", "0", "Yes", "maybe", None, "False")
        flag = F.element_at(F.array(*[F.lit(w) for w in words]), (k % 8 + 1).cast("int"))
        later = at + F.make_interval(hours=(k % 24).cast("int"))
        stamp = (
            F.when(k % 4 == 0, F.date_format(later, "yyyy-MM-dd HH:mm:ss"))
            .when(k % 4 == 1, F.date_format(at, "yyyy-MM-dd")).when(k % 4 == 2, "not a date")
        )
        day = F.when(k % 4 < 2, F.date_format(at, "yyyy-MM-dd")).otherwise(F.lit("n/a"))
        return self.feeds.table("orders").select(
            k.alias("k"), number.alias("whole"), number.alias("amount"), flag.alias("flag"),
            stamp.alias("stamp"), day.alias("day"))


Query = Callable[[Data], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(run: Query) -> Query:
    _QUERIES[run.__name__] = run
    return run


def _profile(frames: dict[str, DataFrame]) -> DataFrame:
    """Rows, and per column the values that are not null and a sum over them."""
    parts = []
    for name, df in frames.items():
        columns = [f for f in TABLES[name].schema]
        cells = [F.struct(F.lit(f.name).alias("column_name"), F.count(F.col(f.name)).alias(
            "known"), F.coalesce(F.sum(_amount(f)).cast("double"), F.lit(0.0)).alias("total"))
            for f in columns]
        parts.append(df.agg(F.count(F.lit(1)).alias("row_count"), F.array(*cells).alias(
            "cells")).select(F.lit(name).alias("name"), "row_count", F.inline("cells")))
    return reduce(DataFrame.union, parts)


def _amount(field: T.StructField) -> Column:
    value = F.col(field.name)
    if isinstance(field.dataType, T.StringType):
        return F.length(value).cast("long")
    if isinstance(field.dataType, T.DateType):
        return F.unix_date(value).cast("long")
    if isinstance(field.dataType, T.TimestampType):
        return F.unix_seconds(value)
    return value.cast("int") if isinstance(field.dataType, T.BooleanType) else value


def _count(frames: dict[str, DataFrame]) -> DataFrame:
    parts = [df.agg(F.lit(n).alias("name"), F.count(F.lit(1)).alias("row_count"))
             for n, df in frames.items()]
    return reduce(DataFrame.union, parts)


# -- projections -------------------------------------------------------------
def _products(d: Data) -> DataFrame:
    return standardize_names(d.feeds.products()).drop(FEED_POSITION)


@query
def standardize_names_(d: Data) -> DataFrame:
    return _products(d)


@query
def rename_columns_(d: Data) -> DataFrame:
    return rename_columns(_products(d), {"id": "product_id", "name": "product_name"})


@query
def ensure_columns_(d: Data) -> DataFrame:
    return ensure_columns(rename_columns_(d), TABLES["dim_products"].schema)


@query
def conform_(d: Data) -> DataFrame:
    return conform(rename_columns_(d), TABLES["dim_products"].schema)


@query
def coalesce_columns_(d: Data) -> DataFrame:
    df = standardize_names(d.feeds.orders_as(1))
    return df.select(
        coalesce_columns(df, ORDER_ID, "string").alias("order_id"),
        coalesce_columns(df, ORDER_TRANSACTION, "string").alias("transaction_id"),
        coalesce_columns(df, ORDER_DATE, "datetime").alias("order_date"),
        coalesce_columns(df, ORDER_TOTAL_VND, "numeric").alias("total_vnd"),
    )


@query
def nested_field_(d: Data) -> DataFrame:
    df = standardize_names(d.feeds.orders_as(0))
    paths = {"customer_id": ("customer", "id"), "shipping_city": ("shipping_address", "city_name"),
             "shipping_address": ("shipping_address", "address1")}
    return df.select("id", *[F.expr(nested_field(df, *path)[0]).alias(n) for n, path in paths.items()])


@query
def default_literal_(d: Data) -> DataFrame:
    df = d.events
    return df.select("event_id", default_literal(df, "source", "direct").alias("source"),
                     default_literal(df, "medium", "web").alias("medium"))


@query
def fill_missing_(d: Data) -> DataFrame:
    df = standardize_names(d.feeds.customers())
    df = fill_missing(df, {"email": "none", "customer_segment": "unknown"})
    return df.select(F.col("id").cast("long").alias("customer_id"), "email", "customer_segment")


@query
def compute_line_total(d: Data) -> DataFrame:
    lines = d.feeds.table("lineitem").selectExpr(
        "l_orderkey as k", "l_linenumber", "l_partkey as product", "l_quantity as quantity",
        "cast(floor(l_extendedprice * 100 / l_quantity) / 100 as decimal(18,2)) as price",
        "if(l_linenumber <> 1, cast(l_extendedprice as decimal(18,2)), null) as given")
    return lines.selectExpr("k", "l_linenumber", "product", "quantity",
                            f"{line_total_sql('given', 'quantity', 'price')} as line_total_vnd")


# -- casts -------------------------------------------------------------------
def _cast(name: str, column: str, type_name: str) -> None:
    def run(d: Data) -> DataFrame:
        df = d.texts().select("k", F.col(column).alias("value"))
        return cast_columns(df, {"value": type_name})

    _QUERIES[name] = run


for _name, _column, _type in (
    ("cast_int", "whole", "int"), ("cast_float", "amount", "float"),
    ("cast_numeric", "amount", "numeric"), ("cast_string", "k", "string"),
    ("cast_bool", "flag", "bool"), ("cast_timestamp", "stamp", "datetime"),
    ("cast_date", "day", "date"),
):
    _cast(_name, _column, _type)


@query
def cast_columns_(d: Data) -> DataFrame:
    df = d.texts().drop("stamp")
    return cast_columns(df, {"whole": "int", "amount": "numeric", "flag": "bool", "day": "date"})


# -- filters -----------------------------------------------------------------
@query
def filter_known_customers(d: Data) -> DataFrame:
    return d.events.filter(F.col("customer_id").isNotNull()).select("event_key", "customer_id")


@query
def drop_all_null_rows(d: Data) -> DataFrame:
    return dimensions.locations_from_orders(d.feeds.online_orders())


@query
def locations_from_orders(d: Data) -> DataFrame:
    return dimensions.locations_from_orders(d.feeds.online_orders())


# -- keys, nesting, duplicates -----------------------------------------------
@query
def surrogate_key_(d: Data) -> DataFrame:
    df = standardize_names(d.feeds.orders_as(1))
    return surrogate_key(df, ["code", "txn_id"]).select("code", "txn_id", "surrogate_key")


@query
def date_key_(d: Data) -> DataFrame:
    return date_key(d.feeds.orders_as(1), "created_on").select("code", "date_key")


def _lines(d: Data) -> DataFrame:
    columns = ("l_orderkey", "l_partkey", "l_linenumber", "l_suppkey", "l_quantity",
               "l_extendedprice")
    position = F.struct("l_linenumber", "l_suppkey", "l_extendedprice", "l_quantity")
    return d.feeds.table("lineitem").select(*columns, position.alias(FEED_POSITION))


@query
def check_duplicates(d: Data) -> DataFrame:
    return dedupe.check_duplicates(_lines(d), ["l_orderkey", "l_partkey"], True)[0]


@query
def flag_duplicates(d: Data) -> DataFrame:
    return dedupe.flag_duplicates(_lines(d), ["l_orderkey", "l_partkey"])


@query
def duplicate_count(d: Data) -> DataFrame:
    return dedupe.duplicate_count(_lines(d), ["l_orderkey", "l_partkey"])


@query
def drop_duplicates(d: Data) -> DataFrame:
    df = d.feeds.table("orders").select(
        "o_custkey", "o_orderkey", "o_orderstatus", F.struct("o_orderkey").alias(FEED_POSITION))
    return dedupe.keep_first(df, ["o_custkey"])


@query
def explode_items_(d: Data) -> DataFrame:
    df = standardize_names(d.feeds.spelled(d.feeds.lines(), 1))
    df = surrogate_key(df.withColumnRenamed("code", "order_id"), ["order_id", "txn_id"],
                       "order_key")
    return explode_items(df, "line_items", ["order_key", "order_id"])


@query
def derive_payment_status(d: Data) -> DataFrame:
    return reduce(DataFrame.unionByName, [
        facts.fact_payments(raw, gateway, unique=False).select("payment_key", "payment_status")
        for gateway, raw in d.feeds.all_payments().items()])


# -- set operations ----------------------------------------------------------
@query
def combine_frames(d: Data) -> DataFrame:
    known = d.feeds.table("customer").select(
        F.col("c_custkey").alias("id"), F.lit("customer").alias("origin"),
        F.struct(F.col("c_custkey").alias("at")).alias(FEED_POSITION))
    buyers = d.feeds.table("orders").select(
        F.col("o_custkey").alias("id"), F.lit("order").alias("origin"),
        F.struct(F.col("o_orderkey").alias("at")).alias(FEED_POSITION))
    return dedupe.combine_frames([known, buyers], dedupe_on=["id"])


@query
def combine_orders(d: Data) -> DataFrame:
    return d.orders


@query
def combine_order_items(d: Data) -> DataFrame:
    return d.items


@query
def combine_payments(d: Data) -> DataFrame:
    return d.payments


@query
def combine_locations(d: Data) -> DataFrame:
    df = dimensions.all_locations(d.feeds.sapo_locations(), d.feeds.online_orders())
    return df.select(
        coalesce_columns(df, ("location_id", "id"), "string").alias("location_id"),
        coalesce_columns(df, ("location_name", "name"), "string").alias("location_name"), "city")


@query
def union_distinct_dates(d: Data) -> DataFrame:
    return finance.union_distinct_dates(d.orders, d.payments, d.bank)


# -- dimensions --------------------------------------------------------------
@query
def dim_customers(d: Data) -> DataFrame:
    return d.customers


@query
def dim_products(d: Data) -> DataFrame:
    return dimensions.dim_products(d.feeds.products())


@query
def dim_locations(d: Data) -> DataFrame:
    places = dimensions.all_locations(d.feeds.sapo_locations(), d.feeds.online_orders())
    return dimensions.dim_locations(places)


@query
def dim_staff(d: Data) -> DataFrame:
    return dimensions.dim_staff(d.feeds.staff())


@query
def dim_date(d: Data) -> DataFrame:
    return dimensions.calendar(dimensions.date_bounds_from_facts(d.dated_facts()), HOLIDAYS)


@query
def date_bounds_from_facts(d: Data) -> DataFrame:
    return dimensions.date_bounds_from_facts(d.dated_facts())


@query
def date_bounds_from_tables(d: Data) -> DataFrame:
    return dimensions.date_bounds_from_tables(d.spark, d.saved(*d.dated_facts()))


@query
def build_dimensions(d: Data) -> DataFrame:
    return _profile(dimensions.build_dimensions(d.feeds.raw_sources(), d.dated_facts(),
                                                holidays=HOLIDAYS))


# -- facts -------------------------------------------------------------------
@query
def fact_orders(d: Data) -> DataFrame:
    raw = d.feeds.raw_sources()
    return reduce(DataFrame.unionByName, [
        facts.fact_orders(raw[feed], channel, source).drop(FEED_POSITION)
        for feed, (channel, source) in ORDER_CHANNELS.items()])


@query
def fact_order_items(d: Data) -> DataFrame:
    return reduce(DataFrame.unionByName, [
        facts.fact_order_items(raw).drop(FEED_POSITION) for raw in d.feeds.order_lines().values()])


@query
def fact_payments(d: Data) -> DataFrame:
    return reduce(DataFrame.unionByName, [
        facts.fact_payments(raw, gateway).drop(FEED_POSITION)
        for gateway, raw in d.feeds.all_payments().items()])


@query
def fact_bank_transactions(d: Data) -> DataFrame:
    return d.bank


@query
def fact_cart_events(d: Data) -> DataFrame:
    return d.events


@query
def build_facts(d: Data) -> DataFrame:
    return _profile(facts.build_facts(d.raw()))


# -- quality -----------------------------------------------------------------
@query
def null_counts(d: Data) -> DataFrame:
    return quality.null_counts(d.orders, ["transaction_id", "order_key"])


@query
def date_range_profile(d: Data) -> DataFrame:
    return quality.date_range_profile(d.payments, ["payment_date"], min_date="2024-06-01", now=NOW)


def _rounded(profile: DataFrame) -> DataFrame:
    return profile.withColumns(
        {c: F.round(c, 4) for c in ("mean", "median", "std_dev")})


@query
def amount_profile(d: Data) -> DataFrame:
    return _rounded(quality.amount_profile(d.orders, ["total_vnd", "total_usd"]))


@query
def amount_profile_items(d: Data) -> DataFrame:
    return _rounded(quality.amount_profile(d.items, ["unit_price_vnd", "line_total_vnd"]))


@query
def amount_profile_doubles(d: Data) -> DataFrame:
    """Thousandths with negatives, and values beyond 10**17, shown in units of 10**13."""
    amounts = d.feeds.table("lineitem").selectExpr(
        "l_extendedprice / 1000D - 20 AS thousandths", "l_extendedprice * 1e13D AS huge")
    unit = F.when(F.col("column_name") == "huge", 1e13).otherwise(1.0)
    profile = quality.amount_profile(amounts, ["thousandths", "huge"])
    return _rounded(profile.withColumns(
        {c: F.col(c) / unit for c in ("mean", "median", "std_dev", "min", "max")}))


@query
def quality_report(d: Data) -> DataFrame:
    """All nine tables as their builders leave them, with the duplicates they merged."""
    raw = d.raw()
    folder = d.new_root()

    def written(frames: dict[str, DataFrame]) -> dict[str, DataFrame]:
        return {n: write_and_read(df, n, folder) for n, df in frames.items()}

    # As in a load: the calendar's bounds come from written facts.
    made = written(facts.build_facts(raw, counted=True))
    made |= written(dimensions.build_dimensions(raw, made, holidays=HOLIDAYS, counted=True))
    report = quality.run_quality_checks(made, now=NOW, remove_duplicates=False).report()
    measured = F.col("metric").isin("mean", "median", "std_dev")
    number = F.col("value").try_cast("double")
    dated = F.col("metric").isin("min_date", "max_date")
    return report.select(
        "table_name", "section", "column_name", "metric",
        F.when(~dated, F.when(measured, F.round(number, 4)).otherwise(number)).alias("number"),
        F.when(dated, F.col("value").substr(1, 19)).alias("text"))


# -- aggregates, windows, joins ----------------------------------------------
@query
def purchase_summary(d: Data) -> DataFrame:
    return journey.purchase_summary(d.orders)


@query
def daily_order_revenue(d: Data) -> DataFrame:
    return finance.daily_order_revenue(d.orders)


@query
def daily_payments(d: Data) -> DataFrame:
    return finance.daily_payments(d.payments)


@query
def daily_bank_flows(d: Data) -> DataFrame:
    return finance.daily_bank_flows(d.bank)


@query
def touchpoint_sequence(d: Data) -> DataFrame:
    return touchpoints.touchpoint_sequence(d.events)


@query
def touchpoint_sequence_heavy(d: Data) -> DataFrame:
    return touchpoints.touchpoint_sequence(d.events, HEAVY_ROWS)


@query
def touchpoint_sequence_chunks(d: Data) -> DataFrame:
    return touchpoints.sequence_chunks(d.events, 25, HEAVY_ROWS)


@query
def ordered_touchpoints(d: Data) -> DataFrame:
    return touchpoints.ordered_touchpoints(d.events)


@query
def ordered_touchpoints_heavy(d: Data) -> DataFrame:
    return touchpoints.ordered_touchpoints(d.events, HEAVY_ROWS)


@query
def customer_edges(d: Data) -> DataFrame:
    return journey.customer_edges(d.events, d.orders)


@query
def stage_totals(d: Data) -> DataFrame:
    return journey.stage_totals(d.events, d.orders)


@query
def total_touch_customers(d: Data) -> DataFrame:
    return journey.total_touch_customers(d.events)


@query
def join_order_payment(d: Data) -> DataFrame:
    joined = finance.join_order_payment(d.orders, d.payments)
    return joined.select("order_key", "transaction_id", "payment_key", "payment_amount_vnd")


@query
def customer_aggregates(d: Data) -> DataFrame:
    return upsert.customer_aggregates(d.customers, d.orders)


@query
def matched_customers(d: Data) -> DataFrame:
    return upsert.matched_customers(d.customers, d.orders)


@query
def heavy_keys(d: Data) -> DataFrame:
    return skew.heavy_keys(d.feeds.table("events"), "user_id", HEAVY_ROWS)


# -- views -------------------------------------------------------------------
def _shares(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {c: F.round(c, 6) for c in ("pct_of_source_stage", "pct_of_total_customers")})


@query
def vw_customer_journey(d: Data) -> DataFrame:
    return journey.customer_journey(d.events, d.orders)


@query
def vw_customer_journey_sankey(d: Data) -> DataFrame:
    return _shares(journey.customer_journey_sankey(d.events, d.orders))


@query
def vw_customer_journey_sankey_heavy(d: Data) -> DataFrame:
    return _shares(journey.customer_journey_sankey(d.events, d.orders, HEAVY_ROWS))


@query
def vw_cashflow_daily(d: Data) -> DataFrame:
    return finance.cashflow_daily(d.orders, d.payments, d.bank)


@query
def vw_payment_status(d: Data) -> DataFrame:
    return finance.payment_status(d.orders, d.payments, AS_OF)


@query
def sql_customer_journey(d: Data) -> DataFrame:
    schema = d.saved("fact_cart_events", "fact_orders")
    return tables.run_sql(d.spark, views.journey_sql(schema, HEAVY_ROWS), to_dataframe=True)


@query
def sql_customer_journey_sankey(d: Data) -> DataFrame:
    schema = d.saved("fact_cart_events", "fact_orders")
    return _shares(d.spark.sql(views.sankey_sql(schema, HEAVY_ROWS)))


@query
def sql_cashflow_daily(d: Data) -> DataFrame:
    schema = d.saved("fact_orders", "fact_payments", "fact_bank_transactions")
    return d.spark.sql(views.cashflow_sql(schema))


@query
def sql_payment_status(d: Data) -> DataFrame:
    schema = d.saved("fact_orders", "fact_payments")
    return d.spark.sql(views.payment_status_sql(schema, AS_OF))


@query
def create_views(d: Data) -> DataFrame:
    schema = d.saved(*d.dated_facts())
    views.create_views(d.spark, schema)
    return _count({v: d.spark.table(f"{schema}.{v}") for v in views.VIEW_TABLES})


# -- sources -----------------------------------------------------------------
def _customer_feed(d: Data) -> str:
    root = d.new_root()
    write_feed(d.feeds.customers(), f"{root}/shared/customers", "customers", "customer_batch")
    return root


@query
def list_feed(d: Data) -> DataFrame:
    listed = sources.list_feed(d.spark, _customer_feed(d), "shared/")
    return listed.agg((F.count(F.lit(1)) > 0).alias("has_files"),
                      F.bool_and(F.col("path").endswith(".json.gz")).alias("only_json_gz"))


@query
def read_json_gz(d: Data) -> DataFrame:
    documents = sources.read_json_gz(
        d.spark, f"{_customer_feed(d)}/shared/customers", "customers")
    return documents.agg(F.sum(F.size("listed")).alias("row_count"), F.sum(F.aggregate(
        "listed", F.lit(0), lambda n, row: n + F.size(F.map_values(row)))).alias("value_count"))


@query
def unwrap_envelope(d: Data) -> DataFrame:
    documents = sources.read_json_gz(
        d.spark, f"{_customer_feed(d)}/shared/customers", "customers")
    names = ("id", "email", "name", "country", "customer_segment")
    return sources.unwrap_envelope(documents).select(*[
        F.try_element_at("fields", F.lit(n)).alias(n) for n in names])


def _scan(name: str, write: Callable[[Data], DataFrame], path: str, key: str,
          scan: Callable[[SparkSession, str], DataFrame],
          build: Callable[[DataFrame], DataFrame], file: str = "part") -> None:
    """What the feed's builder makes of the scanned rows: every column it uses counts."""
    def run(d: Data) -> DataFrame:
        root = d.new_root()
        write_feed(write(d), f"{root}/{path}", key, file)
        return build(scan(d.spark, root))

    _QUERIES[name] = run


def _orders_of(feed: str) -> Callable[[DataFrame], DataFrame]:
    return lambda raw: facts.fact_orders(raw, *ORDER_CHANNELS[feed])


_scan("scan_customers", lambda d: d.feeds.customers(), "shared/customers", "customers",
      sources.scan_customers, dimensions.dim_customers, "customer_batch")
_scan("scan_products", lambda d: d.feeds.products(), "shared/products.json.gz", "products",
      sources.scan_products, dimensions.dim_products)
_scan("scan_shopify_orders", lambda d: d.feeds.shopify_orders(), "shopify", "orders",
      sources.scan_shopify_orders, _orders_of("shopify_orders"), "orders_batch")
_scan("scan_sapo_orders", lambda d: d.feeds.sapo_orders(), "sapo", "orders",
      sources.scan_sapo_orders, _orders_of("sapo_orders"), "orders")
_scan("scan_online_orders", lambda d: d.feeds.online_orders(),
      "online_orders/online_orders.json.gz", "orders", sources.scan_online_orders,
      _orders_of("online_orders"))
_scan("scan_order_lines", lambda d: d.feeds.order_lines()["shopify_orders"], "shopify", "orders",
      sources.scan_shopify_orders, facts.fact_order_items, "orders_batch")
_scan("scan_other_fields", lambda d: d.feeds.shopify_orders(), "shopify", "orders",
      sources.scan_shopify_orders, lambda raw: raw.select("id", F.try_element_at(
          sources.OTHER, F.lit("gift_note")).alias("gift_note")), "orders_batch")
_scan("scan_sapo_locations", lambda d: d.feeds.sapo_locations(), "shared/sapo_locations.json.gz",
      "locations", sources.scan_sapo_locations, dimensions.dim_locations)
_scan("scan_shopify_staff", lambda d: d.feeds.staff(), "shopify/staff.json.gz", "staff",
      sources.scan_shopify_staff, dimensions.dim_staff)
_scan("scan_cart_events", lambda d: d.feeds.cart_events(), "cart_tracking/cart_events.json.gz",
      "events", sources.scan_cart_events, facts.fact_cart_events)
_scan("scan_bank_transactions", lambda d: d.feeds.bank_transactions(),
      "mercury/transactions.json.gz", "transactions", sources.scan_bank_transactions,
      facts.fact_bank_transactions)
for _gateway in PAYMENT_GATEWAYS:
    _scan(f"scan_payments_{_gateway}", lambda d, g=_gateway: d.feeds.payments(g),
          f"{_gateway}/transactions.json.gz", "transactions",
          lambda spark, root, g=_gateway: sources.scan_payments(spark, root, g),
          lambda raw, g=_gateway: facts.fact_payments(raw, g))


@query
def scan_all_payments(d: Data) -> DataFrame:
    root = d.new_root()
    for gateway, raw in d.feeds.all_payments().items():
        write_feed(raw, f"{root}/{gateway}/transactions.json.gz", "transactions")
    return facts.combine_payments(sources.scan_all_payments(d.spark, root))


@query
def scan_sources(d: Data) -> DataFrame:
    root = d.new_root()
    write_all_feeds(d.feeds, root)
    found = sources.scan_sources(d.spark, root)
    payments = found.pop("payments_by_gateway")
    frames = {**found, **{f"payments.{g}": df for g, df in payments.items()}}
    return sources.feed_report(d.spark, root, frames).select("feed", "row_count", "column_count")


@query
def scan_with_bad_files(d: Data) -> DataFrame:
    """Rows read and files skipped where every feed folder also holds a broken archive."""
    root = d.new_root()
    write_feed(d.feeds.customers(), f"{root}/shared/customers", "customers", "customer_batch")
    text = d.feeds.table("customer").limit(1).select(F.lit("not gzip").alias("value"))
    text.write.text(f"{root}/broken")
    hadoop = d.spark._jvm.org.apache.hadoop.fs
    conf = d.spark._jsc.hadoopConfiguration()
    source = hadoop.Path(f"{root}/broken/part-*")
    files = source.getFileSystem(conf)
    for i, status in enumerate(files.globStatus(source)):
        files.rename(status.getPath(), hadoop.Path(
            f"{root}/shared/customers/customer_bad_{i}.json.gz"))
    scanned = sources.scan_customers(d.spark, root)
    missed = sources.skipped_files(d.spark, root, "shared/customers", scanned)
    return missed.groupBy(F.regexp_extract("path", "customer_[a-z]+", 0).alias("file")).agg(
        (F.count(F.lit(1)) > 0).alias("skipped")).crossJoin(
        scanned.agg(F.count(F.lit(1)).alias("row_count")))


# -- sinks and whole runs ----------------------------------------------------
@query
def write_table(d: Data) -> DataFrame:
    schema, spec = d.new_schema(), TABLES["fact_cart_events"]
    for mode in ("WRITE_TRUNCATE", " write_append "):
        tables.write_table(d.events, schema, spec.name, mode, spec.day, spec.cluster)
    return d.spark.table(f"{schema}.{spec.name}").groupBy("event_type", "event_date_key").agg(
        F.count(F.lit(1)).alias("row_count"))


@query
def run_sql(d: Data) -> DataFrame:
    path = f"{d.feeds.folder}/orders.parquet"
    return tables.run_sql(
        d.spark,
        f"SELECT o_orderstatus, count(*) AS row_count FROM parquet.`{path}` "
        "WHERE o_totalprice > :least GROUP BY o_orderstatus",
        {"least": 1000}, to_dataframe=True)


@query
def update_customer_aggregates(d: Data) -> DataFrame:
    schema = d.saved("dim_customers", "fact_orders")
    tables.update_customer_aggregates(d.spark, schema)
    return conform(d.spark.table(f"{schema}.dim_customers"), TABLES["dim_customers"].schema)


@query
def load_warehouse_(d: Data) -> DataFrame:
    """The values of all tables after a load from written feeds.

    Without day folders, which ``load_by_day`` shows: the same rows take four minutes more.
    """
    root, schema = d.new_root(), d.new_schema()
    write_all_feeds(d.feeds, root)
    summary = load_warehouse(d.spark, root, schema, holidays=HOLIDAYS, now=NOW,
                             day_folders=False).summary
    made = {n: d.spark.table(f"{schema}.{n}") for n in summary if n in TABLES}
    counts = d.spark.createDataFrame(
        [(n, c, "", 0, 0.0) for n, c in summary.items() if n not in TABLES],
        "name string, row_count long, column_name string, known long, total double")
    return _profile(made).unionByName(counts)


@query
def load_by_day(d: Data) -> DataFrame:
    """Rows per day read back by day folder, with the partition columns of each table."""
    names = ("fact_orders", "fact_cart_events", "fact_bank_transactions")
    schema = d.saved(*names, all_folders=True)
    parts = []
    for name in names:
        day = [c.name for c in d.spark.catalog.listColumns(f"{schema}.{name}") if c.isPartition]
        parts.append(d.spark.table(f"{schema}.{name}").groupBy(
            F.lit(name).alias("name"), F.lit(",".join(day)).alias("partitions"),
            F.col(TABLES[name].day).alias("day")).agg(F.count(F.lit(1)).alias("row_count")))
    return reduce(DataFrame.union, parts)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(run: Query) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, folder: shown(run(Data(spark, folder)))

    return {name.rstrip("_"): bind(run) for name, run in _QUERIES.items()}


