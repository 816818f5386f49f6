"""Raw feeds to fact tables.

Each builder is one projection over its feed (all spellings, casts, defaults
and keys collapse into a single Project) followed by one keep-first shuffle on
the surrogate key. Builders pass the feed position on, so that a union of
several feeds can defer the removal of duplicates and pay for it once.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bazaarlake import fixed_values as fixed
from bazaarlake.functions.columns import (
    coalesce_sql,
    conform,
    default_sql,
    line_total_sql,
    literal,
)
from bazaarlake.functions.keys import joined_sql, surrogate_key
from bazaarlake.functions.names import FEED_POSITION, standardize_names
from bazaarlake.operators.dedupe import (
    combine_frames,
    keep_first,
    keep_first_counted,
    with_position,
)
from bazaarlake.operators.explode import explode_items
from bazaarlake.schemas import TABLES


@dataclass(frozen=True)
class Field:
    """One output column: its type, accepted spellings and default."""

    name: str
    type_name: str
    candidates: tuple[str, ...]
    nested: tuple[tuple[str, str], ...] = ()
    default: object = None

    def read(self, df: DataFrame) -> str:
        value = coalesce_sql(df, self.candidates, self.type_name, self.nested, self.default)
        return f"{value} as {self.name}"


_ORDER_FIELDS = (
    Field("order_id", "string", fixed.ORDER_ID),
    Field("transaction_id", "string", fixed.ORDER_TRANSACTION),
    Field("customer_id", "int", fixed.ORDER_CUSTOMER, fixed.CUSTOMER_NESTED),
    Field("order_date", "datetime", fixed.ORDER_DATE),
    Field("shipping_city", "string", fixed.SHIPPING_CITY, fixed.SHIPPING_CITY_NESTED),
    Field("shipping_address", "string", fixed.SHIPPING_ADDRESS, fixed.SHIPPING_ADDRESS_NESTED),
    Field("status", "string", fixed.ORDER_STATUS, default=fixed.UNKNOWN),
    Field("payment_status", "string", fixed.ORDER_PAYMENT_STATUS, default=fixed.UNKNOWN),
    Field("total_vnd", "numeric", fixed.ORDER_TOTAL_VND, default=0),
    Field("total_usd", "numeric", fixed.ORDER_TOTAL_USD, default=0),
)
_ITEM_PARENT_FIELDS = (
    Field("order_id", "string", fixed.ORDER_ID),
    Field("transaction_id", "string", fixed.ORDER_TRANSACTION),
    Field("order_date", "datetime", fixed.ITEM_PARENT_DATE),
)
_ITEM_FIELDS = (
    Field("order_key", "string", ("order_key", "parent_order_key")),
    Field("transaction_id", "string", ("transaction_id", "parent_transaction_id")),
    Field("order_date", "datetime", ("order_date", "parent_order_date")),
    Field("product_id", "int", fixed.ITEM_PRODUCT),
    Field("quantity", "float", fixed.ITEM_QUANTITY),
    Field("unit_price_vnd", "numeric", fixed.ITEM_UNIT_PRICE),
    Field("line_total_vnd", "numeric", fixed.ITEM_LINE_TOTAL),
)
_PAYMENT_FIELDS = (
    Field("transaction_id", "string", fixed.PAYMENT_TRANSACTION),
    Field("order_id", "string", fixed.PAYMENT_ORDER),
    Field("customer_id", "int", fixed.ORDER_CUSTOMER, fixed.CUSTOMER_NESTED),
    Field("payment_method", "string", fixed.PAYMENT_METHOD, default=fixed.UNKNOWN),
    Field("amount_vnd", "numeric", fixed.PAYMENT_AMOUNT, default=0),
    Field("payment_date", "datetime", fixed.PAYMENT_DATE),
)
_BANK_FIELDS = (
    Field("transaction_id", "string", fixed.BANK_TRANSACTION),
    Field("account_id", "string", fixed.BANK_ACCOUNT),
    Field("transaction_type", "string", fixed.BANK_TYPE, default=fixed.UNKNOWN),
    Field("amount_vnd", "numeric", fixed.BANK_AMOUNT, default=0),
    Field("status", "string", ("status",), default=fixed.UNKNOWN),
    Field("transaction_date", "datetime", fixed.BANK_DATE),
)
_EVENT_FIELDS = (
    Field("event_id", "string", fixed.EVENT_ID),
    Field("session_id", "string", fixed.EVENT_SESSION),
    Field("customer_id", "int", ("customer_id",)),
    Field("event_type", "string", fixed.EVENT_TYPE),
    Field("event_timestamp", "datetime", fixed.EVENT_TIME),
    Field("product_id", "int", fixed.EVENT_PRODUCT),
    Field("source", "string", fixed.EVENT_SOURCE),
    Field("device", "string", fixed.EVENT_DEVICE),
    Field("browser", "string", ("browser",)),
    Field("utm_source", "string", ("utm_source",)),
    Field("utm_campaign", "string", ("utm_campaign",)),
)


def _finish(
    rows: DataFrame, table: str, day_of: str, key_of: tuple[str, ...], unique: bool
) -> DataFrame:
    """Add day and surrogate key, take the table's shape, keep the first row per key."""
    spec = TABLES[table]
    keyed = rows.selectExpr(
        "*", f"to_date({day_of}) as {spec.day}", f"{joined_sql(key_of)} as {spec.key}")
    shaped = conform(keyed, spec.schema, keep=[FEED_POSITION])
    return keep_first(shaped, [spec.key]) if unique else shaped


def fact_orders(
    raw: DataFrame, channel: str | None = None, source: str | None = None, unique: bool = True
) -> DataFrame:
    df = with_position(standardize_names(raw))
    rows = df.selectExpr(
        *[f.read(df) for f in _ORDER_FIELDS],
        f"{default_sql(df, 'channel', channel)} as channel",
        f"{default_sql(df, 'source', source)} as source",
        FEED_POSITION,
    )
    return _finish(rows, "fact_orders", "order_date", ("order_id", "transaction_id"), unique)


def fact_order_items(raw: DataFrame, unique: bool = True) -> DataFrame:
    df = with_position(standardize_names(raw))
    if "line_items" not in df.columns:
        empty = df.sparkSession.createDataFrame([], TABLES["fact_order_items"].schema)
        return with_position(empty)
    parents = df.selectExpr(
        *[f.read(df) for f in _ITEM_PARENT_FIELDS], "line_items", FEED_POSITION)
    parents = surrogate_key(parents, ["order_id", "transaction_id"], "order_key")
    items = explode_items(
        parents, "line_items", ["order_key", "order_id", "transaction_id", "order_date"]
    )
    rows = items.selectExpr(*[f.read(items) for f in _ITEM_FIELDS], FEED_POSITION)
    rows = rows.selectExpr(
        "order_key", "transaction_id", "order_date", "product_id", FEED_POSITION,
        "coalesce(quantity, 0D) as quantity", "coalesce(unit_price_vnd, 0) as unit_price_vnd",
        f"{line_total_sql('line_total_vnd', 'quantity', 'unit_price_vnd')} as line_total_vnd",
    )
    key = ("order_key", "product_id", "transaction_id")
    return _finish(rows, "fact_order_items", "order_date", key, unique)


def payment_status_sql(df: DataFrame) -> str:
    """One status from status text and gateway codes; the return code rules last."""
    status = f"lower(trim({coalesce_sql(df, fixed.PAYMENT_STATUS, 'string')}))"
    for column, good in (("result_code", 0), ("return_code", 1)):
        if column in df.columns:
            status = (f"case when try_cast({column} as double) = {good} then 'paid' "
                      f"when {column} is not null then 'failed' else {status} end")

    def words(values: tuple[str, ...]) -> str:
        return ", ".join(literal(v) for v in values)

    # ``said`` is bound once, so the status expression is not repeated per branch.
    return (f"element_at(transform(array({status}), said -> case "
            f"when said in ({words(fixed.STATUS_TO_PAID)}) then 'paid' "
            f"when said in ({words(fixed.STATUS_TO_PENDING)}) then 'pending' "
            f"when said in ({words(fixed.STATUS_TO_FAILED)}) then 'failed' "
            "else said end), 1)")


def derive_payment_status(df: DataFrame) -> Column:
    return F.expr(payment_status_sql(df))


def fact_payments(raw: DataFrame, gateway: str | None = None, unique: bool = True) -> DataFrame:
    df = with_position(standardize_names(raw))
    fallback = gateway or fixed.UNKNOWN
    rows = df.selectExpr(
        *[f.read(df) for f in _PAYMENT_FIELDS],
        f"{coalesce_sql(df, fixed.PAYMENT_GATEWAY, 'string', default=fallback)} "
        "as payment_gateway",
        f"coalesce({payment_status_sql(df)}, {literal(fixed.UNKNOWN)}) as payment_status",
        FEED_POSITION,
    )
    key = ("transaction_id", "payment_gateway", "order_id")
    return _finish(rows, "fact_payments", "payment_date", key, unique)


def fact_bank_transactions(raw: DataFrame, unique: bool = True) -> DataFrame:
    df = with_position(standardize_names(raw))
    rows = df.selectExpr(*[f.read(df) for f in _BANK_FIELDS], FEED_POSITION)
    key = ("transaction_id", "account_id")
    return _finish(rows, "fact_bank_transactions", "transaction_date", key, unique)


def fact_cart_events(raw: DataFrame, unique: bool = True) -> DataFrame:
    df = with_position(standardize_names(raw))
    rows = df.selectExpr(*[f.read(df) for f in _EVENT_FIELDS], FEED_POSITION)
    key = ("event_id", "session_id")
    return _finish(rows, "fact_cart_events", "event_timestamp", key, unique)


def _union(table: str, frames: list[DataFrame], counted: bool) -> DataFrame:
    spec = TABLES[table]
    return combine_frames(frames, spec.schema, [spec.key], counted)


def combine_orders(raw: dict[str, DataFrame], counted: bool = False) -> DataFrame:
    """All order channels; ids shared between channels go to the earlier channel."""
    return _union("fact_orders", [
        fact_orders(raw[feed], channel, source, unique=False)
        for feed, (channel, source) in fixed.ORDER_CHANNELS.items()
    ], counted)


def combine_order_items(raw: dict[str, DataFrame], counted: bool = False) -> DataFrame:
    return _union("fact_order_items", [
        fact_order_items(raw[feed], unique=False) for feed in fixed.ORDER_CHANNELS
    ], counted)


def combine_payments(payments: dict[str, DataFrame], counted: bool = False) -> DataFrame:
    return _union("fact_payments", [
        fact_payments(payments[gateway], gateway, unique=False)
        for gateway in fixed.PAYMENT_GATEWAYS if gateway in payments
    ], counted)


def build_facts(raw: dict[str, object], counted: bool = False) -> dict[str, DataFrame]:
    """The five facts from the raw sources, each with its duplicates removed once.

    ``counted`` adds ``FEED_COPIES`` to each, for the report on duplicates.
    """
    def single(build, table: str, feed: str) -> DataFrame:
        if not counted:
            return build(raw[feed])
        return keep_first_counted(build(raw[feed], unique=False), [TABLES[table].key])

    builders = {
        "fact_orders": partial(combine_orders, raw, counted),
        "fact_order_items": partial(combine_order_items, raw, counted),
        "fact_payments": partial(combine_payments, raw["payments_by_gateway"], counted),
        "fact_cart_events": partial(single, fact_cart_events, "fact_cart_events", "cart_events"),
        "fact_bank_transactions": partial(
            single, fact_bank_transactions, "fact_bank_transactions", "bank_transactions"),
    }
    return {name: build().drop(FEED_POSITION) for name, build in builders.items()}


