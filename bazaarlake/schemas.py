"""Target tables: columns, key, day partition and clustering of each."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

_TYPES = {
    "long": T.LongType(), "int": T.IntegerType(), "str": T.StringType(),
    "bool": T.BooleanType(), "double": T.DoubleType(), "money": T.DecimalType(18, 2),
    "ts": T.TimestampType(), "date": T.DateType(),
}


def _schema(text: str) -> T.StructType:
    pairs = [item.strip().split(":") for item in text.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


@dataclass(frozen=True)
class Table:
    name: str
    schema: T.StructType
    key: str
    day: str | None = None
    cluster: tuple[str, ...] = ()


TABLES = {
    t.name: t
    for t in (
        Table("dim_customers", _schema(
            "customer_id:long, email:str, full_name:str, phone:str, city:str, country:str,"
            "created_at:ts, customer_segment:str, lifetime_value_vnd:money, total_orders:long,"
            "first_order_date:ts, last_order_date:ts"), "customer_id", "created_at"),
        Table("dim_products", _schema(
            "product_id:long, product_name:str, sku:str, barcode:str, category:str, brand:str,"
            "price_vnd:money, price_usd:money, stock_quantity:long, is_active:bool"), "product_id"),
        Table("dim_locations", _schema(
            "location_id:long, location_code:str, location_name:str, location_type:str, city:str,"
            "address:str, phone:str, is_active:bool"), "location_id"),
        Table("dim_staff", _schema(
            "staff_id:long, staff_code:str, full_name:str, position:str, email:str, phone:str,"
            "location_id:long, hire_date:ts, is_active:bool"), "staff_id"),
        Table("dim_date", _schema(
            "date_key:int, full_date:date, year:int, quarter:int, month:int, month_name:str,"
            "week:int, day_of_month:int, day_of_week:int, day_name:str, is_weekend:bool,"
            "is_holiday:bool, fiscal_year:int, fiscal_quarter:int"), "date_key"),
        Table("fact_orders", _schema(
            "order_key:str, order_id:str, transaction_id:str, customer_id:long,"
            "order_date_key:date, order_date:ts, channel:str, source:str, shipping_city:str,"
            "shipping_address:str, status:str, payment_status:str, total_vnd:money,"
            "total_usd:money"), "order_key", "order_date_key", ("customer_id", "channel")),
        Table("fact_order_items", _schema(
            "order_item_key:str, order_key:str, transaction_id:str, product_id:long,"
            "order_date_key:date, quantity:double, unit_price_vnd:money, line_total_vnd:money"),
            "order_item_key", "order_date_key", ("product_id",)),
        Table("fact_payments", _schema(
            "payment_key:str, transaction_id:str, order_id:str, customer_id:long,"
            "payment_gateway:str, payment_method:str, amount_vnd:money, payment_status:str,"
            "payment_date_key:date, payment_date:ts"),
            "payment_key", "payment_date_key", ("customer_id", "payment_gateway")),
        Table("fact_cart_events", _schema(
            "event_key:str, event_id:str, session_id:str, customer_id:long, event_type:str,"
            "event_date_key:date, event_timestamp:ts, product_id:long, source:str, device:str,"
            "browser:str, utm_source:str, utm_campaign:str"),
            "event_key", "event_date_key", ("customer_id", "session_id", "event_type")),
        Table("fact_bank_transactions", _schema(
            "transaction_key:str, transaction_id:str, account_id:str, transaction_type:str,"
            "amount_vnd:money, status:str, transaction_date_key:date, transaction_date:ts"),
            "transaction_key", "transaction_date_key"),
    )
}

# The one timestamp per fact that bounds the calendar.
FACT_DATES = {
    "fact_orders": "order_date",
    "fact_payments": "payment_date",
    "fact_cart_events": "event_timestamp",
    "fact_bank_transactions": "transaction_date",
}
