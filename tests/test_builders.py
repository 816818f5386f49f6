"""Fact and dimension builders on small raw frames."""

import datetime as dt
from decimal import Decimal

import pytest
from frames import rows, when
from pyspark.sql import Row

from bazaarlake.plans import dimensions, facts
from bazaarlake.functions.names import standardize_names


def test_fact_orders_nested_spellings_defaults_and_duplicates(spark):
    raw = spark.createDataFrame(
        [("SHP-001", "TXN-001", Row(id=501), "2026-04-01T08:00:00Z",
          Row(cityName="Ha Noi", address1="1 Hang Bai"), None, "paid", 125000.0, "text"),
         ("SHP-001", "TXN-001", Row(id=501), "2026-04-01T08:00:00Z",
          Row(cityName="Ha Noi", address1="later"), "done", "paid", 1.0, "text")],
        "id string, transaction_code string, customer struct<id:long>, created_at string, "
        "shippingAddress struct<cityName:string,address1:string>, status string, "
        "financial_status string, amount_vnd double, note string").coalesce(1)
    out = facts.fact_orders(raw, "shopify", "shopify").drop("feed_position")
    row = out.collect()
    assert len(row) == 1
    row = row[0]
    assert row.order_key == "SHP-001_TXN-001" and row.customer_id == 501
    assert (row.shipping_city, row.shipping_address) == ("Ha Noi", "1 Hang Bai")
    assert (row.status, row.payment_status, row.channel) == ("unknown", "paid", "shopify")
    assert row.order_date_key == dt.date(2026, 4, 1) and row.order_date == when("2026-04-01 08:00")
    assert (row.total_vnd, row.total_usd) == (Decimal("125000.00"), Decimal("0.00"))


def test_text_shipping_address_is_not_read(spark):
    raw = spark.createDataFrame([("1", "somewhere", None)],
                                "order_id string, shipping_address string, channel string")
    row = facts.fact_orders(raw, "online", "online_orders").first()
    assert row.shipping_address is None and row.channel == "online"


def test_order_items_inherit_and_compute(spark):
    item = ("struct<variant_id:long,item_id:long,transaction_id:string,quantity:double,"
            "qty:double,price_vnd:double,price:double,amount_vnd:double>")
    raw = spark.createDataFrame(
        [("ORD-9", "TXN-100", "2026-04-03", "2030-01-01",
          [Row(9001, None, "T-9", 2.0, None, 120000.0, None, None),
           Row(None, 9002, None, None, 1.0, None, 5.0, 7.0),
           Row(None, 9002, None, None, 9.0, None, 5.0, 8.0)]),
         ("ORD-10", None, None, "2030-01-01", [Row(1, None, None, 1.0, None, 2.0, None, None)]),
         ("ORD-11", None, None, None, [])],
        "order_id string, txn_id string, created_at string, response_time_iso string, "
        f"lineItems array<{item}>").coalesce(1)
    out = rows(facts.fact_order_items(raw), "order_item_key", "transaction_id", "quantity",
               "line_total_vnd", "order_date_key")
    assert out == [
        ("ORD-10__1_", None, 1.0, Decimal("2.00"), None),
        ("ORD-9_TXN-100_9001_T-9", "T-9", 2.0, Decimal("240000.00"), dt.date(2026, 4, 3)),
        ("ORD-9_TXN-100_9002_TXN-100", "TXN-100", 1.0, Decimal("7.00"), dt.date(2026, 4, 3)),
    ]
    assert facts.fact_order_items(raw.drop("lineItems")).count() == 0


def test_payments_first_duplicate_wins(spark):
    raw = spark.createDataFrame(
        [("PAY-001", "ORD-001", None, None, None, 5.0), ("PAY-001", "ORD-001", "m", "x", "ok", 9.0)],
        "txn_id string, reference_id string, gateway string, method string, status string, "
        "amount double").coalesce(1)
    row = facts.fact_payments(raw, "momo").collect()
    assert len(row) == 1 or {r.payment_gateway for r in row} == {"momo", "m"}
    first = [r for r in row if r.payment_gateway == "momo"][0]
    assert first.payment_key == "PAY-001_momo_ORD-001"
    assert (first.payment_method, first.payment_status) == ("unknown", "unknown")


@pytest.mark.parametrize("text, result, ret, status", [
    ("x", 0, None, "paid"), ("x", 49, None, "failed"), ("done", None, None, "done"),
    ("x", None, 1, "paid"), ("x", None, 2, "failed"), ("x", 0, 2, "failed"),
    (" Success ", None, None, "paid"), ("authorized", None, None, "paid"),
    ("processing", None, None, "pending"), ("error", None, None, "failed"),
    ("refunded", None, None, "refunded"), (None, None, None, "unknown"),
])
def test_payment_status(spark, text, result, ret, status):
    raw = spark.createDataFrame([("1", text, result, ret)],
                                "id string, message string, resultCode int, returnCode int")
    assert facts.fact_payments(raw, "momo").first().payment_status == status


def test_bank_and_events(spark):
    bank = spark.createDataFrame(
        [("B1", "7", None, -5.5, None, "2026-04-01 10:00:00")],
        "id string, accountid string, kind string, amount double, status string, createdAt string")
    row = facts.fact_bank_transactions(bank).first()
    assert (row.transaction_key, row.transaction_type, row.status) == ("B1_7", "unknown", "unknown")
    assert row.amount_vnd == Decimal("-5.50") and row.transaction_date_key == dt.date(2026, 4, 1)
    event = ("EVT-001", "SES-001", 1, "view", "2026-04-06T01:00:00Z", None)
    raw = spark.createDataFrame([event, event], "id string, session string, customer_id long, "
                                "type string, timestamp string, channel string").coalesce(1)
    out = facts.fact_cart_events(raw).collect()
    assert len(out) == 1 and out[0].event_key == "EVT-001_SES-001"
    assert out[0].event_date_key == dt.date(2026, 4, 6) and out[0].source is None


def test_shared_order_ids_go_to_the_earlier_channel(spark):
    frame = spark.createDataFrame([("1", "T")], "order_id string, transaction_id string")
    empty = frame.limit(0)
    out = facts.combine_orders(
        {"shopify_orders": frame, "sapo_orders": empty, "online_orders": frame})
    assert rows(out, "channel") == [("shopify",)]


def test_dimensions(spark):
    customers = spark.createDataFrame(
        [(1001, "a@x", "A", "loyal"), (1002, None, "B", None), (1002, None, "later", None)],
        "id long, email string, name string, customer_segment string").coalesce(1)
    out = {r.customer_id: r for r in dimensions.dim_customers(customers).collect()}
    assert len(out) == 2 and out[1002].full_name == "B"
    assert (out[1002].customer_segment, out[1002].total_orders) == ("unknown", 0)
    products = spark.createDataFrame([(2002, "P", None, None)],
                                     "id long, name string, price_vnd double, is_active boolean")
    row = dimensions.dim_products(products).first()
    assert (row.price_vnd, row.stock_quantity, row.is_active) == (0, 0, True)
    places = spark.createDataFrame([(1, "S", None, "no")],
                                   "id long, name string, type string, active string")
    row = dimensions.dim_locations(places).first()
    assert (row.location_type, row.is_active) == ("store", False)
    staff = spark.createDataFrame([(7, "Z", Row(id=3), "2020-05-05")],
                                  "id long, name string, location struct<id:int>, joinedAt string")
    row = dimensions.dim_staff(staff).first()
    assert (row.location_id, row.position, row.is_active) == (3, "unknown", True)
    assert row.hire_date == when("2020-05-05")


def test_locations_from_orders(spark):
    orders = spark.createDataFrame([(1, "L"), (None, None)], "locationId int, location_name string")
    found = dimensions.locations_from_orders(orders)
    assert rows(found, "location_id", "location_type", "is_active") == [("1", "store", True)]
    assert dimensions.locations_from_orders(spark.range(3)).count() == 0
    listed = spark.createDataFrame([(1, "first")], "id int, name string")
    out = dimensions.dim_locations(dimensions.all_locations(listed, orders))
    assert rows(out, "location_id", "location_name") == [(1, "first")]


def test_calendar(spark):
    out = {r.date_key: r for r in dimensions.dim_date(
        spark, "2026-04-20", "2026-04-22", ["2026-04-21"]).collect()}
    assert len(out) == 3
    day = out[20260421]
    assert (day.month_name, day.day_name, day.is_weekend, day.is_holiday) == (
        "April", "Tuesday", False, True)
    weeks = dimensions.dim_date(spark, "2025-12-29", "2026-01-01").collect()
    assert {r.week for r in weeks} == {1} and dimensions.parse_holidays(" a, ,b ") == ["a", "b"]


def test_calendar_bounds(spark, schema):
    dated = spark.createDataFrame([(when("2026-01-06"),), (None,)], "order_date timestamp")
    assert dimensions.calendar_bounds(spark, {"fact_orders": dated}) == (
        dt.date(2026, 1, 6), dt.date(2026, 1, 6))
    with pytest.raises(ValueError):
        dimensions.calendar_bounds(spark, {"fact_orders": dated}, start="2027-01-01")
    none = dated.limit(0)
    assert dimensions.calendar_bounds(spark, {"fact_orders": none}, today=dt.date(2024, 3, 3)) == (
        dt.date(2024, 1, 1), dt.date(2024, 12, 31))
    dated.write.saveAsTable(f"{schema}.fact_orders")
    assert dimensions.calendar_bounds(spark, {"fact_orders": none}, schema=schema) == (
        dt.date(2026, 1, 6), dt.date(2026, 1, 6))


def test_standardized_frame_keeps_feed_position(spark):
    df = spark.createDataFrame([(1, 2)], "feed_position int, aB int")
    assert standardize_names(df).columns == ["feed_position", "a_b"]
