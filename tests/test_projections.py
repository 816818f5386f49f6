import datetime as dt

import pytest
from frames import rows, when
from pyspark.sql import Row

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
from bazaarlake.functions.names import rename_columns, snake, standardize_names
from bazaarlake.schemas import TABLES


@pytest.mark.parametrize("raw, name", [
    ("Customer ID", "customer_id"), ("CreatedAt", "created_at"), ("Total-VND", "total_vnd"),
    ("orderId", "order_id"), ("amountVND", "amount_vnd"), ("HTTPCode", "httpcode"),
    ("__x--y__", "x_y"), ("address1", "address1"), ("a1B", "a1_b"),
])
def test_snake(raw, name):
    assert snake(raw) == name


def test_standardize_names_reaches_nested_fields_and_merges_spellings(spark):
    df = spark.createDataFrame(
        [(1, None, Row(cityName="Hue", Zip=5), [Row(variantId=7)])],
        "orderId int, order_id int, shippingAddress struct<cityName:string,Zip:int>, "
        "lineItems array<struct<variantId:int>>")
    out = standardize_names(df)
    assert out.columns == ["order_id", "shipping_address", "line_items"]
    assert out.select("order_id", "shipping_address.city_name",
                      "line_items.variant_id").first() == (1, "Hue", [7])


def test_casts_are_tolerant(spark):
    df = spark.createDataFrame(
        [("1001", "2026-04-01 10:00:00", "10.5", "yes"), (None, "invalid", "-5", " No "),
         ("10.0", "2026-04-02T00:00:00Z", "x", "1"), ("10.5", None, "NaN", "1.0")],
        "customer_id string, created_at string, amount string, is_active string")
    out = cast_columns(df, {"customer_id": "int", "created_at": "datetime",
                            "amount": "numeric", "is_active": "bool", "absent": "int"})
    assert [r.customer_id for r in out.collect()] == [1001, None, 10, None]
    assert [r.created_at for r in out.collect()][:2] == [when("2026-04-01 10:00:00"), None]
    assert [None if r.amount is None else float(r.amount) for r in out.collect()] == [
        10.5, -5.0, None, None]
    assert [r.is_active for r in out.collect()] == [True, False, True, None]
    as_float = cast_columns(df, {"amount": "float"}).collect()
    assert [r.amount for r in as_float] == [10.5, -5.0, None, None]
    as_date = cast_columns(df, {"created_at": "date"}).collect()
    assert as_date[2].created_at == dt.date(2026, 4, 2)
    with pytest.raises(ValueError):
        cast_columns(df, {"amount": "money"})


def test_coalesce_picks_the_first_raw_value_then_casts(spark):
    df = spark.createDataFrame(
        [("bad", 5, Row(id=9)), (None, 6, Row(id=9)), (None, None, Row(id=9)), (None, None, None)],
        "a string, b int, customer struct<id:int>")
    picked = df.select(coalesce_columns(df, ["a", "none", "b"], "int", [("customer", "id")])
                       .alias("v"))
    assert [r.v for r in picked.collect()] == [None, 6, 9, None]
    assert nested_field(df, "customer", "missing") is None
    assert nested_field(df, "b", "id") is None
    absent = df.select(coalesce_columns(df, ["none"], "string", default="x").alias("v"))
    assert absent.first().v == "x"


def test_defaults_fill_and_shape(spark):
    df = spark.createDataFrame([(1, None), (2, "web")], "product_id long, channel string")
    assert rows(df.select(default_literal(df, "channel", "pos").alias("c"),
                          default_literal(df, "source", "s").alias("s"))) == [
        ("pos", "s"), ("web", "s")]
    assert rows(fill_missing(df, {"channel": "?", "absent": 1}), "channel") == [("?",), ("web",)]
    schema = TABLES["dim_products"].schema
    assert set(schema.names) <= set(ensure_columns(df, schema).columns)
    shaped = conform(df, schema)
    assert shaped.schema == schema and shaped.filter("sku is not null").count() == 0
    assert rename_columns(df, {"channel": "c"}).columns == ["product_id", "c"]


def test_line_total(spark):
    df = spark.createDataFrame(
        [(None, 2.0, 120000.0), (5.0, 2.0, 9.0), (None, None, 3.0)],
        "t double, q double, p double").selectExpr("cast(t as decimal(18,2)) t", "q",
                                                   "cast(p as decimal(18,2)) p")
    out = df.selectExpr(f"{line_total_sql('t', 'q', 'p')} as v").collect()
    assert [float(r.v) for r in out] == [240000.0, 5.0, 0.0]


def test_keys(spark):
    df = spark.createDataFrame(
        [("ORD-1", "TXN-1", "2026-04-01 23:59:59"), ("ORD-2", None, "bad")],
        "o string, t string, at string")
    assert rows(surrogate_key(df, ["o", "t"], "k"), "k") == [("ORD-1_TXN-1",), ("ORD-2_",)]
    assert surrogate_key(df, ["o", "absent"]).columns == df.columns
    assert rows(date_key(df, "at"), "date_key") == [(None,), (dt.date(2026, 4, 1),)]
    assert date_key(df, "absent").columns == df.columns
