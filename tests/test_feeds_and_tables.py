"""Reading gzip JSON feeds, writing tables, and a whole run."""

import gzip

import pytest
from frames import rows, when

from bazaarlake.operators.quality import negative_amounts
from bazaarlake.plans.warehouse import load_warehouse
from bazaarlake.session import shared_folder, write_and_read
from bazaarlake.sinks import tables
from bazaarlake.sources import feeds


def test_customers_filter_and_envelopes(spark, put):
    put("shared/customers/customer_batch_001.json.gz", {"customers": [{"id": 1}, {"id": 2}]})
    put("shared/customers/Customer_batch_002.json.gz", [{"id": "3", "name": "C"}])
    put("shared/customers/other.json.gz", [{"id": 9}])
    put("shared/customers/readme.txt", b"no")
    root = put("shared/customers/customer_bad.json.gz", b"not gzip")
    assert rows(feeds.scan_customers(spark, root), "id") == [("1",), ("2",), ("3",)]
    listed = [r.path.rsplit("/", 1)[1] for r in feeds.list_feed(spark, root, "shared/").collect()]
    assert len(listed) == 4 and all(p.endswith(".json.gz") for p in listed)


def test_customers_fall_back_to_all_files(spark, put):
    put("shared/customers/batch_001.json.gz", {"customers": [{"id": 1}]})
    root = put("shared/customers/batch_002.json.gz", {"id": 2})
    assert rows(feeds.scan_customers(spark, root), "id") == [("1",), ("2",)]


def test_shopify_reads_order_batches_only(spark, put):
    put("shopify/orders_batch_001.json.gz",
        {"orders": [{"id": 1, "customer": {"id": 5}, "lineItems": [{"variantId": 3}]}]})
    put("shopify/orders_batch_002.json.gz", [{"id": "2"}])
    put("shopify/orders_batch_003.json.gz", gzip.compress(b"{broken"))
    root = put("shopify/staff.json.gz", {"staff": [{"id": 7, "location": {"id": 4}}]})
    assert rows(feeds.scan_shopify_orders(spark, root), "id", "customer.id") == [
        ("1", "5"), ("2", None)]
    assert rows(feeds.scan_shopify_staff(spark, root), "id", "location.id") == [("7", "4")]


def test_sapo_file_names(spark, put):
    put("sapo/orders.json.gz", {"orders": [{"code": "A"}]})
    put("sapo/transactions.json.gz", {"transactions": [{"id": 1}]})
    root = put("sapo/order_locations.json.gz", {"orders": [{"code": "B"}]})
    assert rows(feeds.scan_sapo_orders(spark, root), "code") == [("A",)]
    assert rows(feeds.scan_payments(spark, root, "sapo"), "id") == [("1",)]


def test_payments_and_missing_or_broken_feeds(spark, put):
    put("momo/transactions.json.gz", [{"transId": 1, "resultCode": 0, "amount": 5}])
    root = put("odoo/transactions.json.gz", b"broken")
    found = feeds.scan_all_payments(spark, root)
    assert found["momo"].first().result_code == "0"
    assert found["odoo"].count() == 0 and found["paypal"].count() == 0
    with pytest.raises(ValueError):
        feeds.scan_payments(spark, root, "stripe")


def test_first_row_wins_by_file_name_then_place(spark, put):
    from bazaarlake.plans.facts import fact_orders

    put("shopify/orders_batch_002.json.gz", [{"id": 1, "status": "late"}])
    root = put("shopify/orders_batch_001.json.gz",
               {"orders": [{"id": 1, "status": "first"}, {"id": 1, "status": "second"}]})
    out = fact_orders(feeds.scan_shopify_orders(spark, root))
    assert rows(out, "status") == [("first",)]


def test_write_modes(spark, schema):
    df = spark.createDataFrame([(1, when("2026-01-01 05:00")), (2, None)], "id long, at timestamp")
    assert tables.write_table(df, schema, "t", " write_truncate ", "at", ["id"]) == 2
    assert tables.write_table(df, schema, "t", "WRITE_APPEND", "at", ["id"]) == 2
    table = spark.table(f"{schema}.t")
    assert table.count() == 4
    assert [c.name for c in spark.catalog.listColumns(f"{schema}.t") if c.isPartition] == ["at_day"]
    for wrong in ({"mode": "WRITE_SOME"}, {"partition_by": "none"}, {"cluster_by": ["none"]},
                  {"mode": "WRITE_EMPTY"}):
        with pytest.raises(ValueError):
            tables.write_table(df, schema, "t", **wrong)
    with pytest.raises(ValueError):
        tables.write_table(df.limit(0), schema, "new")
    assert tables.write_table(df, schema, "fresh", "WRITE_EMPTY") == 2
    assert [r.n for r in tables.run_sql(spark, f"select count(*) n from {schema}.t where id = :i",
                                        {"i": 1})] == [2]


def test_loads_always_make_day_folders(spark, schema):
    df = spark.createDataFrame([("e", "s", when("2026-01-01"))],
                               "event_id string, session_id string, event_timestamp timestamp")
    from bazaarlake.plans.facts import fact_cart_events
    from bazaarlake.functions.names import FEED_POSITION

    events = fact_cart_events(df).drop(FEED_POSITION)
    for mode in ("WRITE_TRUNCATE", "WRITE_APPEND"):
        tables.load_tables({"fact_cart_events": events}, schema, mode)
        columns = spark.catalog.listColumns(f"{schema}.fact_cart_events")
        assert [c.name for c in columns if c.isPartition] == ["event_date_key"]
    day = spark.table(f"{schema}.fact_cart_events").filter("event_date_key = date'2026-01-01'")
    assert day.count() == 2
    assert "PartitionFilters: [isnotnull(event_date_key" in day._jdf.queryExecution().toString()


def test_a_hot_day_and_customer_become_several_files(spark, schema):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "50k")
    try:
        df = spark.range(60_000, numPartitions=6).selectExpr(
            "id", "7L AS customer", "date'2026-01-01' AS day", "md5(string(id)) AS text")
        tables.write_table(df, schema, "hot", "WRITE_TRUNCATE", "day", ["customer"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = spark.table(f"{schema}.hot").select("_metadata.file_path").distinct().count()
    assert files > 4 and spark.table(f"{schema}.hot").count() == 60_000


def test_lost_part_of_an_intermediate_table_raises(spark, tmp_path):
    df = write_and_read(spark.range(100).repartition(4), "part", str(tmp_path))
    next((tmp_path).glob("part-*/part-*.parquet")).unlink()
    with pytest.raises(Exception, match="(?i)not.exist|not found|FAILED_READ_FILE"):
        df.agg({"id": "sum"}).collect()


def test_every_spelling_and_depth_is_kept(spark, put):
    from bazaarlake.plans.facts import fact_order_items, fact_orders

    root = put("shopify/orders_batch_1.json.gz", {"orders": [
        {"Order ID": 9, "Total-VND": 5.25, "CreatedAt": "2026-01-02", "Gift Note": "hi",
         "CustomerId": 3, "extra": {"a": [1]},
         "Line Items": [{"Variant ID": 4, "Qty": 2, "price": {"vnd": 10, "deep": {"er": {"X": 1}}}},
                        {"product": {"id": 6}, "Amount VND": 7}]},
        {"code": 10, "order_id": None, "amountVND": "3", "orderID": "11"}, {}, {"note": None}]})
    raw = feeds.scan_shopify_orders(spark, root)
    assert rows(fact_orders(raw), "order_id", "customer_id", "total_vnd") == sorted(
        [("9", 3, __import__("decimal").Decimal("5.25")),
         ("11", None, __import__("decimal").Decimal("3.00"))], key=repr)
    first = raw.filter("order_id = '9'").first()
    assert first.other_fields == {"gift_note": "hi", "extra": '{"a":[1]}'}
    assert first.line_items[0].other_fields == {"price_deep_er_x": "1"}
    items = {r.product_id: r for r in fact_order_items(raw).collect()}
    assert float(items[4].unit_price_vnd) == 10 and float(items[4].line_total_vnd) == 20
    assert float(items[6].line_total_vnd) == 7


def test_lines_nested_at_any_depth(spark, put):
    from bazaarlake.plans.facts import fact_order_items

    deep = {"vnd": 30}
    for name in ("Price", "unit"):
        deep = {name: deep}
    far = {"x": "end"}
    for n in range(9):
        far = {f"L{n}": far}
    root = put("shopify/orders_batch_1.json.gz", {"orders": [{"id": 1, "line_items": [
        {"variantId": 4, "qty": 2, "a": {"b": {"c": {"d": {"e": {"F": 6}}}}}, **deep},
        {"id": 5, "far": far, "two": {"p": {"q": 1}, "r": {"s": "{"}}, "none": None},
        {"id": 6}, {}]}]})
    lines = feeds.scan_shopify_orders(spark, root).first().line_items
    assert lines[0].other_fields == {"a_b_c_d_e_f": "6", "unit_price_vnd": "30"} or (
        lines[0].unit_price_vnd == "30" and lines[0].other_fields == {"a_b_c_d_e_f": "6"})
    assert lines[1].other_fields["far_" + "_".join(f"l{n}" for n in range(8, -1, -1)) + "_x"] == "end"
    assert lines[1].other_fields["two_p_q"] == "1" and lines[1].other_fields["two_r_s"] == "{"
    items = {r.product_id: r for r in fact_order_items(feeds.scan_shopify_orders(
        spark, root)).collect()}
    assert float(items[4].line_total_vnd) == 60 and set(items) == {4, 5, 6, None}


def test_events_keep_microseconds(spark, put):
    from bazaarlake.plans.facts import fact_cart_events

    root = put("cart_tracking/cart_events.json.gz", {"events": [
        {"id": "E1", "session": "S", "timestamp": "2026-03-29T00:00:07.179575Z"},
        {"id": "E2", "session": "S", "timestamp": "2026-03-29 00:00:07.000001"}]})
    out = fact_cart_events(feeds.scan_cart_events(spark, root))
    assert rows(out, "event_id", "event_timestamp") == [
        ("E1", when("2026-03-29 00:00:07.179575")), ("E2", when("2026-03-29 00:00:07.000001"))]


def test_files_without_rows_have_a_reason(spark, put):
    whole = gzip.compress(b'{"customers": [' + b'{"id": 1},' * 5000 + b'{"id": 2}]}')
    put("shared/customers/customer_ok.json.gz", {"customers": [{"id": 1}]})
    put("shared/customers/customer_empty.json.gz", b"")
    put("shared/customers/customer_text.json.gz", b"plain text")
    put("shared/customers/customer_cut.json.gz", whole[:len(whole) // 2])
    put("shared/customers/customer_json.json.gz", gzip.compress(b"{broken"))
    root = put("shared/customers/customer_none.json.gz", {"customers": []})
    scanned = feeds.scan_customers(spark, root)
    found = {r.path.rsplit("customer_", 1)[1][:4]: r.reason
             for r in feeds.skipped_files(spark, root, "shared/customers", scanned).collect()}
    assert found == {"empt": "empty file", "text": "not gzip", "cut.": "broken archive",
                     "json": "not JSON", "none": "no rows"}
    gone = feeds.reasons(spark, [f"file:{root}/shared/customers/customer_gone.json.gz"]).first()
    assert gone.reason == "vanished" and feeds.reasons(spark, []).count() == 0


def _saved_facts(spark, schema, day_folders):
    from bazaarlake.plans.facts import fact_orders

    raw = spark.createDataFrame([(n, f"2026-0{n % 3 + 1}-05 10:00") for n in range(9)] + [(99, None)],
                                "id long, created_at string").coalesce(1)
    tables.load_tables({"fact_orders": fact_orders(raw).drop("feed_position")}, schema,
                       day_folders=day_folders)


def test_bounds_of_day_folders_read_no_rows(spark, schema):
    from bazaarlake.plans.dimensions import date_bounds_from_tables

    found = []
    for folders in (True, False):
        _saved_facts(spark, schema, folders)
        bounds = date_bounds_from_tables(spark, schema)
        plan = bounds._jdf.queryExecution().optimizedPlan().toString()
        assert ("Relation" in plan) != folders
        found.append([tuple(map(str, r)) for r in bounds.collect()])
    assert found[0] == found[1] == [("2026-01-05", "2026-03-05")]


def test_compaction_rewrites_crowded_days_only(spark, schema):
    df = spark.range(40).selectExpr("id", "CASE WHEN id % 5 < 4 THEN date_add(date'2026-01-01', "
                                    "int(id % 5)) END AS day", "string(id) AS text")
    tables.write_table(df, schema, "t", "WRITE_TRUNCATE", "day", ["id"])
    for _ in range(2):
        tables.write_table(df.filter("id % 5 IN (1, 4)"), schema, "t", "WRITE_APPEND", "day")
    target, file = f"{schema}.t", "_metadata.file_path"
    files = {str(r.day): r.files for r in tables.day_files(spark, target).collect()}
    assert files == {"2026-01-01": 1, "2026-01-02": 3, "2026-01-03": 1, "2026-01-04": 1, "None": 3}
    before = {r[0] for r in spark.table(target).filter("id % 5 NOT IN (1, 4)").select(file).collect()}
    kept = rows(spark.table(target))
    assert tables.compact_days(spark, schema, "t", ["id"]) == 2
    spark.catalog.refreshTable(target)
    assert rows(spark.table(target)) == kept and len(kept) == 72
    assert {r.files for r in tables.day_files(spark, target).collect()} == {1}
    assert before == {r[0] for r in spark.table(target).filter(
        "id % 5 NOT IN (1, 4)").select(file).collect()}
    assert tables.compact_days(spark, schema, "t") == 0
    tables.write_table(df, schema, "flat")
    with pytest.raises(ValueError):
        tables.compact_days(spark, schema, "flat")


def test_upsert_rewrites_matched_folders_only(spark, schema):
    from bazaarlake.plans.dimensions import dim_customers

    raw = spark.createDataFrame(
        [(1, "2026-01-01"), (2, "2026-01-01"), (3, "2026-01-02"), (4, "2026-01-03"), (5, None)],
        "id long, created_at string").coalesce(1)
    tables.load_tables({"dim_customers": dim_customers(raw).drop("feed_position")}, schema)
    orders = spark.createDataFrame(
        [(2, "a", when("2026-02-01"), 7), (5, "b", when("2026-02-02"), 8), (9, "c", None, 1)],
        "customer_id long, order_key string, order_date timestamp, total_vnd long")
    orders.withColumn("total_vnd", orders["total_vnd"].cast("decimal(18,2)")).write.saveAsTable(
        f"{schema}.fact_orders")
    target = spark.table(f"{schema}.dim_customers")
    file = "_metadata.file_path"
    before = {r.customer_id: r.file_path for r in target.select("customer_id", file).collect()}
    assert tables.update_customer_aggregates(spark, schema) == 2
    spark.catalog.refreshTable(f"{schema}.dim_customers")
    target = spark.table(f"{schema}.dim_customers")
    after = {r.customer_id: r.file_path for r in target.select("customer_id", file).collect()}
    assert after.keys() == before.keys() == {1, 2, 3, 4, 5}
    assert {c for c in after if after[c] == before[c]} == {3, 4}
    assert rows(target, "customer_id", "total_orders") == [(1, 0), (2, 1), (3, 0), (4, 0), (5, 1)]


def test_skipped_files_are_named(spark, put):
    put("shared/customers/customer_1.json.gz", {"customers": [{"id": 1}]})
    put("shared/customers/customer_2.json.gz", b"broken")
    root = put("shared/customers/customer_3.json.gz", gzip.compress(b"{broken"))
    scanned = feeds.scan_customers(spark, root)
    assert scanned.count() == 1
    missed = feeds.skipped_files(spark, root, "shared/customers", scanned).collect()
    assert [r.path[-10:-8] for r in missed] == ["_2", "_3"] or len(missed) == 2
    report = feeds.feed_report(spark, root, {"customers": scanned}).first()
    assert (report.row_count, report.column_count, len(report.skipped)) == (1, 1, 2)


def test_write_and_read_cuts_the_lineage(spark, tmp_path):
    df = write_and_read(spark.range(3).toDF("id"), "n", str(tmp_path))
    assert df.count() == 3 and shared_folder(spark)
    class Cluster:
        class conf:  # noqa: N801
            get = staticmethod(lambda name, default=None: "/shared/")

    assert shared_folder(Cluster) == "/shared"


def _feeds(put):
    put("shared/customers/customer_batch.json.gz", {"customers": [
        {"id": 501, "email": "a@x", "name": "A", "createdAt": "2026-01-01", "phone": None},
        {"id": 502, "email": "b@x", "name": "B", "customer_segment": "new"}]})
    put("shared/products.json.gz", [{"id": 1, "name": "P"}, {"id": 2, "name": "Q"}])
    put("shopify/orders_batch_001.json.gz", {"orders": [{
        "id": "SHP-1", "transaction_code": "T1", "customer": {"id": 501},
        "created_at": "2026-04-01T10:00:00Z", "amount_vnd": 250000,
        "line_items": [{"variant_id": 1, "quantity": 2, "price_vnd": 100000},
                       {"variant_id": 2, "quantity": 1, "price_vnd": 50000}]}]})
    put("online_orders/online_orders.json.gz", {"orders": [{
        "code": "ONL-1", "txn_id": "T2", "customer_id": 501, "created_on": "2026-04-02",
        "grand_total_vnd": 9000000, "line_items": [{"item_id": 1, "qty": 1, "price": 5}]}]})
    put("momo/transactions.json.gz", {"transactions": [{
        "txn_id": "T1", "reference_id": "SHP-1", "resultCode": 0, "amount": 250000,
        "paid_at": "2026-04-03T00:00:00Z"}]})
    return put("cart_tracking/cart_events.json.gz", {"events": [{
        "id": "E1", "session": "S", "customer_id": 501, "type": "view",
        "timestamp": "2026-03-29T00:00:00Z", "channel": "ads"}]})


def test_whole_run(spark, put, schema):
    root = _feeds(put)
    load = load_warehouse(spark, root, schema, now="2026-12-31")
    assert load.summary == {
        "dim_customers": 2, "dim_products": 2, "dim_locations": 0, "dim_date": 6,
        "fact_orders": 2, "fact_order_items": 3, "fact_payments": 1, "fact_cart_events": 1,
        "fact_bank_transactions": 0, "dim_customers_aggregate_updates": 1, "analysis_views": 3}
    customers = {r.customer_id: r for r in spark.table(f"{schema}.dim_customers").collect()}
    assert (customers[501].customer_segment, customers[501].total_orders) == ("loyal", 2)
    assert customers[502].customer_segment == "new"
    journey = spark.table(f"{schema}.vw_customer_journey").first()
    assert (journey.customer_id, journey.touchpoint_sequence) == (501, "ads:view")
    assert not spark.catalog.tableExists(f"{schema}.fact_bank_transactions")
    assert load.quality.filter("metric = 'duplicate_count'").count() == 9
    assert load.feeds["shopify_orders"] == {"rows": 1, "columns": 6, "skipped": []}
    assert load.feeds["payments.odoo"]["rows"] == 0
    put("shopify/orders_batch_002.json.gz", {"orders": [{"id": "N", "amount_vnd": -5}]})
    put("momo/transactions.json.gz", b"broken")
    again = load_warehouse(spark, root, schema)
    negative = negative_amounts(again.quality).collect()
    assert [(r.table_name, r.column_name, r.value) for r in negative] == [
        ("fact_orders", "total_vnd", "1")]
    assert again.summary["fact_payments"] == 0
    assert again.summary["fact_orders"] == 3 and spark.table(f"{schema}.fact_orders").count() == 3


def test_run_without_orders_skips_aggregates(spark, put, schema):
    root = put("shared/products.json.gz", [{"id": 1, "name": "P"}])
    load = load_warehouse(spark, root, schema, start_date="2026-01-01", end_date="2026-01-02")
    assert load.summary["dim_customers_aggregate_updates"] == 0
    assert load.summary["dim_date"] == 2 and load.summary["analysis_views"] == 0
