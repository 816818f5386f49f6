"""Names of feed rows, the report on feeds and documents of rows, each made in few steps."""

import json

from frames import rows
from pyspark.sql import functions as F

from bazaarlake.functions.names import FEED_POSITION
from bazaarlake.sources import feeds
from checks import sample_feeds


def fields(spark, root, prefix="shopify"):
    documents = feeds.read_json_gz(spark, f"{root}/{prefix}", "orders")
    return feeds.unwrap_envelope(documents).orderBy(f"{FEED_POSITION}.row").select("fields")


def test_lists_of_names_found_once_and_others_give_the_same(spark, put, monkeypatch):
    given = [{"orderId": 1, "A b": "x"}, {"orderId": None, "A b": "y"}, None, {}, {"no": None},
             {"order_id": None, "orderId": 2}, {"Order ID": 3, "order_id": 4}, {"last": 5}]
    root = put("shopify/orders.json.gz", {"orders": given})
    expected = [{"order_id": "1", "a_b": "x"}, {"a_b": "y"}, {"order_id": "2"},
                {"order_id": "3"}, {"last": "5"}]
    for looked, likely in ((256, 64), (1, 64), (256, 1)):
        monkeypatch.setattr(feeds, "_LOOKED", looked)
        monkeypatch.setattr(feeds, "_LIKELY", likely)
        assert [r.fields for r in fields(spark, root).collect()] == expected


def test_a_name_that_comes_twice_in_a_row(spark, put):
    import gzip

    root = put("shopify/orders.json.gz", gzip.compress(
        b'[{"id": null, "id": 7, "customer": {"id": null, "ID": 8, "id": 9}}, {"id": 1}]'))
    assert [r.fields["id"] for r in fields(spark, root).collect()] == ["7", "1"]
    put("shopify/orders_batch.json.gz", gzip.compress(
        b'[{"id": 2, "customer": {"id": null, "ID": 8, "id": 9}}, {"id": 3, "customer": {}},'
        b' {"id": 4, "customer": "none"}, {"id": 5, "Customer": {"Customer Id": 6}}]'))
    raw = feeds.scan_shopify_orders(spark, root)
    assert rows(raw, "id", "customer.id", "customer.customer_id") == [
        ("2", "8", None), ("3", None, None), ("4", None, None), ("5", None, "6")]
    steps = raw._jdf.queryExecution().optimizedPlan().toString()
    assert "AS _customer#" in steps and "AS _customer_names#" in steps


def test_report_counts_names_by_plain_aggregates(spark, put):
    put("shopify/orders_batch_1.json.gz", [{"id": 1, "note": "a"}, {"id": 2, "x": None}])
    put("shopify/orders_batch_3.json.gz", b"broken")
    root = put("shopify/orders_batch_2.json.gz", [{"code": 3, "y": 1, "status": None}, {"y": 2}])
    report = feeds.feed_report(spark, root, {"orders": feeds.scan_shopify_orders(spark, root)})
    found = report.first()
    assert (found.row_count, found.column_count) == (4, 4)
    assert [p.rsplit("/", 1)[1] for p in found.skipped] == ["orders_batch_3.json.gz"]
    made = report._jdf.queryExecution().optimizedPlan().toString()
    assert made.count("collect_set(") == 1  # over groups of rows alone


def test_documents_hold_rows_in_order_after_two_exchanges(spark, tmp_path):
    df = spark.range(1000, numPartitions=7).select(
        (999 - F.col("id")).alias("n"), F.struct((999 - F.col("id")).alias("row")).alias(
            FEED_POSITION))
    made = sample_feeds.feed_documents(df, "rows", 30)
    assert made._jdf.queryExecution().executedPlan().toString().count("Exchange range") == 2
    assert "Exchange hash" not in made._jdf.queryExecution().executedPlan().toString()
    path = str(tmp_path / "feed")
    sample_feeds.write_feed(df, path, "rows", rows_per_document=30)
    read = spark.read.option("wholetext", True).text(path).select(
        "_metadata.file_name", "value").orderBy("file_name").collect()
    listed = [[x["n"] for x in json.loads(r.value)["rows"]] for r in read]
    assert max(map(len, listed)) <= 30 and sum(listed, []) == list(range(1000))
