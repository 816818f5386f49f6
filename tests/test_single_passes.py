"""Work that must be done once: plans that repeated it would grow with the rows."""

import pytest
from frames import rows
from pyspark.sql import functions as F

from bazaarlake.functions.names import FEED_COPIES, FEED_POSITION, snake
from bazaarlake.operators.dedupe import keep_first, keep_first_counted
from bazaarlake.operators.explode import explode_items
from bazaarlake.operators.quality import amount_profile
from bazaarlake.plans import facts
from bazaarlake.sources import feeds
from checks import registry


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_names_and_lines_of_a_row_are_made_once(spark, put):
    root = put("shopify/orders_batch.json.gz", {"orders": [
        {"id": 1, "lineItems": [{"variantId": 7, "price": {"VND": 5}}], "X": None}]})
    raw = feeds.scan_shopify_orders(spark, root)
    made = plan(facts.fact_order_items(raw, unique=False))
    assert made.count("map_values(lambda") <= 2  # the braces of a line, in one expression
    assert made.count("map_entries(raw") == 1
    assert rows(facts.fact_order_items(raw), "order_key", "product_id") == [("1_", 7)]


def test_likely_spellings_give_the_names_that_patterns_give(spark, put, monkeypatch):
    names = ["orderId", "Order ID", "A--b", "__x", "VND", "line1", "Kelvin", "a_b"]
    root = put("shopify/orders_batch.json.gz", [
        None, {}, {"only": None}, *[{n: i} for i, n in enumerate(names)]])
    expected = sorted((snake(n), str(i)) for i, n in enumerate(names))
    for likely in (64, 2):
        monkeypatch.setattr(feeds, "_LIKELY", likely)
        documents = feeds.read_json_gz(spark, root, "orders")
        named = feeds.unwrap_envelope(documents).select(F.explode("fields").alias("k", "v"))
        assert sorted(map(tuple, named.collect())) == expected


def test_lists_without_rows_and_single_work(spark):
    df = spark.sql("SELECT 1 AS id, array(named_struct('a', 1)) AS given, 0 AS feed_position "
                   "UNION ALL SELECT 2, array(), 0 UNION ALL SELECT 3, null, 0")
    made = df.withColumn("items", F.transform("given", lambda x: F.struct(
        F.sha2(x.a.cast("string"), 256).alias("a"))))
    out = explode_items(made, "items", ["id"])
    assert plan(out).count("sha2(") == 3  # one per branch of the union
    assert [r.parent_id for r in out.collect()] == [1]


def test_profile_passes_read_a_copy(spark):
    df = spark.createDataFrame([("a", 1, 5.0), ("a", 2, 9.0), ("b", 3, 7.0), ("c", 4, None)],
                               f"k string, {FEED_POSITION} int, amount double")
    profile = amount_profile(keep_first(df, ["k"]), ["amount", "amount", "absent"])
    assert "Window" not in plan(profile) and profile.first()["median"] == 6.0


def test_counted_rows_send_keys_and_places_once(spark):
    df = spark.createDataFrame(
        [("x", 2, "a", 2), ("w", 1, "a", 1), ("y", 3, None, 3), ("z", 4, None, 4)],
        f"v string, {FEED_POSITION} int, `k` string, n int")
    found = keep_first_counted(df, ["k"])
    assert found.columns == ["v", FEED_POSITION, "k", "n", FEED_COPIES]
    assert rows(found) == sorted([("w", 1, "a", 1, 2), ("y", 3, None, 3, 2)], key=repr)
    short = plan(found.drop(FEED_POSITION))
    assert f"min({FEED_POSITION}" not in short and f"struct(v, v#" not in short
    assert rows(keep_first_counted(df.select("k", FEED_POSITION), ["k"])) == sorted(
        [("a", 1, 2), (None, 3, 2)], key=repr)


def test_report_takes_bounds_from_written_facts(spark, tmp_path, monkeypatch):
    class Stop(Exception):
        pass

    class Source:
        def raw(self):
            return {}

        def new_root(self):
            return str(tmp_path)

    def dims(raw, made, **options):
        assert all(df.inputFiles() for df in made.values())
        raise Stop

    monkeypatch.setattr(registry.facts, "build_facts",
                        lambda raw, counted: {"fact_orders": spark.range(3)})
    monkeypatch.setattr(registry.dimensions, "build_dimensions", dims)
    with pytest.raises(Stop):
        registry.quality_report(Source())
