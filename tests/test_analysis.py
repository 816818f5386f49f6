"""Journey, sankey, cashflow, payment status, aggregates and quality, with edge cases."""

import datetime as dt
import random
import statistics
from decimal import Decimal

import pytest
from frames import rows, when
from pyspark.sql import functions as F

from bazaarlake.operators import dedupe, quality, quantiles
from bazaarlake.operators.touchpoints import (
    join_chunks,
    ordered_touchpoints,
    sequence_chunks,
    touchpoint_sequence,
)
from bazaarlake.operators.upsert import customer_aggregates, matched_customers
from bazaarlake.plans import finance, journey, views
from bazaarlake.schemas import TABLES

_EVENT = "customer_id long, event_timestamp timestamp, source string, event_type string"
_ORDER = "customer_id long, order_key string, order_date timestamp, total_vnd long"


def _money(df, column):
    return df.withColumn(column, df[column].cast("decimal(18,2)"))


def _events(spark, data):
    return spark.createDataFrame(data, _EVENT)


def _orders(spark, data):
    return _money(spark.createDataFrame(data, _ORDER), "total_vnd")


def _random_events(seed):
    pick = random.Random(seed)
    data = []
    for _ in range(400):
        at = None if pick.random() < 0.1 else when("2026-01-01") + dt.timedelta(
            seconds=pick.choice([0, 0, 0, 30, 60, 61, 7200]))
        data.append((pick.choice([1, 1, 1, 2, 3, None]), at, pick.choice(["ads", "email", None]),
                     pick.choice(["view", "click", None])))
    return data


def _brute(data):
    """Numbered touches by plain sorting, nulls first."""
    out, customers = [], {c for c, *_ in data if c is not None}
    for customer in customers:
        mine = sorted(
            ((at, s or "unknown", e or "unknown") for c, at, s, e in data if c == customer),
            key=lambda t: (t[0] is not None, t[0] or when("1970-01-01"), t[1], t[2]))
        for i, (at, channel, kind) in enumerate(mine):
            after = mine[i + 1][1] if i + 1 < len(mine) else None
            out.append((customer, at, channel, kind, i + 1, after, len(mine)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("rows_per_task", [1_000_000, 1])
def test_ordering_agrees_with_brute_force(spark, rows_per_task):
    data = _random_events(3)
    out = ordered_touchpoints(_events(spark, data), rows_per_task)
    assert rows(out) == _brute(data)


def test_sequence_same_for_heavy_customers(spark):
    events = _events(spark, _random_events(4))
    plain, heavy = (rows(touchpoint_sequence(events, n)) for n in (1_000_000, 1))
    assert plain == heavy and len(plain) == 3
    tiny = _events(spark, [(1, when("2026-01-02"), "b", "x"), (1, when("2026-01-01"), None, None)])
    assert touchpoint_sequence(tiny).first().touchpoint_sequence == "unknown:unknown > b:x"


@pytest.mark.parametrize("rows_per_task", [1_000_000, 1])
def test_chunks_join_to_the_sequence(spark, rows_per_task):
    events = _events(spark, _random_events(6))
    chunks = sequence_chunks(events, 7, rows_per_task)
    sizes = {(r.customer_id, r.chunk): r.touches for r in chunks.collect()}
    assert max(sizes.values()) == 7 and len(sizes) > 40
    assert all(n == 7 for (c, k), n in sizes.items() if (c, k + 1) in sizes)
    assert rows(join_chunks(chunks)) == rows(touchpoint_sequence(events))
    orders = _orders(spark, [(1, "a", when("2026-01-01"), 5)])
    wide = journey.customer_journey_chunks(events, orders, 7)
    assert wide.count() == len(sizes) and wide.filter("total_orders = 1").count() == sum(
        c == 1 for c, _ in sizes)


def test_sketches_unite_over_days(spark):
    events = spark.range(60_000).selectExpr(
        "id % 20000 AS customer_id", "timestamp'2026-01-01' + make_interval(0, 0, 0, int(id % 7)) "
        "AS event_timestamp", "'ads' AS source", "'view' AS event_type")
    sketches = journey.touch_customer_sketches(events)
    assert sketches.count() == 7
    for first, last in ((None, None), ("2026-01-02", "2026-01-03"), ("2026-01-07", None)):
        kept = events if first is None else events.filter(f"event_timestamp >= '{first}'")
        kept = kept if last is None else kept.filter(f"event_timestamp <= '{last}'")
        exact = journey.total_touch_customers(kept).first()[0]
        rough = journey.approximate_touch_customers(sketches, first, last).first()[0]
        assert abs(rough - exact) <= 0.03 * exact
    assert journey.approximate_touch_customers(sketches, "2030-01-01").first()[0] == 0


def test_sankey_reads_events_once_per_way(spark, tmp_path):
    """The total comes from the edge counts: no further scan of events or distinct count."""
    path = str(tmp_path / "events")
    _events(spark, _random_events(8)).write.parquet(path)
    events = spark.read.parquet(path)
    out = journey.customer_journey_sankey(events, _orders(spark, []))
    assert out.first().total_customers == 3
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("distinct") == 0


def test_run_of_copies_is_unfolded_in_pieces(spark, monkeypatch):
    from bazaarlake.operators import touchpoints

    monkeypatch.setattr(touchpoints, "_PIECE", 3)
    data = [(1, when("2026-01-01"), "ads", "view")] * 10 + [(1, when("2026-01-02"), "mail", "x")]
    assert rows(ordered_touchpoints(_events(spark, data), 1)) == _brute(data)


def test_sankey_edge_kinds(spark):
    day = [when(f"2026-01-0{n}") for n in range(1, 6)]
    events = _events(spark, [
        (1, day[1], "ads", "v"), (2, day[1], "ads", "v"), (3, day[0], "ads", "v"),
        (3, day[1], None, "v"), (4, None, "ads", "v"), (5, None, "ads", "v")])
    orders = _orders(spark, [
        (1, "a", day[3], 1), (2, "b", day[0], 1), (4, "c", day[2], 1), (None, "d", day[2], 1)])
    edges = journey.customer_edges(events, orders)
    assert rows(edges, "customer_id", "source_stage_number", "target_channel", "edge_type") == [
        (1, 1, "purchase", "purchase"), (2, 1, "drop_off", "drop_off"),
        (3, 1, "unknown", "touchpoint"), (3, 2, "drop_off", "drop_off"),
        (5, 1, "drop_off", "drop_off")]
    out = journey.customer_journey_sankey(events, orders)
    assert rows(out) == rows(journey.customer_journey_sankey(events, orders, 0))
    first = out.filter("edge_type = 'purchase'").first()
    assert (first.customer_count, first.source_stage_customer_count, first.total_customers) == (
        1, 4, 5)
    assert first.pct_of_source_stage == 0.25
    assert rows(journey.stage_totals(events, orders)) == [
        (1, "Touch 01 - ads", 4), (2, "Touch 02 - unknown", 1)]
    assert journey.total_touch_customers(events).first()[0] == 5


def test_stage_100_label_is_cut_to_two_characters(spark):
    events = _events(spark, [
        (1, when("2026-01-01") + dt.timedelta(minutes=n), "ads", "v") for n in range(101)])
    edges = journey.customer_edges(events, _orders(spark, []))
    assert edges.filter("source_stage_number = 100").first().source_stage_label == "Touch 10"


def test_journey_joins_purchases(spark):
    events = _events(spark, [(1, when("2026-01-01"), "ads", "view"), (2, None, "ads", "view")])
    orders = _orders(spark, [(1, "a", when("2026-01-05"), 10), (1, "a", when("2026-01-03"), None)])
    out = {r.customer_id: r for r in journey.customer_journey(events, orders).collect()}
    assert out[1].total_orders == 1 and out[1].total_revenue_vnd == 10
    assert out[1].first_purchase_time == when("2026-01-03") and out[2].total_orders is None


def test_cashflow_keeps_a_zero_row_for_missing_dates(spark):
    day = dt.date(2026, 1, 1)
    orders = _money(spark.createDataFrame(
        [(day, 100), (None, 7)], "order_date_key date, total_vnd long"), "total_vnd")
    payments = _money(spark.createDataFrame(
        [(day, 60), (day, None)], "payment_date_key date, amount_vnd long"), "amount_vnd")
    bank = _money(spark.createDataFrame(
        [(day, -20), (day, 5), (None, 3)], "transaction_date_key date, amount_vnd long"),
        "amount_vnd")
    out = {r.activity_date: r for r in finance.cashflow_daily(orders, payments, bank).collect()}
    assert tuple(out[day])[1:] == tuple(map(Decimal, (100, 60, 5, -20, 45)))
    assert tuple(out[None])[1:] == tuple(map(Decimal, (0, 0, 0, 0, 0)))
    assert rows(finance.union_distinct_dates(orders, payments, bank)) == [(None,), (day,)]


def test_payment_status_cases(spark):
    at = when("2026-05-01 10:00")
    orders = _money(spark.createDataFrame(
        [("o1", "T1", at, 100), ("o2", "T2", at, 100), ("o3", None, at, 100),
         ("o4", "T4", when("2026-05-27"), 100), ("o5", "T5", at, 100), ("o6", "T6", at, 100)],
        "order_key string, transaction_id string, order_date timestamp, total_vnd long"),
        "total_vnd")
    for name in ("order_id", "status"):
        orders = orders.selectExpr("*", f"'x' as {name}")
    orders = orders.selectExpr("*", "1L as customer_id")
    payments = _money(spark.createDataFrame(
        [("T1", "paid", at + dt.timedelta(minutes=59), 60),
         ("T2", "Pending", at - dt.timedelta(minutes=90), 150), ("T2", "error", at, 0),
         (None, "paid", at, 100), ("T5", "failed", None, None), ("T6", "refunded", at, 1)],
        "transaction_id string, payment_status string, payment_date timestamp, "
        "amount_vnd long"), "amount_vnd").selectExpr(
            "*", "'k' as payment_key", "'g' as payment_gateway", "'m' as payment_method")
    out = finance.payment_status(orders, payments, "2026-06-01")
    got = rows(out, "order_key", "payment_delay_hours", "outstanding_amount",
               "payment_status_category")
    assert got == [
        ("o1", 0, Decimal("40.00"), "Paid"), ("o2", -1, Decimal("0.00"), "Pending"),
        ("o2", 0, Decimal("100.00"), "Failed"), ("o3", None, Decimal("100.00"), "Overdue"),
        ("o4", None, Decimal("100.00"), "Pending"), ("o5", None, Decimal("100.00"), "Overdue"),
        ("o6", 0, Decimal("99.00"), "Pending")]


def test_customer_segments(spark):
    customers = spark.createDataFrame(
        [(n, "new", 0) for n in range(1, 7)], "customer_id long, customer_segment string, "
        "total_orders long")
    for f in TABLES["dim_customers"].schema:
        if f.name not in customers.columns:
            customers = customers.selectExpr("*", f"cast(null as {f.dataType.simpleString()}) "
                                             f"as {f.name}")
    at = when("2026-01-01")
    orders = _orders(spark, [(1, "a", at, 10_000_000)] + [(2, f"b{n}", at, 1) for n in range(10)]
                     + [(3, f"c{n}", at, 1) for n in range(5)] + [(4, "d", at, None)]
                     + [(5, "e", at, 5_000_000)])
    out = {r.customer_id: r for r in customer_aggregates(customers, orders).collect()}
    assert {n: r.customer_segment for n, r in out.items()} == {
        1: "vip", 2: "vip", 3: "loyal", 4: "active", 5: "loyal", 6: "new"}
    assert out[2].total_orders == 10 and out[6].total_orders == 0
    assert matched_customers(customers, orders).first()[0] == 5


def test_quality_report(spark):
    df = spark.createDataFrame(
        [("K1", "O1", "2026-04-10", 100, 1), ("K1", "O1", "2026-04-10", 100, 1),
         ("K2", "O2", "2026-05-10", -5, None)],
        "order_key string, order_id string, order_date string, amount_vnd long, "
        "customer_id long").coalesce(1)
    rules = quality.Rules(("order_key", "customer_id"), ("order_key",), ("order_date",),
                          ("amount_vnd",), min_date="2026-04-01", max_date="2026-04-30")
    kept, report = quality.data_quality_check(df, "orders", rules)
    got = {(r.section, r.column_name, r.metric): r.value for r in report.collect()}
    assert kept.count() == 2 and got[("shape", None, "row_count")] == "2"
    assert got[("duplicates", None, "duplicate_count")] == "1"
    assert got[("nulls", "customer_id", "null_count")] == "1"
    assert ("nulls", "order_key", "null_count") not in got
    assert got[("dates", "order_date", "future_dates")] == "1"
    assert got[("amounts", "amount_vnd", "negative_count")] == "1"


def test_date_profile_options(spark):
    df = spark.createDataFrame([(when("2026-04-10"),)], "d timestamp")
    past = quality.date_range_profile(df, ["d"], max_date="2020-01-01").first()
    assert past.future_dates == past.above_max_date == 1
    allowed = quality.date_range_profile(
        df, ["d", "absent"], max_date="2020-01-01", allow_future_dates=True).first()
    assert allowed.future_dates == 0 and allowed.above_max_date == 1
    none = quality.date_range_profile(df.limit(0), ["d"]).first()
    assert none.min_date is None and none.above_max_date == 0


def test_amount_profile_small_cases(spark):
    df = spark.createDataFrame(
        [(1, 5, None), (2, None, None), (3, None, None), (4, None, None), (100, None, None)],
        "many long, one long, none long")
    out = {r.column_name: r for r in quality.amount_profile(df, ["many", "one", "none"]).collect()}
    assert (out["many"].outlier_count, out["many"].median) == (1, 3.0)
    assert out["many"].std_dev == pytest.approx(statistics.stdev([1, 2, 3, 4, 100]))
    assert out["one"].std_dev == 0 and out["one"].median == 5
    assert (out["none"].negative_count, out["none"].outlier_count, out["none"].mean) == (0, 0, None)


@pytest.mark.parametrize("scale", [1, 10**7, 10**13])
def test_quartiles_agree_with_brute_force(spark, scale):
    pick = random.Random(scale)
    values = [pick.randint(-50, 200) * scale + pick.choice([0.25, 0.5]) for _ in range(101)]
    df = spark.createDataFrame([(Decimal(str(v)),) for v in values], "v decimal(18,2)")
    out = quality.amount_profile(df, ["v"]).first()
    q1, q2, q3 = statistics.quantiles(values, n=4, method="inclusive")
    reach = 1.5 * (q3 - q1)
    assert out.median == pytest.approx(q2)
    assert out.outlier_count == sum(v < q1 - reach or v > q3 + reach for v in values)
    assert out.mean == pytest.approx(statistics.fmean(values))


@pytest.mark.parametrize("seed", range(6))
def test_quantiles_of_doubles(spark, seed):
    """Thousandths, negatives, zeros, powers of two and their neighbours, and huge values."""
    import math

    pick = random.Random(seed)
    kinds = [lambda: round(pick.uniform(-50, 50), 3), lambda: pick.choice([-1, 1]) * 10.0 ** 18
             + pick.randint(0, 10**6) * 1000, lambda: 0.0,
             lambda: math.nextafter(2.0 ** pick.randint(-60, 60), pick.choice([0, math.inf])),
             lambda: 2.0 ** pick.randint(-60, 60), lambda: pick.uniform(1, 1 + 1e-12),
             lambda: pick.choice([5e-324, -5e-324, 1.7976931348623157e308, 2.2e-308])]
    used = kinds if seed < 3 else [kinds[seed - 3]] * 2
    values = [pick.choice(used)() for _ in range(pick.choice([1, 2, 57, 400]))]
    rows_ = [(v,) for v in values] + [(None,), (float("nan"),), (float("inf"),)]
    df = spark.createDataFrame(rows_, "`v x` double").repartition(3)
    ordered, shares = sorted(values), (0.0, 0.25, 0.5, 0.9, 1.0)
    want = []
    for share in shares:
        at = share * (len(ordered) - 1)
        low, high = ordered[math.floor(at)], ordered[math.ceil(at)]
        want.append(low + (high - low) * (at - math.floor(at)))
    assert quantiles.exact_quantiles(df, ["v x"], shares) == {"v x": want}


def test_images_keep_the_order(spark):
    import math

    values = sorted({s * v for k in range(-1074, 1024) for s in (-1, 1) for v in
                     (2.0 ** k, math.nextafter(2.0 ** k, 0), math.nextafter(2.0 ** k, math.inf),
                      1.5 * 2.0 ** k)} | {0.0, 1.7976931348623157e308})
    df = spark.createDataFrame([(v,) for v in values], "v double")
    images = [r.i for r in df.select("v", quantiles.order_image(F.col("v")).alias("i")).orderBy(
        "v").collect()]
    assert images == sorted(images) and len(set(images)) > 10_000


def test_quantiles_shuffle_bins_only(spark):
    """The exchange carries bins: a row of counts each, however many rows there are."""
    df = spark.range(200_000).selectExpr("id / 7 AS v")
    assert quantiles.exact_quantiles(df, ["v"], (0.5,)) == {"v": [pytest.approx(199_999 / 14)]}
    bins = quantiles._bins(df, [quantiles._cell(
        0, quantiles.order_image(quantiles.number("v")), quantiles.number("v"))])
    assert bins.count() < 20_000
    plan = bins._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_count" in plan


def test_report_takes_one_scan(spark, tmp_path):
    """Shape, nulls, dates and merged duplicates of saved rows are one aggregate."""
    path = str(tmp_path / "rows")
    raw = spark.createDataFrame(
        [("a", 1, "2026-04-01"), ("a", 2, "2026-04-02"), ("b", None, "2026-04-03"),
         (None, 4, None), (None, 5, None)], "id string, n long, at string").coalesce(1)
    dedupe.keep_first_counted(raw, ["id"]).drop("feed_position").write.parquet(path)
    rules = quality.Rules(("id", "n"), ("id",), ("at",))
    kept, report = quality.data_quality_check(spark.read.parquet(path), "t", rules,
                                              remove_duplicates=False)
    got = {(r.section, r.column_name, r.metric): r.value for r in report.collect()}
    assert kept.columns == ["id", "n", "at"] and sorted(map(str, rows(kept, "n"))) == [
        "(1,)", "(4,)", "(None,)"]
    assert got[("duplicates", None, "duplicate_count")] == "2"
    assert got[("shape", None, "row_count")] == got[("shape", None, "column_count")] == "3"
    assert got[("nulls", "id", "null_count")] == got[("nulls", "n", "null_count")] == "1"
    assert got[("dates", "at", "max_date")].startswith("2026-04-03")
    assert report._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 1


def test_run_quality_checks_passes_rows_on(spark):
    df = spark.createDataFrame([(1, "p"), (1, "q")], "product_id long, product_name string")
    run = quality.run_quality_checks({"dim_products": df.coalesce(1)})
    assert run.tables["dim_products"].count() == 1 and run.report().count() >= 3
    assert set(quality.quality_rules()) == set(TABLES) - {"dim_staff"}


def test_sql_views_match_functions(spark, schema):
    events = _events(spark, _random_events(5))
    orders = _orders(spark, [(1, "a", when("2026-01-01 00:01"), 5), (2, "b", when("2025-01-01"), 1)])
    events.write.saveAsTable(f"{schema}.fact_cart_events")
    orders.write.saveAsTable(f"{schema}.fact_orders")
    for limit in (1_000_000, 1):
        assert rows(spark.sql(views.journey_sql(schema, limit))) == rows(
            journey.customer_journey(events, orders))
        assert rows(spark.sql(views.sankey_sql(schema, limit))) == rows(
            journey.customer_journey_sankey(events, orders))
    assert views.create_views(spark, schema) == 2
