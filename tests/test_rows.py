"""Duplicates, unions, exploding, and heavy keys."""

from frames import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Row

from bazaarlake.functions.names import FEED_POSITION
from bazaarlake.operators.dedupe import (
    check_duplicates,
    combine_frames,
    duplicate_count,
    flag_duplicates,
    keep_first,
)
from bazaarlake.operators.explode import explode_items
from bazaarlake.operators.skew import heavy_keys, split_by_weight


def _frame(spark, data):
    return spark.createDataFrame(data, f"k string, v int, {FEED_POSITION} int")


def test_keep_first_follows_feed_position_and_groups_nulls(spark):
    df = _frame(spark, [("a", 1, 5), ("a", 2, 3), (None, 3, 9), (None, 4, 1), ("b", 5, 2)])
    assert rows(keep_first(df, ["k"]), "k", "v") == [("a", 2), ("b", 5), (None, 4)]
    plan = keep_first(df, ["k"])._jdf.queryExecution().toString()
    assert plan.count("WindowGroupLimit") >= 2  # limited before the exchange too


@settings(max_examples=8, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(keys=st.lists(st.sampled_from(["a", "b", "c", None]), min_size=1, max_size=12))
def test_duplicates_agree_with_brute_force(spark, keys):
    df = _frame(spark, [(k, i, i) for i, k in enumerate(keys)])
    seen, expected = set(), []
    for i, k in enumerate(keys):
        expected.append((i, k in seen))
        seen.add(k)
    flagged = flag_duplicates(df, ["k"])
    assert rows(flagged, "v", "is_duplicate") == sorted(expected, key=repr)
    assert duplicate_count(df, ["k"]).first()[0] == len(keys) - len(seen)
    assert rows(keep_first(df, ["k"]), "v") == sorted(
        ((i,) for i, dup in expected if not dup), key=repr)


def test_check_duplicates_options(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2)], "k string, v int").coalesce(1)
    kept, count = check_duplicates(df, None, remove_duplicates=True, flag_column="dup")
    assert kept.count() == 2 and count.first()[0] == 1 and kept.filter("dup").isEmpty()
    same, count = check_duplicates(df, ["k"])
    assert same.count() == 3 and count.first()[0] == 2


def test_combine_frames_first_frame_wins(spark):
    first = spark.createDataFrame([("x", 1), ("y", 1)], "k string, a int").coalesce(1)
    second = spark.createDataFrame([("y", 2), ("z", 2)], "k string, b int").coalesce(1)
    out = combine_frames([first, second], dedupe_on=["k"])
    assert rows(out, "k", "a", "b") == [("x", 1, None), ("y", 1, None), ("z", None, 2)]
    assert combine_frames([first, second]).count() == 4
    assert combine_frames([first, second], dedupe_on=["none"]).count() == 4
    other = second.selectExpr("k", "b", f"named_struct('n', b) as {FEED_POSITION}")
    assert combine_frames([first, other], dedupe_on=["k"]).count() == 3


def test_flags_without_position_leave_one_row_of_each_key(spark):
    df = spark.range(4000, numPartitions=8).selectExpr("id % 37 AS k", "id").repartition(11)
    flagged = flag_duplicates(df, ["k"])
    left = flagged.filter("NOT is_duplicate").groupBy("k").count().collect()
    assert flagged.count() == 4000 and FEED_POSITION not in flagged.columns
    assert len(left) == 37 and all(r["count"] == 1 for r in left)


def test_explode_items(spark):
    df = spark.createDataFrame(
        [("o1", [Row(id=1, x=Row(y=7)), Row(id=2, x=None)]), ("o2", []), ("o3", None)],
        "key string, items array<struct<id:int,x:struct<y:int>>>")
    out = explode_items(df, "items", ["key"])
    assert rows(out, "parent_key", "id", "x_y") == [("o1", 1, 7), ("o1", 2, None)]
    assert explode_items(df, "absent", ["key"]).count() == 0


def test_heavy_keys_bound_and_split(spark):
    df = spark.createDataFrame([(1,)] * 6 + [(2,)] * 2 + [(None,)] * 9, "k int")
    heavy = heavy_keys(df, "k", rows_per_task=3)
    assert rows(heavy) == [(1,)]
    ordinary, bulky = split_by_weight(df, heavy, "k")
    assert (ordinary.count(), bulky.count()) == (11, 6)
