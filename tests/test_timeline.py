import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from postline.operators import accounts, layout, timeline, upsert
from tests.plans import initial_plan

POSTS = "user string, date_creation timestamp_ntz, post_id bigint"


def at(minute):
    return dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minute)


def posts(n, seed=1):
    """Account `hot` has a third of all posts; times repeat."""
    draw = random.Random(seed)
    return [
        ("hot" if i % 3 == 0 else f"u{draw.randrange(40)}", at(draw.randrange(200)), i)
        for i in range(n)
    ]


def newest(rows, n):
    kept = []
    for user in {row[0] for row in rows}:
        own = sorted((r for r in rows if r[0] == user), key=lambda r: (r[1], r[2]), reverse=True)
        kept += own[:n]
    return sorted(kept)


@pytest.mark.parametrize("n", [1, 3, 50])
def test_newest_per_account_against_brute_force(spark, n):
    rows = posts(3000)
    frame = spark.createDataFrame(rows, POSTS).repartition(16)
    got = timeline.timeline_top_n(frame, n=n)
    assert sorted(map(tuple, got.collect())) == newest(rows, n)


def test_hot_null_account_and_null_times(spark):
    rows = [(None, at(i) if i % 4 else None, i) for i in range(400)] + [("a", None, i) for i in range(20)]
    frame = spark.createDataFrame(rows, POSTS).repartition(8)
    for n in (5, 350):
        got = timeline.timeline_top_n(frame, n=n)
        lowest = dt.datetime(1, 1, 1)
        expected = [
            row
            for user in (None, "a")
            for row in sorted(
                (r for r in rows if r[0] == user), key=lambda r: (r[1] or lowest, r[2]), reverse=True
            )[:n]
        ]
        assert set(map(tuple, got.collect())) == set(expected) and got.count() == len(expected)


def test_whole_rows_are_shuffled_once_and_cut_before(spark):
    frame = spark.createDataFrame(posts(3000), POSTS).withColumn("text", F.lit("t"))
    plan = initial_plan(timeline.timeline_top_n(frame))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "row_number(), 50, Partial" in plan.split("Exchange hashpartitioning")[1]


def test_no_limit(spark):
    frame = spark.createDataFrame(posts(300), POSTS)
    assert timeline.timeline_top_n(frame, n=None).count() == 300


def test_accounts_with_few_posts_and_null_times_are_kept(spark):
    rows = [("a", None, 1), ("a", at(1), 2), ("b", None, 3), (None, at(1), 4)]
    got = timeline.timeline_top_n(spark.createDataFrame(rows, POSTS), n=2)
    assert got.count() == 4


def test_latest_and_max_date(spark):
    days = spark.createDataFrame([(dt.date(2024, 1, 2),), (None,), (dt.date(2024, 1, 1),)], "d date")
    assert timeline.max_date(days, "d").first().d == dt.date(2024, 1, 2)
    assert timeline.latest_date(days, "d").first().d == dt.date(2024, 1, 2)
    none = days.filter("d IS NULL")
    assert timeline.latest_date(none, "d").isEmpty()
    assert timeline.max_date(none, "d").first().d is None
    assert "TakeOrderedAndProject" in initial_plan(timeline.latest_date(days, "d"))


def test_preview(spark):
    assert timeline.preview(spark.range(30)).count() == 10
    assert [r.id for r in timeline.preview(spark.range(30), ["id"], 3).collect()] == [0, 1, 2]


ACCOUNTS = [("a", 1), ("b", 2)]
ACTIVITY = "user string, retweet_count double, favorite_count double, at int"


def test_metrics_latest_row_per_account_and_none_lost(spark):
    people = spark.createDataFrame(ACCOUNTS, "user string, followers int")
    rows = [("a", 1.9, 2.9, 1), ("a", 3.9, 4.9, 2), ("z", 0.0, 0.0, 1)]
    activity = spark.createDataFrame(rows, ACTIVITY)
    got = accounts.attach_account_metrics(people, activity, newest=["at"]).orderBy("user").collect()
    assert [tuple(r) for r in got] == [("a", 1, 3, 4), ("b", 2, None, None)]
    empty = accounts.attach_account_metrics(people, activity.limit(0))
    assert empty.count() == 2 and empty.filter("retweet_count IS NOT NULL").isEmpty()


def test_single_activity(spark):
    people = spark.createDataFrame(ACCOUNTS, "user string, followers int")
    activity = spark.createDataFrame([("", 1.9, 2.9, 1), ("", 3.9, -4.9, 2)], ACTIVITY)
    got = accounts.attach_single_activity(people, activity, ["at"])
    assert sorted(map(tuple, got.collect())) == [("a", 1, 3, -4), ("b", 2, 3, -4)]
    empty = accounts.attach_single_activity(people, activity.limit(0), ["at"])
    assert sorted(map(tuple, empty.collect())) == [("a", 1, None, None), ("b", 2, None, None)]
    assert "NestedLoop" not in initial_plan(got) and "Cartesian" not in initial_plan(got)


def test_upsert_takes_the_newest_and_twice_is_once(spark):
    target = spark.createDataFrame([(1, "a", 0), (2, "b", 0)], "k int, v string, at int")
    source = spark.createDataFrame([(2, "x", 1), (3, "d", 1), (2, "c", 2)], "k int, v string, at int")
    once = upsert.upsert_by_key(target, source, ["k"], ["at"])
    twice = upsert.upsert_by_key(once, source, ["k"], ["at"])
    expected = [(1, "a", 0), (2, "c", 2), (3, "d", 1)]
    assert sorted(map(tuple, once.collect())) == expected == sorted(map(tuple, twice.collect()))


def test_upsert_refuses_a_null_key(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    with pytest.raises(Exception, match="NULL in key column k"):
        upsert.upsert_by_key(target, target.select(F.lit(None).cast("int").alias("k"), "v"), ["k"], ["v"])


def test_upsert_against_brute_force(spark):
    draw = random.Random(3)
    old = {(draw.randrange(50), draw.randrange(4)): i for i in range(300)}
    new = [(draw.choice([7, draw.randrange(70)]), draw.randrange(4), i) for i in range(300, 900)]
    target = spark.createDataFrame([(*k, v) for k, v in old.items()], "a int, b int, at int")
    source = spark.createDataFrame(new, "a int, b int, at int")
    expected = dict(old)
    for a, b, at_ in new:
        expected[a, b] = at_
    got = upsert.upsert_by_key(target, source, ["a", "b"], ["at"])
    assert sorted(map(tuple, got.collect())) == sorted((*k, v) for k, v in expected.items())


@pytest.mark.parametrize("n, start, partitions", [(0, 1, None), (1, 1, None), (5000, 1, 7), (5000, 43, None)])
def test_ids_have_no_gaps_and_follow_the_order(spark, n, start, partitions):
    rows = [(dt.date(2024, 1, 1 + (i % 5 if i % 3 else 0)), (i * 7919) % n) for i in range(n)]
    frame = spark.createDataFrame(rows, "d date, k bigint").repartition(6)
    got = layout.surrogate_id(frame, ["d", "k"], start, partitions=partitions)
    expected = [(start + i, *row) for i, row in enumerate(sorted(rows))]
    assert sorted(map(tuple, got.collect())) == expected


def test_only_partition_counts_pass_one_task_for_ids(spark):
    plan = initial_plan(layout.surrogate_id(spark.range(100).toDF("k"), ["k"]))
    before_single = plan.split("Exchange SinglePartition")[1]
    assert "output=[_partition" in before_single.splitlines()[1]


def test_sort_layout_orders_and_splits_one_hot_value(spark, tmp_path):
    frame = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 500).otherwise(F.col("id") % 997).alias("key"), "id"
    )
    out = str(tmp_path / "t")
    layout.sort_key_layout(frame, ["key"], ["id"], 9).write.parquet(out)
    files = spark.read.parquet(out).groupBy(F.input_file_name().alias("f")).agg(
        F.min(F.struct("key", "id")).alias("low"), F.max(F.struct("key", "id")).alias("high"), F.count("*").alias("n")
    ).orderBy("low").collect()
    assert len(files) == 9 and max(f.n for f in files) < 1000
    assert all(a.high < b.low for a, b in zip(files, files[1:]))
