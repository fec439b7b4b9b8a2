import datetime as dt

import pytest
from pyspark.sql import functions as F

from postline.operators import checks, incremental
from tests.plans import initial_plan

D = dt.date
AS_OF = D(2024, 2, 1)


def loaded(spark, *days):
    return spark.createDataFrame([(d,) for d in days], "d date")


def test_mark_is_the_newest_date_or_yesterday(spark):
    mark = lambda *days: incremental.high_water_mark(loaded(spark, *days), "d", AS_OF).first().mark
    assert mark() == D(2024, 1, 31)
    assert mark(None) == D(2024, 1, 31)
    assert mark(D(2024, 1, 3), None, D(2024, 1, 5)) == D(2024, 1, 5)


ROWS = [("a", 1, 20), ("a", 2, 21), ("b", 3, 20), ("b", 4, 19)]


def rows(spark):
    data = [(k, i, dt.datetime(2024, 1, day, 15)) for k, i, day in ROWS]
    return spark.createDataFrame(data, "k string, i int, ts timestamp_ntz")


def ids(frame):
    return sorted(r.i for r in frame.collect())


def test_gate_is_strict_and_takes_whole_batches(spark):
    mark = incremental.high_water_mark(loaded(spark, D(2024, 1, 20)), "d", AS_OF)
    assert ids(incremental.gate_batches(rows(spark), ["k"], "ts", mark)) == [1, 2]
    assert ids(incremental.gate_batch(rows(spark), "ts", mark)) == [1, 2, 3, 4]
    late = incremental.high_water_mark(loaded(spark, D(2024, 1, 21)), "d", AS_OF)
    assert ids(incremental.gate_batch(rows(spark), "ts", late)) == []


def test_gate_by_time(spark):
    mark = incremental.high_water_mark(loaded(spark, D(2024, 1, 20)), "d", AS_OF)
    gated = incremental.gate_batches(rows(spark), ["k"], "ts", mark, granularity="timestamp")
    assert ids(gated) == [1, 2, 3, 4]
    with pytest.raises(ValueError):
        incremental.gate_batches(rows(spark), ["k"], "ts", mark, granularity="hour")


def test_gate_with_each_accounts_own_mark(spark):
    old = spark.createDataFrame([("a", D(2024, 1, 21)), ("a", D(2024, 1, 1))], "k string, d date")
    marks = incremental.marks_per_key(old, ["k"], "d")
    opened = incremental.opened_accounts(rows(spark), "k", "ts", marks)
    assert [r.k for r in opened.collect()] == ["b"]  # never loaded, so open
    marks = incremental.marks_per_key(old.union(spark.createDataFrame([("b", D(2024, 1, 19))], old.schema)), ["k"], "d")
    assert [r.k for r in incremental.opened_accounts(rows(spark), "k", "ts", marks).collect()] == ["b"]
    assert incremental.opened_accounts(rows(spark), "k", "ts", marks.withColumn("mark", F.lit(D(2024, 1, 21)))).isEmpty()


def test_gate_of_cut_timelines(spark):
    gate = lambda day: incremental.gate_timelines(rows(spark), "k", "ts", F.lit(D(2024, 1, day)))
    assert ids(gate(19)) == [1, 2, 3, 4] and ids(gate(20)) == [1, 2] and ids(gate(21)) == []
    assert gate(20).columns == ["k", "i", "ts"]


def test_gated_rows_are_not_shuffled_for_few_batches(spark):
    mark = incremental.high_water_mark(loaded(spark, D(2024, 1, 20)), "d", AS_OF)
    plan = initial_plan(incremental.gate_batches(rows(spark), ["k"], "ts", mark))
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_many_batches_are_joined_without_a_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100")
    try:
        mark = incremental.high_water_mark(loaded(spark, D(2024, 1, 20)), "d", AS_OF)
        gated = incremental.gate_batches(rows(spark), ["k"], "ts", mark)
        assert "SortMergeJoin" in initial_plan(gated)
        assert ids(gated) == [1, 2]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_row_presence(spark):
    assert checks.row_presence(spark.range(5)).first().has_rows is True
    assert checks.row_presence(spark.range(0)).first().has_rows is False
    checks.require_rows(spark.range(1), "t")
    with pytest.raises(RuntimeError, match="no rows"):
        checks.require_rows(spark.range(0), "t")


def test_rows_of_opened_accounts_by_the_shorter_list(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), ("c", 4), (None, 5)], "user string, n int")
    for opened, want in ((["a"], [1, 2]), (["a", "b"], [1, 2, 3]), (["a", "b", "c"], [1, 2, 3, 4])):
        accounts = spark.createDataFrame([(name,) for name in opened], "user string")
        kept = incremental.rows_of_opened(rows, "user", rows, accounts)
        assert sorted(row.n for row in kept.collect()) == want
        assert ("LeftAnti" in initial_plan(kept)) == (len(opened) > 1)
