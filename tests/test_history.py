import bisect
import datetime as dt
import random

import pytest

from postline.operators.history import as_of_join, validity_intervals
from tests.plans import initial_plan

D = lambda day: dt.date(2024, 1, 1) + dt.timedelta(day)


def intervals(spark, rows, gap=None):
    frame = spark.createDataFrame(rows, "user string, date date, followers string, name string").repartition(3)
    found = validity_intervals(frame, ["user"], "date", ["followers", "name"], gap)
    return sorted(tuple(row) for row in found.collect())


def brute(rows, gap):
    want = []
    for user in {row[0] for row in rows}:
        days = sorted(row[1:] for row in rows if row[0] == user and row[1] is not None)
        runs = []
        for day, *state in days:
            if runs and runs[-1][2] == state and (gap is None or (day - runs[-1][1]).days <= gap):
                runs[-1][1] = day
            else:
                runs.append([day, day, state])
        for run, after in zip(runs, [*runs[1:], None]):
            end = after and (after[0] if gap is None else min(after[0], run[1] + dt.timedelta(gap)))
            want.append((user, *run[2], run[0], end))
    return sorted(want)


@pytest.mark.parametrize("gap", [None, 1, 3])
def test_intervals(spark, gap):
    rng = random.Random(gap)
    rows = [
        (user, D(day), rng.choice(["1", "2"]), rng.choice(["x", "x", "y"]))
        for user in "abcdef" for day in range(60) if rng.random() < 0.6
    ]
    assert intervals(spark, rows, gap) == brute(rows, gap)


def test_intervals_of_odd_rows(spark):
    rows = [("a", D(1), None, "x"), ("a", D(2), None, "x"), ("a", D(3), "1", None), ("a", None, "9", "z"), (None, D(1), "1", "x"), (None, D(5), "1", "x")]
    got = {(r[0], r[1], r[2]): r[3:] for r in validity_intervals(spark.createDataFrame(rows, "user string, date date, followers string, name string"), ["user"], "date", ["followers", "name"]).collect()}
    assert got == {("a", None, "x"): (D(1), D(3)), ("a", "1", None): (D(3), None), (None, "1", "x"): (D(1), None)}
    assert intervals(spark, []) == []


def joined(spark, facts, states, period="day"):
    left = spark.createDataFrame(facts, "user string, at timestamp_ntz, n int").repartition(4)
    right = spark.createDataFrame(states, "user string, since timestamp_ntz, level int, name string").repartition(3)
    found = as_of_join(left, right, ["user"], "at", "since", ["level", "name"], period)
    assert found.columns == ["user", "at", "n", "level", "name"]
    return sorted((tuple(row) for row in found.collect()), key=lambda row: row[2])


def last_state(states, user, at):
    own = sorted((since, level, name) for u, since, level, name in states if u == user and since is not None)
    found = bisect.bisect_right([s[0] for s in own], at) if at is not None else 0
    return own[found - 1][1:] if found else (None, None)


@pytest.mark.parametrize("period", ["hour", "day", "year"])
def test_as_of_join_with_a_hot_account(spark, period):
    """An account with most of the facts and states, times that are equal, and gaps of many periods."""
    rng = random.Random(period)
    at = lambda: dt.datetime(2024, 1, 1) + dt.timedelta(hours=rng.choice([rng.randint(0, 90), rng.randint(900, 990)]))
    user = lambda: rng.choice("aaaaab") if rng.random() < 0.9 else rng.choice("cdxyz")
    states = sorted({(user(), at()) for _ in range(150)})
    states = [(u, t, rng.randint(0, 9), rng.choice("pqr")) for u, t in states if u not in "xyz"]
    facts = [(user(), at(), n) for n in range(600)]
    assert joined(spark, facts, states, period) == [(u, t, n, *last_state(states, u, t)) for u, t, n in facts]


def test_as_of_join_of_odd_rows(spark):
    noon = dt.datetime(2024, 1, 1, 12)
    states = [("a", noon, 1, "x"), ("a", noon, 2, None), ("a", None, 7, "no"), (None, noon, 8, "no"), ("b", noon + dt.timedelta(1), None, "late")]
    facts = [("a", noon, 1), ("a", noon, 2), ("a", noon, 2), ("a", None, 3), (None, noon, 4), ("b", noon, 5), ("b", noon + dt.timedelta(9), 6), ("c", noon, 7)]
    assert joined(spark, facts, states) == [
        ("a", noon, 1, 2, None), ("a", noon, 2, 2, None), ("a", noon, 2, 2, None), ("a", None, 3, None, None), (None, noon, 4, None, None),
        ("b", noon, 5, None, None), ("b", noon + dt.timedelta(9), 6, None, "late"), ("c", noon, 7, None, None),
    ]
    assert joined(spark, [], states) == [] and [r[3] for r in joined(spark, facts, [])] == [None] * 8


def test_as_of_join_has_no_range_join(spark):
    frame = spark.range(10).selectExpr("id AS user", "timestamp_ntz'2024-01-01' AS at", "id AS level")
    plan = initial_plan(as_of_join(frame, frame.withColumnRenamed("at", "since"), ["user"], "at", "since", ["level"]))
    assert "Join" not in plan
