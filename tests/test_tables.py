import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from postline.sources import tables
from tests.plans import initial_plan, metric, run_plan, scans

D = dt.date


@pytest.fixture
def db(spark, tmp_path):
    name = f"t_{uuid.uuid4().hex}"
    tables.create_tables(spark, name, str(tmp_path / "w"))
    return name


def test_create_twice_and_schemas(spark, db, tmp_path):
    tables.create_tables(spark, db, str(tmp_path / "w"))
    kinds = dict(spark.table(f"{db}.tweets").dtypes)
    assert kinds["id"] == "bigint" and kinds["favorite_count"] == "string" and kinds["date_creation"] == "date"
    assert spark.table(f"{db}.users").columns == [
        "user", "description", "following", "followers", "favorite_count", "retweet_count", "date_creation", "date"
    ]


def test_append_matches_by_name_and_refuses_unknown_columns(spark, db):
    row = spark.createDataFrame([(7, 8, "ann", D(2024, 1, 1))], "followers int, following int, user string, date date")
    table = f"{db}.{tables.SNAPSHOTS_TABLE}"
    tables.append_by_name(row, table)
    tables.append_by_name(row.select("date", "user", "following", "followers"), table)
    got = tables.scan(spark, table).collect()
    assert [(r.user, r.followers, r.following, r.description) for r in got] == [("ann", "7", "8", None)] * 2
    with pytest.raises(ValueError, match="no column extra"):
        tables.append_by_name(row.withColumn("extra", F.lit(1)), table)
    with pytest.raises(ValueError, match="append_posts"):
        tables.append_by_name(row, f"{db}.tweets")


def accounts(spark, day, *rows):
    frame = spark.createDataFrame(list(rows), "user string, followers bigint")
    return frame.withColumn("date", F.lit(day))


def users(spark, db):
    return sorted((r.user, r.followers, r.date.day) for r in spark.table(f"{db}.users").collect())


def test_accounts_keep_the_latest_state(spark, db):
    tables.load_accounts(spark, accounts(spark, D(2024, 1, 1), ("a", 1), ("b", 1)), db, D(2024, 1, 1))
    assert users(spark, db) == [("a", "1", 1), ("b", "1", 1)]
    for count in (8, 9):
        batch = accounts(spark, D(2024, 1, 2), ("b", count), ("c", 2))
        tables.load_accounts(spark, batch, db, D(2024, 1, 2))
        assert users(spark, db) == [("a", "1", 1), ("b", str(count), 2), ("c", "2", 2)]
    tables.load_accounts(spark, accounts(spark, D(2024, 1, 3), ("b", 5)), db, D(2024, 1, 3))
    assert users(spark, db) == [("a", "1", 1), ("b", "5", 3), ("c", "2", 2)]


def test_the_view_reads_the_newest_state_folder_only(spark, db):
    for day in (1, 2, 3):
        tables.load_accounts(spark, accounts(spark, D(2024, 1, day), ("a", day)), db, D(2024, 1, day))
    found = scans(run_plan(spark.table(f"{db}.users")))
    assert [metric(s, "numPartitions") for s in found] == [1]
    assert "Subquery" not in initial_plan(spark.table(f"{db}.users"))


def test_a_late_day_is_refused(spark, db):
    tables.load_accounts(spark, accounts(spark, D(2024, 1, 5), ("a", 1)), db, D(2024, 1, 5))
    with pytest.raises(ValueError, match="too late"):
        tables.load_accounts(spark, accounts(spark, D(2024, 1, 3), ("b", 1)), db, D(2024, 1, 3))


def test_a_snapshot_day_is_replaced_alone(spark, db):
    for day, user, count in ((1, "a", 1), (2, "a", 1), (2, "b", 3), (2, "a", 7)):
        tables.load_snapshot(spark, accounts(spark, D(2024, 1, day), (user, count)), db)
    rows = spark.table(f"{db}.{tables.SNAPSHOTS_TABLE}").collect()
    got = sorted((r.date.day, r.user, r.followers) for r in rows)
    assert got == [(1, "a", "1"), (2, "a", "7"), (2, "b", "3")]
    assert tables.day_snapshot(spark, db, D(2024, 1, 1)).count() == 1


def test_a_table_without_folder_overwrite_is_not_overwritten(spark, db):
    spark.sql(f"CREATE TABLE {db}.other (user STRING, date DATE) USING parquet PARTITIONED BY (date)")
    with pytest.raises(ValueError, match="was not created"):
        tables.replace_partitions(
            accounts(spark, D(2024, 1, 1), ("a", 1)).drop("followers"), f"{db}.other", "date", []
        )
