import csv
import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postline import fixed_values as fixed
from postline import schemas
from postline.sources import landing, payload, processed

AT = dt.datetime(2024, 1, 5, 10, 0, tzinfo=dt.timezone.utc)


def write_json(path, *records):
    path.write_text("\n".join(json.dumps(record) for record in records))
    return str(path)


def account(user, **lists):
    return {
        "user": user,
        "TWEET_INFO": lists,
        "USER_INFO": {
            "followers_count": 3,
            "following_count": 4,
            "created_at": "2020-01-01 00:00:00+00:00",
            "description": "d",
        },
        "USER_ACTIVITY": {"favoris_count": 5, "retweet_count": 6},
    }


def test_zip_stops_at_the_shortest_list(spark, tmp_path):
    path = write_json(
        tmp_path / "p.json",
        account(
            "ann",
            text=["a", "b", "c"],
            favorite_count=[1, 2],
            retweet_count=[7, 8, 9],
            created_at=["2024-01-05 10:00:00+00:00"] * 3,
            post_id=[10],
        ),
        account("bob", text=[], favorite_count=[], retweet_count=[], created_at=[]),
    )
    collected = payload.read_payload(spark, path)
    rows = payload.timeline_rows(collected).orderBy("text").collect()
    assert [(r.text, r.favorite_count, r.retweet_count, r.user, r.post_id) for r in rows] == [
        ("a", 1, 7, "ann", 10),
        ("b", 2, 8, "ann", None),
    ]
    assert payload.profile_rows(collected).filter("user = 'bob'").first()[:2] == (3, 4)
    assert payload.activity_rows(collected).filter("user = 'ann'").first()[:2] == (5, 6)


def test_malformed_payloads_fail(spark, tmp_path):
    lacking = write_json(tmp_path / "a.json", account("ann", text=["a"], favorite_count=[1]))
    with pytest.raises(Exception, match="lacks one of its lists"):
        payload.timeline_rows(payload.read_payload(spark, lacking)).collect()
    (tmp_path / "b.json").write_text('{"user": "ann", "TWEET_INFO":')
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        payload.read_payload(spark, str(tmp_path / "b.json")).collect()
    none = write_json(tmp_path / "c.json", {"user": "ann"})
    assert payload.timeline_rows(payload.read_payload(spark, none)).isEmpty()


def test_payload_round_trip(spark, tmp_path):
    record = account(
        "ann",
        text=['q"|\n'],
        favorite_count=[1],
        retweet_count=[2],
        created_at=["2024-01-05T10:00:00.123456Z"],
    )
    collected = payload.read_payload(spark, write_json(tmp_path / "p.json", record))
    payload.write_payload(collected, str(tmp_path / "again"))
    again = payload.read_payload(spark, str(tmp_path / "again"))
    assert payload.timeline_rows(again).collect() == payload.timeline_rows(collected).collect()


TEXTS = ['a|"b"\nc', "  two  spaces ", "back\\slash\\", "\\\"", "#c", "\r\nx\r", "é😀", '""', None]


def test_delimited_round_trip_keeps_every_text(spark, tmp_path):
    rows = spark.createDataFrame(list(enumerate(TEXTS)), "i int, text string")
    landing.write_delimited(rows, str(tmp_path / "t"))
    again = landing.read_delimited(spark, str(tmp_path / "t"), rows.schema)
    assert [r.text for r in again.orderBy("i").collect()] == TEXTS


def test_empty_text_comes_back_as_null(spark, tmp_path):
    rows = spark.createDataFrame([(1, ""), (2, None)], "i int, text string")
    landing.write_delimited(rows, str(tmp_path / "t"))
    again = landing.read_delimited(spark, str(tmp_path / "t"), rows.schema)
    assert [r.text for r in again.collect()] == [None, None]


def test_one_column_is_refused(spark, tmp_path):
    with pytest.raises(ValueError):
        landing.write_delimited(spark.range(1), str(tmp_path / "t"))


def test_files_of_another_writer(spark, tmp_path):
    """A file as the csv module writes it, without account and post id."""
    path = tmp_path / "raw_data" / "TWEET_INFO.csv"
    path.parent.mkdir()
    with path.open("w", newline="", encoding="utf-8") as file:
        writer = csv.writer(file, delimiter="|")
        writer.writerow(["text", "favorite_count", "date_creation", "retweet_count"])
        writer.writerow(['say "hi"\nthere | é', 3, AT, 4])
        writer.writerow(["", "x", AT, None])
    rows = landing.read_landing(spark, str(tmp_path), fixed.POSTS, bare=True)
    got = rows.select("text", "favorite_count", F.col("date_creation").cast("string"), "retweet_count")
    assert [tuple(r) for r in got.collect()] == [
        ('say "hi"\nthere | é', 3, "2024-01-05 10:00:00", 4),
        (None, None, "2024-01-05 10:00:00", None),
    ]


def test_columns_in_another_order_fail(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("followers|user\n1|ann\n")
    with pytest.raises(Exception, match="CSV header|CSV_HEADER|does not conform|FAILED_READ"):
        landing.read_delimited(
            spark, str(path), spark.range(0).selectExpr("'' AS user", "id AS followers").schema
        ).collect()


def test_landing_replaces_and_has_the_fixed_header(spark, tmp_path):
    for count in (1, 2):
        rows = spark.createDataFrame([(count, 2, "ann", None)], schemas.LANDING[fixed.ACTIVITY])
        landing.write_landing(rows, str(tmp_path), fixed.ACTIVITY)
    folder = tmp_path / "raw_data" / "USER_ACTIVITY.csv"
    lines = [line for file in folder.glob("*.csv") for line in file.read_text().splitlines()]
    header = "favorite_count|retweet_count|user|collected_at"
    assert [line for line in lines if line != header] == ["2|2|ann|"] and header in lines


def test_large_landing_is_cut_into_files(spark, tmp_path):
    landing.write_delimited(spark.range(100).selectExpr("id", "id AS b").coalesce(1), str(tmp_path / "t"), 30)
    assert len(list((tmp_path / "t").glob("*.csv"))) == 4


def test_zone_read_takes_matching_names_only(spark, tmp_path):
    for name in ("a/1.csv", "b/2.csv", "b/3.txt"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text(f"k|v\n{name}|1\n")
    schema = spark.createDataFrame([], "k string, v int").schema
    rows = landing.read_zone(spark, str(tmp_path), schema)
    assert sorted(r.k for r in rows.collect()) == ["a/1.csv", "b/2.csv"]


def test_exclude_reposts(spark):
    rows = spark.createDataFrame([(1, None), (2, 9)], "post_id bigint, repost_of bigint")
    assert [r.post_id for r in payload.exclude_reposts(rows).collect()] == [1]


def test_processed_zone_prunes_and_splits_a_large_date(spark, tmp_path):
    from tests.plans import metric, run_plan, scans

    rows = spark.range(40_000).select(
        F.when(F.col("id") % 3 > 0, "2024-01-02").otherwise("2024-01-01").cast("date").alias("date"),
        F.col("id"),
        F.sha2(F.col("id").cast("string"), 512).alias("text"),
    )
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "500k")
    try:
        processed.write_processed(rows, str(tmp_path / "p"))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    assert len(list((tmp_path / "p" / "date=2024-01-02").glob("*.parquet"))) > 1
    again = processed.read_processed(spark, str(tmp_path / "p"), rows.schema)
    assert again.select(*rows.columns).exceptAll(rows).isEmpty() and again.count() == 40_000
    day = again.filter(F.col("date") == dt.date(2024, 1, 1))
    assert metric(scans(run_plan(day))[0], "numPartitions") == 1


def test_processed_replaces_all_or_only_written_dates(spark, tmp_path):
    path = str(tmp_path / "p")
    row = lambda i, day: spark.createDataFrame([(i, dt.date(2024, 1, day))], "i int, date date")
    processed.write_processed(row(1, 1), path)
    processed.write_processed(row(2, 2), path, replace_dates=True)
    processed.write_processed(row(3, 2), path, replace_dates=True)
    assert sorted(r.i for r in processed.read_processed(spark, path).collect()) == [1, 3]
    processed.write_processed(row(4, 5), path)
    assert [r.i for r in processed.read_processed(spark, path).collect()] == [4]


def test_fractions_of_seconds_come_back(spark, tmp_path):
    at = dt.datetime(2024, 1, 5, 10, 0, 1, 987654)
    rows = spark.createDataFrame([(1, at)], "i int, at timestamp_ntz").withColumn("at", F.col("at").cast("timestamp"))
    landing.write_delimited(rows, str(tmp_path / "t"))
    again = landing.read_delimited(spark, str(tmp_path / "t"), rows.schema)
    assert again.select(F.col("at").cast("timestamp_ntz")).first()[0] == at


def test_rows_that_lack_fields_are_named(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a|b\n1|2\n3\n4|5|6\n")
    rows = landing.read_delimited(spark, str(tmp_path / "t.csv"), T.StructType.fromDDL("a int, b int"), rejected="bad")
    assert sorted(r.bad for r in rows.collect() if r.bad) == ["3", "4|5|6"]
