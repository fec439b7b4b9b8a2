import datetime as dt

import pytest
from pyspark.sql import functions as F

from postline import fixed_values as fixed
from postline.functions import columns, dates


@pytest.fixture
def zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    yield lambda name: spark.conf.set("spark.sql.session.timeZone", name)
    spark.conf.set("spark.sql.session.timeZone", before)


def one(spark, expression, value="2023-02-01 00:30:00+00:00", kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(expression.alias("x")).first().x


def v():
    return F.col("v")


def test_date_prefix(spark, zone):
    typed = v().cast("timestamp")
    assert one(spark, dates.date_prefix(typed)) == dt.date(2023, 2, 1)
    assert one(spark, dates.day_text(typed)) == "2023-02-01"
    zone("America/New_York")
    assert one(spark, dates.date_prefix(typed)) == dt.date(2023, 1, 31)
    assert one(spark, dates.date_prefix(v())) == dt.date(2023, 2, 1)


@pytest.mark.parametrize("bad", ["2023-13-45", "", "soon", None])
def test_malformed_dates_are_null(spark, bad):
    assert one(spark, dates.date_prefix(v()), bad) is None
    assert one(spark, dates.parse_creation(v()), bad) is None


def test_parse_creation(spark):
    assert one(spark, dates.creation_day(v())) == dt.date(2023, 2, 1)
    other = "2023-01-31 23:30:00+05:00"
    assert one(spark, dates.parse_creation(v()), other) is None
    assert one(spark, dates.date_prefix(v().cast("timestamp")), other) == dt.date(2023, 1, 31)
    assert one(spark, dates.time_of_day(v().cast("timestamp")), other) == "18:30:00"


def test_day_and_text(spark):
    assert one(spark, dates.iso_day(dates.day_of(v().cast("timestamp")))) == "2023-02-01"
    assert one(spark, dates.processing_day(dt.date(2024, 1, 31))) == dt.date(2024, 1, 31)
    assert one(spark, dates.processing_day() == F.current_date()) is True


@pytest.mark.parametrize("metric, whole", [(6.99, 6), (-6.99, -6), (0.0, 0), (None, None)])
def test_whole_number_cuts(spark, metric, whole):
    assert one(spark, columns.whole_number(v()), metric, "double") == whole


def test_stamps_and_warehouse_types(spark):
    rows = spark.createDataFrame([(7, "2023-02-01 10:00:00")], "favorite_count bigint, date_creation string")
    rows = rows.withColumn("date_creation", F.to_timestamp("date_creation"))
    stamped = columns.stamp_account(columns.stamp_day(rows, dt.date(2024, 1, 31)), "ann")
    typed = columns.warehouse_types(stamped, fixed.POSTS_TABLE)
    assert typed.dtypes == [
        ("favorite_count", "string"),
        ("date_creation", "date"),
        ("user", "string"),
        ("date", "date"),
    ]
    assert tuple(typed.first()) == ("7", dt.date(2023, 2, 1), "ann", dt.date(2024, 1, 31))
