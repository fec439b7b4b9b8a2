"""Collected timelines: one row per account with parallel lists, flattened to rows."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postline import schemas

ZIPPED = ["text", "favorite_count", "created_at", "retweet_count"]
OPTIONAL = ["post_id", "repost_of"]


def read_payload(spark: SparkSession, path: str, mode: str = "FAILFAST") -> DataFrame:
    """JSON payloads, one account per line. A payload holds one collection, so a line is small.

    A malformed line fails the job; `PERMISSIVE` would turn it into NULLs.
    """
    return spark.read.schema(schemas.PAYLOAD).option("mode", mode).json(path)


def write_payload(
    payload: DataFrame, path: str, partition_by: tuple[str, ...] = (), compression: str = "none"
) -> None:
    """JSON payloads, in a folder for each value of the columns in `partition_by`, which the lines do not hold."""
    # Of gzip's levels the fastest: the others cost several times the rest of the write.
    options = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "compression": compression, "zlib.compress.level": "BEST_SPEED"}
    payload.write.options(**options).partitionBy(*partition_by).json(path)


def without_texts(payload: DataFrame) -> DataFrame:
    """The payload with NULL for each text of a post. The lists are read whole and keep their lengths."""
    texts = F.transform("TWEET_INFO.text", lambda _: F.lit(None).cast("string"))
    narrow = F.when(F.col("TWEET_INFO").isNotNull(), F.col("TWEET_INFO").withField("text", texts))
    return payload.withColumn("TWEET_INFO", narrow)


def _zip_to_shortest(lists: list[Column], optional: list[Column]) -> Column:
    """Zip lists by position up to the end of the shortest; optional ones are filled with NULL."""
    # arrays_zip fills every list up to the longest, hence the cut.
    shortest = F.least(*(F.size(column) for column in lists))
    return F.slice(F.arrays_zip(*lists, *optional), 1, shortest)


def timeline_rows(payload: DataFrame) -> DataFrame:
    """One row per post: the text, its counts and time, the account, the collection's time and, if collected, the ids."""
    missing = F.raise_error(F.lit("a timeline lacks one of its lists"))
    posts = [F.coalesce(F.col(f"TWEET_INFO.{name}"), missing).alias(name) for name in ZIPPED]
    extras = [
        F.coalesce(F.col(f"TWEET_INFO.{name}"), F.array()).alias(name) for name in OPTIONAL
    ]
    names = ZIPPED + OPTIONAL
    carried = ["user", "collected_at"]
    lists = payload.filter(F.col("TWEET_INFO").isNotNull()).select(*carried, *posts, *extras)
    rows = lists.select(
        *carried, F.inline(_zip_to_shortest([F.col(n) for n in ZIPPED], [F.col(n) for n in OPTIONAL]))
    ).toDF(*carried, *names)
    return rows.select(
        "text",
        "favorite_count",
        F.col("created_at").alias("date_creation"),
        "retweet_count",
        "user",
        "post_id",
        "repost_of",
        "collected_at",
    )


def profile_rows(payload: DataFrame) -> DataFrame:
    """One row per account."""
    return payload.select(
        F.col("USER_INFO.followers_count").alias("followers"),
        F.col("USER_INFO.following_count").alias("following"),
        F.col("USER_INFO.created_at").alias("date_creation"),
        F.col("USER_INFO.description").alias("description"),
        "user",
        "collected_at",
    )


def activity_rows(payload: DataFrame) -> DataFrame:
    """One row per account: likes it gave, and its number of statuses.

    The two counts are called `favorite_count` and `retweet_count` in the landing
    file and the tables; neither is a sum over posts.
    """
    return payload.select(
        F.col("USER_ACTIVITY.favoris_count").alias("favorite_count"),
        F.col("USER_ACTIVITY.retweet_count").alias("retweet_count"),
        "user",
        "collected_at",
    )


def exclude_reposts(posts: DataFrame) -> DataFrame:
    return posts.filter(F.col("repost_of").isNull())
