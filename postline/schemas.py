"""Declared schemas of the payload, the landing and processed zones and the tables.

Nothing is inferred: inference reads the data twice and turns a whole column
into text when one value is malformed.
"""

from pyspark.sql import types as T

from postline import fixed_values as fixed


def _struct(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


TEXT, WHOLE, DAY, INSTANT = T.StringType(), T.LongType(), T.DateType(), T.TimestampType()

# Names of columns and fields below are fixed: existing payloads, files and tables have them.

# One row per collected account. `post_id`, `repost_of` and `collected_at` may be
# missing from a payload; the first four lists are zipped by position.
PAYLOAD = _struct(
    user=TEXT,
    TWEET_INFO=_struct(
        text=T.ArrayType(TEXT),
        favorite_count=T.ArrayType(WHOLE),
        retweet_count=T.ArrayType(WHOLE),
        created_at=T.ArrayType(INSTANT),
        post_id=T.ArrayType(WHOLE),
        repost_of=T.ArrayType(WHOLE),
    ),
    USER_INFO=_struct(
        followers_count=WHOLE, following_count=WHOLE, created_at=INSTANT, description=TEXT
    ),
    USER_ACTIVITY=_struct(favoris_count=WHOLE, retweet_count=WHOLE),
    collected_at=INSTANT,
)

# Landing files as an earlier collector wrote them, without account or post id.
BARE_LANDING = {
    fixed.POSTS: _struct(
        text=TEXT, favorite_count=WHOLE, date_creation=INSTANT, retweet_count=WHOLE
    ),
    fixed.ACCOUNTS: _struct(
        followers=WHOLE, following=WHOLE, date_creation=INSTANT, description=TEXT
    ),
    fixed.ACTIVITY: _struct(favorite_count=WHOLE, retweet_count=WHOLE),
}

# Landing files as written here: the same columns, then the keys and the time of the collection.
_CARRIED = {
    fixed.POSTS: _struct(user=TEXT, post_id=WHOLE, collected_at=INSTANT),
    fixed.ACCOUNTS: _struct(user=TEXT, collected_at=INSTANT),
    fixed.ACTIVITY: _struct(user=TEXT, collected_at=INSTANT),
}
LANDING = {
    name: T.StructType(bare.fields + _CARRIED[name].fields) for name, bare in BARE_LANDING.items()
}
DATED = _struct(date=DAY)
# A processed batch that is not loaded yet: its day, and the last load of posts before it.
UNLOADED = _struct(date=DAY, load=WHOLE)
# Processed zone: posts with their date; accounts with the date text, the day and the activity.
PROCESSED = {
    fixed.POSTS: T.StructType(LANDING[fixed.POSTS].fields + DATED.fields),
    fixed.ACCOUNTS: _struct(
        followers=WHOLE,
        following=WHOLE,
        date_creation=TEXT,
        description=TEXT,
        user=TEXT,
        collected_at=INSTANT,
        retweet_count=WHOLE,
        favorite_count=WHOLE,
        date=DAY,
    ),
}

# Warehouse tables. Counts are text there; everywhere else they are whole numbers.
# `user` and `post_id` identify a post, so that it can be updated.
WAREHOUSE = {
    fixed.POSTS_TABLE: _struct(
        id=WHOLE,
        text=TEXT,
        favorite_count=TEXT,
        retweet_count=TEXT,
        date_creation=DAY,
        user=TEXT,
        post_id=WHOLE,
        date=DAY,
    ),
    fixed.ACCOUNTS_TABLE: _struct(
        user=TEXT,
        description=TEXT,
        following=TEXT,
        followers=TEXT,
        favorite_count=TEXT,
        retweet_count=TEXT,
        date_creation=DAY,
        date=DAY,
    ),
}
# The folders of posts: as in the warehouse, in folders of loads and dates.
POST_VERSIONS = T.StructType([*WAREHOUSE[fixed.POSTS_TABLE].fields[:-1], *_struct(load=WHOLE, date=DAY).fields])
# Where each post is stored: one row per post and load that placed it, until runs are merged.
POST_KEYS = _struct(
    user=TEXT, post_id=WHOLE, id=WHOLE, date=DAY, load=WHOLE, run=WHOLE, bucket=T.IntegerType()
)
# A commit: folders of posts (number is the load), runs of keys, both as they are and as they are given up; the last id.
POST_COMMIT = _struct(kind=TEXT, number=WHOLE, date=DAY, level=T.IntegerType(), buckets=T.IntegerType())
POST_KEY = ["user", "post_id"]
ACCOUNT_KEY = ["user"]
