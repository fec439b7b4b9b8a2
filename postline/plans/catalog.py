"""Every operator as a query over the given tables, next to the SQL it must agree with."""

import datetime
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postline import fixed_values as fixed
from postline import schemas
from postline.functions import columns, dates, text
from postline.operators import accounts, checks, history, incremental, layout, timeline, upsert
from postline.plans import daily
from postline.session import scratch_path, stage
from postline.sources import landing, payload, processed, tables
from postline.sources import posts as post_table
from postline.streaming import intake

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

DAY_1, DAY_2 = datetime.date(2024, 1, 30), datetime.date(2024, 1, 31)


def _query(sql: str) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        QUERIES[build.__name__] = build
        SQL[build.__name__] = sql
        return build

    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Text rules

CLEAN_SQL = r"""regexp_replace(lower(regexp_replace(regexp_replace(text,
    '[^a-zA-Z\s]', '', 'g'), '^@\w+', '')), 'http\S+', '', 'g')"""


@_query(f"SELECT doc_id, {CLEAN_SQL} AS text FROM documents")
def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return docs.select("doc_id", text.clean_text(F.col("text")).alias("text"))


@_query(
    r"""SELECT page_id, regexp_replace(regexp_replace(regexp_replace(lower(
        '@bob see ' || url || ' end 42' || html), '^@\w+', ''), 'http\S+', '', 'g'),
        '[^a-z\s]', '', 'g') AS text FROM pages"""
)
def clean_text_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    post = F.concat(F.lit("@bob see "), "url", F.lit(" end 42"), "html")
    return pages.select("page_id", text.clean_text_ordered(post).alias("text"))


@_query(r"SELECT doc_id, regexp_replace(text, '[^a-zA-Z\s]', '', 'g') AS text FROM documents")
def strip_nonletters(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return docs.select("doc_id", text.strip_nonletters(F.col("text")).alias("text"))


@_query(
    r"""SELECT conv_id, turn, regexp_replace('@' || role || ' ' || text, '^@\w+', '') AS text
        FROM conversations"""
)
def strip_leading_handle(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations")
    post = F.concat(F.lit("@"), "role", F.lit(" "), "text")
    return turns.select("conv_id", "turn", text.strip_leading_handle(post).alias("text"))


@_query("SELECT doc_id, lower(text) AS text FROM documents")
def lower_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return docs.select("doc_id", text.lower_text(F.col("text")).alias("text"))


@_query(
    r"""SELECT page_id, regexp_replace('see ' || url || ' end ' || html, 'http\S+', '', 'g') AS text
        FROM pages"""
)
def strip_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    post = F.concat(F.lit("see "), "url", F.lit(" end "), "html")
    return pages.select("page_id", text.strip_urls(post).alias("text"))


# Dates, stamps, types


@_query(
    """SELECT event_id, substr(CAST(ts AS VARCHAR), 1, 10) AS day,
              CAST(substr(CAST(ts AS VARCHAR), 1, 10) AS DATE) AS date FROM events"""
)
def date_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    ts = F.col("ts")
    return _table(spark, sf_dir, "events").select(
        "event_id", dates.day_text(ts).alias("day"), dates.date_prefix(ts).alias("date")
    )


@_query(
    """SELECT event_id, date_trunc('second', ts) AS created, CAST(ts AS DATE) AS date FROM events"""
)
def timestamp_format_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    created = F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit("+00:00"))
    return _table(spark, sf_dir, "events").select(
        "event_id",
        dates.parse_creation(created).cast("timestamp_ntz").alias("created"),
        dates.creation_day(created).alias("date"),
    )


@_query("SELECT event_id, strftime(ts, '%H:%M:%S') AS time FROM events")
def time_of_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events")
    return events.select("event_id", dates.time_of_day(F.col("ts")).alias("time"))


@_query(
    """SELECT c_custkey, c_name, DATE '2024-01-31' AS date, 'account' AS "user" FROM customer"""
)
def snapshot_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = _table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return columns.stamp_account(columns.stamp_day(people, DAY_2), "account")


@_query(
    """SELECT event_type AS text, CAST(CAST(trunc(value) AS BIGINT) AS VARCHAR) AS favorite_count,
              CAST(event_id AS VARCHAR) AS retweet_count, CAST(ts AS DATE) AS date_creation,
              CAST(user_id AS VARCHAR) AS "user", event_id AS post_id, CAST(ts AS DATE) AS date
       FROM events"""
)
def warehouse_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return columns.warehouse_types(_event_posts(spark, sf_dir), fixed.POSTS_TABLE)


def _event_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in the form of processed posts."""
    return _table(spark, sf_dir, "events").select(
        F.col("event_type").alias("text"),
        columns.whole_number(F.col("value")).alias("favorite_count"),
        F.col("ts").alias("date_creation"),
        F.col("event_id").alias("retweet_count"),
        F.col("user_id").cast("string").alias("user"),
        F.col("event_id").alias("post_id"),
        dates.day_of(F.col("ts")).alias("date"),
    )


# Payload

# Posts per collected payload: event ids are unique, so a payload holds no more.
PAGE = 1000


def _no_time() -> Column:
    """Collections without a time."""
    return F.lit(None).cast("timestamp").alias("collected_at")


@_query(
    """SELECT event_type AS text, CAST(trunc(value) AS BIGINT) AS favorite_count,
              ts AS date_creation, CAST(trunc(value * 2) AS BIGINT) AS retweet_count,
              CAST(user_id AS VARCHAR) AS "user", event_id AS post_id FROM events"""
)
def timeline_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events packed into payloads of at most PAGE posts, written, read, flattened again."""
    post = F.struct(
        F.col("event_type").alias("text"),
        columns.whole_number(F.col("value")).alias("favorite_count"),
        columns.whole_number(F.col("value") * 2).alias("retweet_count"),
        F.col("ts").cast("timestamp").alias("created_at"),
        F.col("event_id").alias("post_id"),
    )
    page = F.floor(F.col("event_id") / PAGE)
    packed = (
        _table(spark, sf_dir, "events")
        .groupBy(F.col("user_id").cast("string").alias("user"), page.alias("page"))
        .agg(F.collect_list(post).alias("posts"))
    )
    lists = [
        F.col(f"posts.{name}").alias(name)
        for name in ("text", "favorite_count", "retweet_count", "created_at", "post_id")
    ]
    path = scratch_path(spark, "payload")
    payload.write_payload(packed.select("user", F.struct(*lists).alias("TWEET_INFO")), path)
    rows = payload.timeline_rows(payload.read_payload(spark, path))
    return rows.drop("repost_of", "collected_at").withColumn(
        "date_creation", F.col("date_creation").cast("timestamp_ntz")
    )


@_query(
    """SELECT CAST(trunc(c_acctbal) AS BIGINT) AS followers, CAST(c_nationkey AS BIGINT) AS following,
              TIMESTAMP '2020-01-01 00:00:00' AS date_creation, c_mktsegment AS description,
              c_name AS "user" FROM customer"""
)
def profile_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    record = F.struct(
        columns.whole_number(F.col("c_acctbal")).alias("followers_count"),
        F.col("c_nationkey").cast("bigint").alias("following_count"),
        F.lit("2020-01-01").cast("timestamp_ntz").alias("created_at"),
        F.col("c_mktsegment").alias("description"),
    )
    people = _table(spark, sf_dir, "customer")
    collected = people.select(F.col("c_name").alias("user"), record.alias("USER_INFO"), _no_time())
    return payload.profile_rows(collected).drop("collected_at")


@_query(
    """SELECT CAST(trunc(s_acctbal) AS BIGINT) AS favorite_count,
              CAST(s_nationkey AS BIGINT) AS retweet_count, s_name AS "user" FROM supplier"""
)
def activity_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    record = F.struct(
        columns.whole_number(F.col("s_acctbal")).alias("favoris_count"),
        F.col("s_nationkey").cast("bigint").alias("retweet_count"),
    )
    suppliers = _table(spark, sf_dir, "supplier")
    collected = suppliers.select(F.col("s_name").alias("user"), record.alias("USER_ACTIVITY"), _no_time())
    return payload.activity_rows(collected).drop("collected_at")


@_query("SELECT event_id, user_id, event_type FROM events WHERE event_type <> 'view'")
def exclude_reposts(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    original = F.when(F.col("event_type") == "view", F.col("event_id"))
    return payload.exclude_reposts(events.withColumn("repost_of", original)).drop("repost_of")


# Timelines


@_query(
    """SELECT event_id, ts, user_id, event_type, value FROM events QUALIFY row_number() OVER
       (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) <= 50"""
)
def timeline_top_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events")
    events = events.select("event_id", "ts", "user_id", "event_type", "value")
    return timeline.timeline_top_n(events, "user_id", ("ts", "event_id"))


@_query("SELECT max(CAST(o_orderdate AS DATE)) AS d FROM orders")
def max_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeline.max_date(_order_days(spark, sf_dir), "d")


@_query("SELECT CAST(o_orderdate AS DATE) AS d FROM orders ORDER BY d DESC LIMIT 1")
def latest_date_top1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeline.latest_date(_order_days(spark, sf_dir), "d")


def _order_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("d"))


@_query("SELECT * FROM orders ORDER BY o_orderkey LIMIT 10")
def preview_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timeline.preview(_table(spark, sf_dir, "orders"), ["o_orderkey"])


# Accounts


@_query(
    """WITH latest AS (
           SELECT o_custkey, o_totalprice, o_orderkey FROM orders QUALIFY row_number() OVER
           (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1)
       SELECT c_custkey, c_name, CAST(trunc(o_totalprice) AS BIGINT) AS favorite_count,
              o_orderkey AS retweet_count
       FROM customer LEFT JOIN latest ON c_custkey = o_custkey"""
)
def attach_account_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = _table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return accounts.attach_account_metrics(
        people, _order_activity(spark, sf_dir), "c_custkey", ["o_orderdate", "retweet_count"]
    )


@_query(
    """WITH latest AS (SELECT o_totalprice, o_orderkey FROM orders
                       ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1)
       SELECT c_custkey, c_name,
              (SELECT CAST(trunc(o_totalprice) AS BIGINT) FROM latest) AS favorite_count,
              (SELECT o_orderkey FROM latest) AS retweet_count
       FROM customer"""
)
def attach_single_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = _table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return accounts.attach_single_activity(
        people, _order_activity(spark, sf_dir), ["o_orderdate", "retweet_count"]
    )


def _order_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("c_custkey"),
        F.col("o_totalprice").alias("favorite_count"),
        F.col("o_orderkey").alias("retweet_count"),
        "o_orderdate",
    )


@_query(
    """SELECT *, DATE '2024-01-30' AS date FROM customer
       UNION ALL SELECT *, DATE '2024-01-31' AS date FROM customer"""
)
def daily_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two days of account states, the second loaded twice."""
    people = _table(spark, sf_dir, "customer")
    path = scratch_path(spark, "snapshots")
    for day in (DAY_1, DAY_2, DAY_2):
        processed.write_processed(columns.stamp_day(people, day), path, replace_dates=True)
    return processed.read_processed(spark, path, _with_date(people.schema))


def _with_date(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("date", T.DateType())])


# States over time

# Each account's state of a day: its events of that day that are no errors, by number and by kind of the last.
STATES_SQL = """states AS (SELECT user_id, CAST(ts AS DATE) AS day, least(count(*), 2)::BIGINT AS level, arg_max(event_type, (ts, event_id)) AS kind
                FROM events WHERE event_type <> 'error' GROUP BY ALL)"""


def _daily_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events").filter(F.col("event_type") != "error")
    days = events.groupBy("user_id", dates.day_of(F.col("ts")).alias("day"))
    level = F.least(F.count(F.lit(1)), F.lit(2)).alias("level")
    return days.agg(level, F.max_by("event_type", F.struct("ts", "event_id")).alias("kind"))


@_query(
    f"""WITH {STATES_SQL},
    changes AS (SELECT *, lag(level) OVER w IS NULL OR level <> lag(level) OVER w OR day - lag(day) OVER w > 7 AS starts
                FROM states WINDOW w AS (PARTITION BY user_id ORDER BY day)),
    numbered AS (SELECT *, sum(starts::INT) OVER (PARTITION BY user_id ORDER BY day) AS island FROM changes),
    islands AS (SELECT user_id, any_value(level) AS level, min(day) AS valid_from, max(day) AS last_day FROM numbered GROUP BY user_id, island)
    SELECT user_id, level, valid_from,
           CASE WHEN lead(valid_from) OVER w IS NOT NULL THEN least(lead(valid_from) OVER w, last_day + 7) END AS valid_to
    FROM islands WINDOW w AS (PARTITION BY user_id ORDER BY valid_from)"""
)
def account_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From which day to which an account had a level; a state holds for a week if no other comes."""
    return history.validity_intervals(_daily_states(spark, sf_dir), ["user_id"], "day", ["level"], max_gap=7)


@_query(
    f"""WITH {STATES_SQL}
    SELECT f.event_id, f.user_id, f.ts, s.level, s.kind
    FROM (SELECT event_id, user_id, ts, CAST(ts AS DATE) - 1 AS before FROM events WHERE event_type = 'error') f
    ASOF LEFT JOIN states s ON f.user_id = s.user_id AND f.before >= s.day"""
)
def posts_with_state_of_the_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every error with the account's state at the end of the day before, or the last one before that."""
    errors = _table(spark, sf_dir, "events").filter(F.col("event_type") == "error")
    facts = errors.select("event_id", "user_id", "ts", F.date_sub(dates.day_of(F.col("ts")), 1).alias("before"))
    joined = history.as_of_join(facts, _daily_states(spark, sf_dir), ["user_id"], "before", "day", ["level", "kind"])
    return joined.drop("before")


# Incremental processing


@_query(
    """SELECT max(CAST(ts AS DATE)) AS mark, strftime(max(CAST(ts AS DATE)), '%Y-%m-%d') AS mark_text,
              DATE '2024-01-31' AS empty_mark FROM events"""
)
def high_water_mark(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = _table(spark, sf_dir, "events").select(dates.day_of(F.col("ts")).alias("d"))
    as_of = datetime.date(2024, 2, 1)
    empty = incremental.high_water_mark(days.filter(F.lit(False)), "d", as_of)
    return incremental.high_water_mark(days, "d", as_of).select(
        "mark",
        dates.iso_day(F.col("mark")).alias("mark_text"),
        empty.scalar().alias("empty_mark"),
    )


@_query(
    """WITH weeks AS (SELECT event_id, ts, user_id, date_trunc('week', ts) AS week FROM events)
       SELECT event_id, ts, user_id, CAST(week AS TIMESTAMP) AS week FROM weeks WHERE week IN (
           SELECT week FROM weeks GROUP BY week HAVING max(CAST(ts AS DATE)) > DATE '2024-01-20')"""
)
def incremental_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches are weeks; what is loaded ends on the 20th."""
    events = _table(spark, sf_dir, "events").select("event_id", "ts", "user_id")
    weeks = events.withColumn("week", F.date_trunc("week", "ts").cast("timestamp_ntz"))
    loaded = events.filter(F.col("ts") < F.lit("2024-01-21").cast("timestamp_ntz"))
    mark = incremental.high_water_mark(loaded.withColumn("d", F.to_date("ts")), "d", DAY_2)
    return incremental.gate_batches(weeks, ["week"], "ts", mark)


@_query(
    """SELECT event_id, ts, 'open' AS gate FROM events
       WHERE (SELECT max(CAST(ts AS DATE)) FROM events) > DATE '2024-01-20'
       UNION ALL
       SELECT event_id, ts, 'closed' FROM events
       WHERE (SELECT max(CAST(ts AS DATE)) FROM events) > DATE '2024-01-31'"""
)
def batch_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events as one batch, against a mark before its end and one after it."""
    events = _table(spark, sf_dir, "events").select("event_id", "ts")
    gated = []
    for gate, day in (("open", datetime.date(2024, 1, 20)), ("closed", DAY_2)):
        loaded = events.select(F.lit(day).alias("d"))
        mark = incremental.high_water_mark(loaded, "d", DAY_2)
        gated.append(incremental.gate_batch(events, "ts", mark).withColumn("gate", F.lit(gate)))
    return gated[0].unionByName(gated[1])


@_query(
    """SELECT 'orders' AS name, count(*) > 0 AS has_rows FROM (SELECT 1 FROM orders LIMIT 1)
       UNION ALL
       SELECT 'none', count(*) > 0 FROM (SELECT 1 FROM orders WHERE o_orderkey < 0 LIMIT 1)"""
)
def row_presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders")
    some = checks.row_presence(orders).select(F.lit("orders").alias("name"), "has_rows")
    none = checks.row_presence(orders.filter("o_orderkey < 0"))
    return some.unionByName(none.select(F.lit("none").alias("name"), "has_rows"))


# Tables

# Orders up to this day are loaded, those after it are the batch.
ORDERS_LOADED = datetime.date(1996, 12, 31)


@_query(
    """WITH days AS (SELECT o_custkey, o_orderpriority, o_orderkey, o_totalprice,
                            CAST(o_orderdate AS DATE) AS d FROM orders),
            old AS (SELECT * FROM days WHERE d <= DATE '1996-12-31' QUALIFY row_number() OVER
                    (PARTITION BY o_custkey, o_orderpriority ORDER BY d DESC, o_orderkey DESC) = 1),
            new AS (SELECT * FROM days WHERE d > DATE '1996-12-31' QUALIFY row_number() OVER
                    (PARTITION BY o_custkey, o_orderpriority ORDER BY d DESC, o_orderkey DESC) = 1)
       SELECT * FROM new UNION ALL SELECT * FROM old WHERE NOT EXISTS (SELECT 1 FROM new
           WHERE new.o_custkey = old.o_custkey AND new.o_orderpriority = old.o_orderpriority)"""
)
def upsert_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last order per customer and priority: a table to a day, then all later orders."""
    orders = _table(spark, sf_dir, "orders").select(
        "o_custkey",
        "o_orderpriority",
        "o_orderkey",
        "o_totalprice",
        F.col("o_orderdate").cast("date").alias("d"),
    )
    keys, newest = ["o_custkey", "o_orderpriority"], ["d", "o_orderkey"]
    target = timeline.latest_per_key(orders.filter(F.col("d") <= ORDERS_LOADED), keys, newest)
    return upsert.upsert_by_key(target, orders.filter(F.col("d") > ORDERS_LOADED), keys, newest)


@_query(
    """SELECT row_number() OVER (ORDER BY CAST(o_orderdate AS DATE), o_orderkey) AS id,
              o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders"""
)
def surrogate_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _table(spark, sf_dir, "orders")
    days = orders.select("o_orderkey", F.col("o_orderdate").cast("date").alias("d"))
    return layout.surrogate_id(days, ["d", "o_orderkey"])


@_query(
    """SELECT count(*) AS n_rows, sum(o_orderkey)::BIGINT AS key_sum, 8::BIGINT AS files,
              0::BIGINT AS overlapping, 0::BIGINT AS unsorted FROM orders"""
)
def sort_key_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts of the files that the layout gives: all rows, ranges that do not overlap, rows in order."""
    orders = _table(spark, sf_dir, "orders")
    path, key = scratch_path(spark, "sorted"), F.struct("o_orderdate", "o_orderkey")
    ranged = layout.sort_key_layout(orders, ["o_orderdate"], ["o_orderkey"], partitions=8)
    ranged.write.parquet(path)
    placed = processed.read_processed(spark, path, orders.schema).select(
        key.alias("key"), "o_orderkey", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row")
    )
    before = F.lag("key").over(Window.partitionBy("file").orderBy("row"))
    files = placed.withColumn("before", before).groupBy("file").agg(
        F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("key_sum"), F.min("key").alias("low"), F.max("key").alias("high"),
        F.coalesce(F.sum((F.col("before") >= F.col("key")).cast("bigint")), F.lit(0)).alias("unsorted"),
    )
    # One row per file.
    overlap = (F.lag("high").over(Window.orderBy("low")) >= F.col("low")).cast("bigint")
    return files.withColumn("overlap", overlap).agg(
        F.sum("n").alias("n_rows"), F.sum("key_sum").alias("key_sum"), F.count("file").alias("files"),
        F.coalesce(F.sum("overlap"), F.lit(0)).alias("overlapping"), F.sum("unsorted").alias("unsorted"),
    )


@_query(
    """SELECT c_name AS "user", c_mktsegment AS description, CAST(c_nationkey AS VARCHAR) AS following,
              CAST(CAST(trunc(c_acctbal) AS BIGINT) AS VARCHAR) AS followers,
              CAST(c_custkey AS VARCHAR) AS favorite_count, CAST(NULL AS VARCHAR) AS retweet_count,
              DATE '2020-01-01' AS date_creation, DATE '2024-01-30' AS date FROM customer"""
)
def warehouse_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accounts with their columns in another order than the table's, and one missing."""
    db = _new_warehouse(spark)
    table = f"{db}.{tables.SNAPSHOTS_TABLE}"
    tables.append_by_name(_customer_accounts(spark, sf_dir, DAY_1), table)
    return tables.scan(spark, table)


def _new_warehouse(spark: SparkSession) -> str:
    db = f"postline_{uuid.uuid4().hex}"
    tables.create_tables(spark, db, scratch_path(spark, "warehouse"))
    return db


def _customer_accounts(spark: SparkSession, sf_dir: str, day: datetime.date) -> DataFrame:
    people = _table(spark, sf_dir, "customer").select(
        columns.whole_number(F.col("c_acctbal")).alias("followers"),
        F.col("c_nationkey").alias("following"),
        F.lit(datetime.date(2020, 1, 1)).alias("date_creation"),
        F.col("c_mktsegment").alias("description"),
        F.col("c_custkey").alias("favorite_count"),
        F.col("c_name").alias("user"),
    )
    return columns.stamp_day(people, day)


@_query(
    """WITH spent AS (SELECT o_custkey, count(*) AS n FROM orders
                      WHERE o_orderdate > TIMESTAMP '1997-12-31 00:00:00' GROUP BY o_custkey)
       SELECT c_name AS "user", c_mktsegment AS description, CAST(c_nationkey AS VARCHAR) AS following,
              CAST(CAST(trunc(c_acctbal) AS BIGINT) AS VARCHAR) AS followers,
              CAST(coalesce(n, c_custkey) AS VARCHAR) AS favorite_count,
              CAST(NULL AS VARCHAR) AS retweet_count, DATE '2020-01-01' AS date_creation,
              CASE WHEN n IS NULL THEN DATE '2024-01-30' ELSE DATE '2024-01-31' END AS date
       FROM customer LEFT JOIN spent ON c_custkey = o_custkey"""
)
def warehouse_accounts_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All accounts on one day, those with late orders updated on the next, that day run twice."""
    db = _new_warehouse(spark)
    tables.load_accounts(spark, _customer_accounts(spark, sf_dir, DAY_1), db, DAY_1)
    late = _table(spark, sf_dir, "orders").filter(
        F.col("o_orderdate") > F.lit("1997-12-31").cast("timestamp_ntz")
    )
    spent = late.groupBy(F.col("o_custkey").alias("favorite_count")).agg(F.count("*").alias("_n"))
    changed = (
        _customer_accounts(spark, sf_dir, DAY_2)
        .join(spent, "favorite_count")
        .withColumn("favorite_count", F.col("_n"))
        .drop("_n")
    )
    for _ in range(2):
        tables.load_accounts(spark, changed, db, DAY_2)
    return tables.scan(spark, f"{db}.{fixed.ACCOUNTS_TABLE}")


@_query(
    """SELECT row_number() OVER (ORDER BY ts >= TIMESTAMP '2024-01-16 00:00:00', CAST(ts AS DATE),
                                          CAST(user_id AS VARCHAR), event_id) AS id,
              event_type AS text, CAST(CAST(trunc(value) AS BIGINT) + 1 AS VARCHAR) AS favorite_count,
              CAST(event_id AS VARCHAR) AS retweet_count, CAST(ts AS DATE) AS date_creation,
              CAST(user_id AS VARCHAR) AS "user", event_id AS post_id, CAST(ts AS DATE) AS date
       FROM events"""
)
def warehouse_posts_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first half of the month, then the whole month with other counts: ids stay, counts change."""
    db = _new_warehouse(spark)
    posts = _event_posts(spark, sf_dir)
    post_table.load_posts(spark, posts.filter(F.col("date") < datetime.date(2024, 1, 16)), db)
    post_table.load_posts(spark, posts.withColumn("favorite_count", F.col("favorite_count") + 1), db)
    return tables.scan(spark, f"{db}.{fixed.POSTS_TABLE}")


@_query(
    """SELECT row_number() OVER (ORDER BY CAST(ts AS DATE), CAST(user_id AS VARCHAR), event_id) AS id, event_type AS text,
              CAST(CAST(trunc(value) AS BIGINT) AS VARCHAR) AS favorite_count, CAST(event_id AS VARCHAR) AS retweet_count,
              CAST(ts AS DATE) AS date_creation, CAST(user_id AS VARCHAR) AS "user", event_id AS post_id, CAST(ts AS DATE) AS date
       FROM events WHERE ts < TIMESTAMP '2024-01-16 00:00:00'"""
)
def posts_before_last_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table as it was before a load that changed, moved and added posts."""
    db = _new_warehouse(spark)
    posts = _event_posts(spark, sf_dir)
    post_table.load_posts(spark, posts.filter(F.col("date") < datetime.date(2024, 1, 16)), db)
    later = posts.withColumn("favorite_count", F.col("favorite_count") + 1)
    post_table.load_posts(spark, later.withColumn("date", F.date_add("date", 1)), db)
    return post_table.posts_after(spark, db, post_table.commits(spark, db)[-2])


# Files


@_query(
    """SELECT doc_id, nullif(text, '') AS text, nullif(lang, '') AS lang,
              nullif(source, '') AS source, n_chars FROM documents"""
)
def landing_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    path = scratch_path(spark, "landing")
    landing.write_delimited(docs, path)
    return landing.read_delimited(spark, path, docs.schema)


@_query(
    """SELECT *, CAST(ts AS DATE) AS date, 'date=' || CAST(CAST(ts AS DATE) AS VARCHAR) AS folder FROM events"""
)
def processed_partitioned_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events").withColumn("date", dates.day_of(F.col("ts")))
    path = scratch_path(spark, "processed")
    processed.write_processed(events, path)
    # The folder is taken from the file's name, the date from the row.
    folder = F.regexp_extract(F.col("_metadata.file_path"), "(date=[^/]+)/[^/]+$", 1)
    return processed.read_processed(spark, path, events.schema).withColumn("folder", folder)


@_query("SELECT * FROM events")
def processed_text_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = _table(spark, sf_dir, "events")
    path = scratch_path(spark, "export")
    processed.export_processed(events, path)
    return landing.read_delimited(spark, path, events.schema)


@_query("SELECT * FROM customer")
def zone_glob_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A zone with delimited files and, beside them, text files of the same rows."""
    people = _table(spark, sf_dir, "customer")
    zone = scratch_path(spark, "zone")
    landing.write_delimited(people, f"{zone}/customer")
    lines = people.select(F.concat_ws(fixed.SEPARATOR, *people.columns).alias("value"))
    lines.write.text(f"{zone}/notes")
    return landing.read_zone(spark, zone, people.schema)


# The whole run

POSTS_SQL = """posts AS (SELECT e.event_id, e.user_id, e.ts,
                      CAST(trunc(e.value) AS BIGINT) AS favorite_count, d.text
               FROM events e JOIN documents d ON e.event_id = d.doc_id
               WHERE e.event_type <> 'error')"""


@_query(
    f"""WITH {POSTS_SQL},
    top AS (SELECT * FROM posts QUALIFY row_number() OVER
            (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) <= 50),
    act AS (SELECT user_id, count(*) AS n_status FROM events GROUP BY user_id),
    hwm AS (SELECT coalesce(max(CAST(ts AS DATE)), DATE '2024-01-31' - 1) AS w
            FROM posts WHERE ts < TIMESTAMP '2024-01-02 00:00:00'),
    ok AS (SELECT user_id FROM top GROUP BY user_id
           HAVING max(CAST(ts AS DATE)) > (SELECT w FROM hwm))
    SELECT t.event_id, t.user_id, {CLEAN_SQL.replace("text,", "t.text,")} AS text,
           CAST(t.ts AS DATE) AS date, t.favorite_count, a.n_status
    FROM top t JOIN ok ON t.user_id = ok.user_id LEFT JOIN act a ON a.user_id = t.user_id"""
)
def daily_timeline_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newest 50 original posts per account, gated, cleaned, dated, with the account's statuses.

    Ranking and gate run on ids and times only; the texts are read and
    shuffled once, for the posts that are left.
    """
    events = _table(spark, sf_dir, "events")
    docs = _table(spark, sf_dir, "documents").select(F.col("doc_id").alias("event_id"), "text")
    posts = (
        events.filter(F.col("event_type") != "error")
        .select(
            "event_id", "user_id", "ts", columns.whole_number(F.col("value")).alias("favorite_count")
        )
        .join(docs.select("event_id"), "event_id", "left_semi")
    )
    posts = stage(posts, "posts")
    loaded = posts.filter(F.col("ts") < F.lit("2024-01-02").cast("timestamp_ntz"))
    mark = incremental.high_water_mark(
        loaded.withColumn("d", dates.day_of(F.col("ts"))), "d", DAY_2
    )
    newest = timeline.timeline_top_n(posts, "user_id", ("ts", "event_id"))
    # Stored, so that the planner knows whether the texts can be cut by them before they are shuffled.
    opened = stage(incremental.gate_timelines(newest, "user_id", "ts", mark.scalar()), "opened")
    statuses = events.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_status"))
    return (
        accounts.attach_account_metrics(opened, statuses, "user_id", metrics=["n_status"])
        .join(docs, "event_id")
        .select(
            "event_id",
            "user_id",
            text.clean_text(F.col("text")).alias("text"),
            dates.day_of(F.col("ts")).alias("date"),
            "favorite_count",
            "n_status",
        )
    )


@_query(
    f"""SELECT {CLEAN_SQL} AS text, n_chars AS favorite_count, CAST(user_id AS VARCHAR) AS "user",
               doc_id AS post_id, ts AS date_creation, CAST(ts AS DATE) AS date
        FROM documents JOIN events ON doc_id = event_id"""
)
def landing_intake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts landed as delimited text, then processed as a stream until nothing is left."""
    docs = _table(spark, sf_dir, "documents").join(
        _table(spark, sf_dir, "events"), F.col("doc_id") == F.col("event_id")
    )
    posts = docs.select(
        "text",
        F.col("n_chars").alias("favorite_count"),
        F.col("ts").cast("timestamp").alias("date_creation"),
        F.lit(0).cast("bigint").alias("retweet_count"),
        F.col("user_id").cast("string").alias("user"),
        F.col("doc_id").alias("post_id"),
        _no_time(),
    )
    root, schema = scratch_path(spark, "intake"), schemas.LANDING[fixed.POSTS]
    landing.write_landing(posts, root, fixed.POSTS)
    landed = intake.watch_landing(spark, landing.landing_path(root, fixed.POSTS), schema)
    done = processed.processed_path(root, "tweet")
    intake.process_landed(landed, done, f"{root}/state").awaitTermination()
    return intake.read_intake(spark, done, schema).select(
        "text", "favorite_count", "user", "post_id", F.col("date_creation").cast("timestamp_ntz").alias("date_creation"), "date"
    )


@_query(
    """SELECT event_type || CASE WHEN ts < TIMESTAMP '2024-01-16 00:00:00' THEN '' ELSE ' again' END AS text,
              CAST(user_id AS VARCHAR) AS "user", event_id AS post_id, CAST(ts AS DATE) AS date
       FROM events"""
)
def landing_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two collections of which the second has all posts of the first again, each run as a stream to its end."""
    events = _table(spark, sf_dir, "events")
    root, schema = scratch_path(spark, "overlap"), schemas.LANDING[fixed.POSTS]
    done = processed.processed_path(root, "tweet")
    early = F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")
    for chosen, suffix, collected in ((early, "", "2024-01-16"), (F.lit(True), " again", "2024-01-31")):
        posts = events.filter(chosen).select(
            F.concat("event_type", F.lit(suffix)).alias("text"),
            F.lit(1).cast("bigint").alias("favorite_count"),
            F.lit(0).cast("bigint").alias("retweet_count"),
            F.col("ts").cast("timestamp").alias("date_creation"),
            F.col("user_id").cast("string").alias("user"),
            F.col("event_id").alias("post_id"),
            F.lit(collected).cast("timestamp").alias("collected_at"),
        )
        landing.write_landing(posts, root, fixed.POSTS)
        landed = intake.watch_landing(spark, landing.landing_path(root, fixed.POSTS), schema)
        intake.process_landed(intake.first_of_posts(landed, "30 days"), done, f"{root}/state").awaitTermination()
    return intake.read_intake(spark, done, schema).select("text", "user", "post_id", "date")


# Two days of the real run. On the first, accounts of two in three numbers are collected, some of them
# twice, the later time with smaller counts; on the second, all accounts: known ones with newer posts
# and smaller counts, new ones with old posts only.
RUN_SQL = """posts AS (SELECT event_id, CAST(user_id AS VARCHAR) AS u, user_id, ts, CAST(ts AS DATE) AS d,
                      CAST(trunc(value) AS BIGINT) AS f, nullif(text, '') AS text
               FROM events JOIN documents ON event_id = doc_id),
    d1 AS (SELECT * FROM posts WHERE user_id % 3 <> 0 AND ts < TIMESTAMP '2024-01-15 00:00:00'),
    m1 AS (SELECT u, max(d) AS mark FROM d1 GROUP BY u),
    d2 AS (SELECT * FROM posts WHERE ts < CASE WHEN user_id % 3 = 0 THEN TIMESTAMP '2024-01-10 00:00:00'
                                               ELSE TIMESTAMP '2024-01-30 00:00:00' END),
    opened AS (SELECT d2.u FROM d2 LEFT JOIN m1 ON d2.u = m1.u GROUP BY d2.u, mark
               HAVING mark IS NULL OR max(d) > mark)"""


def _run_days(spark: SparkSession, sf_dir: str) -> str:
    """Runs the two days; returns the database. Texts meet their events and are packed once, for all collections."""
    docs = _table(spark, sf_dir, "documents").select(F.col("doc_id").alias("event_id"), "text")
    events = _table(spark, sf_dir, "events")
    root, db = scratch_path(spark, "run"), f"postline_{uuid.uuid4().hex}"
    new = F.col("user_id") % 3 == 0
    again = ~new & (F.col("user_id") % 5 == 1)
    early = lambda ts, some: some & (ts < F.lit("2024-01-15").cast("timestamp_ntz"))
    until = F.when(new, "2024-01-10").otherwise("2024-01-30").cast("timestamp_ntz")
    collections = (
        # (day of the run, hour, rows by time, likes added, followers)
        (15, 1, lambda ts: early(ts, ~new), 10, 1000),
        (15, 2, lambda ts: early(ts, again), 5, 900),
        (30, 1, lambda ts: ts < until, 0, 800),
    )
    at_any_time = reduce(Column.__or__, (chosen(F.col("ts")) for _, _, chosen, _, _ in collections))
    # Both tables go by pages, so that the posts of a page are where they are packed: texts are shuffled once.
    event = F.struct("user_id", "ts", columns.whole_number(F.col("value")).alias("likes"))
    listed = events.filter(at_any_time).groupBy("event_id").agg(F.collect_list(event).alias("events"))
    both = docs.withColumn("is_text", F.lit(True)).unionByName(listed, allowMissingColumns=True)
    paged = both.dropna(subset="event_id").withColumn("page", F.floor(F.col("event_id") / PAGE)).repartition("page")
    met = paged.withColumn("events", F.max("events").over(Window.partitionBy("page", "event_id"))).filter("is_text")
    posts = met.select("page", "event_id", "text", F.inline("events"))
    post = F.struct("text", "likes", "ts", F.col("event_id").alias("post_id"))
    packed = posts.groupBy("user_id", "page").agg(F.collect_list(post).alias("posts"))

    def collection(day: int, hour: int, chosen: Callable[[Column], Column], likes: int, followers: int) -> Column:
        as_collected = lambda post: F.struct(
            post["text"].alias("text"),
            (post["likes"] + likes).alias("favorite_count"),
            F.lit(0).cast("bigint").alias("retweet_count"),
            post["ts"].cast("timestamp").alias("created_at"),
            post["post_id"].alias("post_id"),
        )
        return F.struct(
            F.lit(day).alias("day"),
            F.lit(hour).alias("hour"),
            F.transform(F.filter("posts", lambda post: chosen(post["ts"])), as_collected).alias("posts"),
            F.lit(followers).alias("followers"),
            F.lit(f"2024-01-{day} 0{hour}:00:00").cast("timestamp").alias("collected_at"),
        )

    records = [collection(*each) for each in collections]
    collected = packed.select("user_id", F.inline(F.array(*records))).filter(F.size("posts") > 0)
    lists = [F.col(f"posts.{n}").alias(n) for n in ("text", "favorite_count", "retweet_count", "created_at", "post_id")]
    record = F.struct(
        (F.col("followers") - F.col("user_id")).alias("followers_count"),
        F.col("user_id").alias("following_count"),
        F.lit("2020-01-01").cast("timestamp").alias("created_at"),
        F.lit("a|b").alias("description"),
    )
    activity = F.struct(F.col("followers").alias("favoris_count"), F.col("user_id").alias("retweet_count"))
    payloads = collected.select(
        F.col("user_id").cast("string").alias("user"),
        F.struct(*lists).alias("TWEET_INFO"),
        record.alias("USER_INFO"),
        activity.alias("USER_ACTIVITY"),
        "collected_at",
        "day",
        "hour",
    )
    payload.write_payload(payloads, f"{root}/in", partition_by=("day", "hour"), compression="gzip")
    for day in (15, 30):
        daily.run_day(spark, f"{root}/in/day={day}/*", root, db, datetime.date(2024, 1, day), newest=None)
    return db


@_query(
    f"""WITH {RUN_SQL},
    fresh AS (SELECT * FROM d2 WHERE u IN (SELECT u FROM opened) AND event_id NOT IN (SELECT event_id FROM d1)),
    ids AS (SELECT event_id, row_number() OVER (ORDER BY d, u, event_id) AS id FROM d1
            UNION ALL SELECT event_id, (SELECT count(*) FROM d1) + row_number() OVER (ORDER BY d, u, event_id) FROM fresh)
    SELECT ids.id, {CLEAN_SQL.replace("text,", "p.text,")} AS text,
           CAST(f + CASE WHEN u IN (SELECT u FROM opened) THEN 0 WHEN user_id % 5 = 1 THEN 5 ELSE 10 END AS VARCHAR) AS favorite_count,
           '0' AS retweet_count, d AS date_creation, u AS "user", event_id AS post_id, d AS date
    FROM posts p JOIN ids USING (event_id)"""
)
def daily_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.scan(spark, f"{_run_days(spark, sf_dir)}.{fixed.POSTS_TABLE}")


@_query(
    f"""WITH {RUN_SQL},
    seen AS (SELECT u, user_id, CASE WHEN user_id % 5 = 1 THEN 900 ELSE 1000 END AS f, DATE '2024-01-15' AS day
             FROM d1 WHERE u NOT IN (SELECT u FROM opened)
             UNION SELECT u, user_id, 800, DATE '2024-01-30' FROM d2 WHERE u IN (SELECT u FROM opened))
    SELECT u AS "user", 'a|b' AS description, u AS following, CAST(f - user_id AS VARCHAR) AS followers,
           CAST(f AS VARCHAR) AS favorite_count, u AS retweet_count, DATE '2020-01-01' AS date_creation, day AS date
    FROM seen"""
)
def daily_run_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.scan(spark, f"{_run_days(spark, sf_dir)}.{fixed.ACCOUNTS_TABLE}")


@_query(
    """SELECT row_number() OVER (ORDER BY ts >= TIMESTAMP '2024-01-16 00:00:00', CAST(ts AS DATE),
                  CAST(user_id AS VARCHAR), CAST(trunc(value) AS BIGINT), event_id) AS id,
              event_type AS text, CAST(CAST(trunc(value) AS BIGINT) AS VARCHAR) AS favorite_count,
              CAST(event_id AS VARCHAR) AS retweet_count, CAST(ts AS DATE) AS date_creation,
              CAST(user_id AS VARCHAR) AS "user", CAST(NULL AS BIGINT) AS post_id, CAST(ts AS DATE) AS date
       FROM events"""
)
def posts_append_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts without post id in two batches: each row is added under the next id."""
    db, posts = _new_warehouse(spark), _event_posts(spark, sf_dir)
    half = F.col("date") < datetime.date(2024, 1, 16)
    for batch in (posts.filter(half), posts.filter(~half)):
        post_table.append_posts(spark, batch, db)
    return tables.scan(spark, f"{db}.{fixed.POSTS_TABLE}")


@_query(
    f"""SELECT row_number() OVER (ORDER BY CAST(ts AS DATE), n_chars, event_id) AS id, {CLEAN_SQL} AS text,
              CAST(n_chars AS VARCHAR) AS favorite_count, CAST(event_id AS VARCHAR) AS retweet_count,
              CAST(ts AS DATE) AS date_creation, 'ann' AS "user", CAST(NULL AS BIGINT) AS post_id,
              CAST(ts AS DATE) AS date
       FROM (SELECT event_id, ts, n_chars, nullif(text, '') AS text FROM documents JOIN events ON doc_id = event_id)"""
)
def bare_landing_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing files of one account without ids or its name, through the whole run."""
    joined = _table(spark, sf_dir, "documents").join(_table(spark, sf_dir, "events"), F.col("doc_id") == F.col("event_id"))
    time = F.lit("2020-01-01").cast("timestamp").alias("date_creation")
    one = spark.range(1)
    landed = {
        fixed.POSTS: joined.select(
            "text", F.col("n_chars").alias("favorite_count"), F.col("ts").cast("timestamp").alias("date_creation"),
            F.col("event_id").alias("retweet_count"),
        ),
        fixed.ACCOUNTS: one.select(F.col("id").alias("followers"), F.col("id").alias("following"), time, F.lit("d").alias("description")),
        fixed.ACTIVITY: one.select(F.col("id").alias("favorite_count"), F.col("id").alias("retweet_count")),
    }
    root, db = scratch_path(spark, "bare"), f"postline_{uuid.uuid4().hex}"
    for name, rows in landed.items():
        landing.write_delimited(rows, landing.landing_path(root, name))
    daily.run_day(spark, None, root, db, DAY_2, account="ann")
    return tables.scan(spark, f"{db}.{fixed.POSTS_TABLE}")
