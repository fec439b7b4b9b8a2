"""The daily run: land, gate, transform, load."""

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postline import fixed_values as fixed
from postline import schemas
from postline.functions.columns import stamp_account, stamp_day
from postline.functions.dates import date_prefix, day_text
from postline.operators.accounts import METRICS, attach_account_metrics
from postline.operators.checks import has_copies, require_rows
from postline.operators.incremental import opened_accounts, rows_of_opened
from postline.operators.posts import transform_posts
from postline.operators.timeline import latest_per_key, timeline_top_n
from postline.session import require_utc, sized_shuffles, stage
from postline.sources import folders, landing, payload, processed, tables
from postline.sources import posts as post_table

# Of copies the one that was collected last stands; the rest only decides between copies of one collection.
POST_COPIES = ["collected_at", "favorite_count", "retweet_count", "date_creation", "text"]
ACCOUNT_COPIES = ["collected_at", "followers", "following", "date_creation", "description"]
REJECTED = "_rejected"
# A bare landing file is small in columns, not in rows: parsed texts take about this times its bytes in memory.
SPREAD = 2


def one_per_post(posts: DataFrame) -> DataFrame:
    """The posts without copies. Posts without post id are not known to be copies and all stay."""
    named = latest_per_key(posts.filter(F.col("post_id").isNotNull()), schemas.POST_KEY, POST_COPIES)
    return named.unionByName(posts.filter(F.col("post_id").isNull()))


def land(
    spark: SparkSession, payload_path: str, root: str, newest: int | None = fixed.TIMELINE_LENGTH
) -> None:
    """Flatten collected timelines into the three landing tables.

    Of each account the `newest` posts of the run are landed, or all if None.
    """
    # Read through and stored without the texts first: a malformed payload fails before the last landing is
    # replaced, and the texts are shuffled only if there are copies.
    whole = payload.read_payload(spark, payload_path)
    collected = stage(payload.without_texts(whole), "payload")
    posts, narrow = (payload.exclude_reposts(payload.timeline_rows(part)) for part in (whole, collected))
    if has_copies(narrow.filter(F.col("post_id").isNotNull()), schemas.POST_KEY):
        posts = one_per_post(posts)
    order = ("date_creation", "post_id", *POST_COPIES)
    posts = timeline_top_n(posts, newest=tuple(dict.fromkeys(order)), n=newest)
    landing.write_landing(posts, root, fixed.POSTS)
    landing.write_landing(payload.profile_rows(collected), root, fixed.ACCOUNTS)
    landing.write_landing(payload.activity_rows(collected), root, fixed.ACTIVITY)


def transform_accounts(
    accounts: DataFrame, activity: DataFrame, as_of: datetime.date | None
) -> DataFrame:
    """Cut the creation time to its date text, stamp the day, attach the activity counts.

    Of an account that was collected several times, the last collection stands.
    """
    accounts = latest_per_key(accounts, schemas.ACCOUNT_KEY, ACCOUNT_COPIES)
    dated = accounts.withColumn("date_creation", day_text(F.col("date_creation")))
    activity = activity.select("user", "collected_at", *METRICS)
    return attach_account_metrics(stamp_day(dated, as_of), activity, newest=["collected_at", *METRICS])


def _set_aside(rows: DataFrame, root: str, table: str) -> DataFrame:
    """The stored rows of a landing table without those fields that could not be parsed, which are written apart."""
    bad = rows.filter(F.col(REJECTED).isNotNull()).select(F.col(REJECTED).alias("value"))
    if not bad.isEmpty():
        bad.write.mode("overwrite").text(f"{root.rstrip('/')}/rejected/{table}")
    return rows.drop(REJECTED)


def _of_account(rows: DataFrame, table: str, account: str | None) -> DataFrame:
    """All columns of a landing table, for files without account, post id and time of collection, all of one `account`."""
    if account is None:
        return rows
    missing = [field for field in schemas.LANDING[table] if field.name not in (*rows.columns, "user")]
    return stamp_account(rows, account).withColumns(
        {field.name: F.lit(None).cast(field.dataType) for field in missing}
    )


def _landed(spark: SparkSession, root: str, table: str, account: str | None) -> DataFrame:
    """The rows of a landing table, parsed once; what could not be parsed is set aside."""
    rows = landing.read_landing(spark, root, table, bare=account is not None, rejected=REJECTED)
    return _of_account(_set_aside(stage(rows, f"landed_{table.lower()}"), root, table), table, account)


def _landed_posts(spark: SparkSession, root: str, account: str | None) -> tuple[DataFrame, DataFrame]:
    """The landed posts, to be parsed where they are used, and without their texts, stored. As `_landed` otherwise."""
    table = fixed.POSTS
    rows = landing.read_landing(spark, root, table, bare=account is not None, rejected=REJECTED)
    narrow = _set_aside(stage(rows.drop("text"), f"landed_{table.lower()}"), root, table)
    return tuple(_of_account(part, table, account) for part in (rows.drop(REJECTED), narrow))


def _pending(root: str) -> str:
    """Says that the processed zone is not loaded yet, and of which day it is."""
    return processed.processed_path(root, "pending")


def transform(
    spark: SparkSession, root: str, db: str, as_of: datetime.date, account: str | None = None
) -> bool:
    """Landing to processed zone, for the accounts that have newer posts than are loaded.

    `account` is whose the landing files are, if they do not say so. Returns
    whether there are any newer posts; if not, the processed zone stays as it is.
    """
    posts, narrow = _landed_posts(spark, root, account)
    marks = post_table.account_marks(spark, db, narrow)
    opened = stage(opened_accounts(narrow, "user", "date_creation", marks), "opened_accounts")
    if opened.isEmpty():
        return False
    processed.write_processed(
        transform_posts(rows_of_opened(posts, "user", narrow, opened)),
        processed.processed_path(root, "tweet"),
    )
    accounts = _landed(spark, root, fixed.ACCOUNTS, account).join(opened, "user", "left_semi")
    activity = _landed(spark, root, fixed.ACTIVITY, account)
    processed.write_processed(
        transform_accounts(accounts, activity, as_of), processed.processed_path(root, "user")
    )
    unloaded = spark.createDataFrame([(as_of, post_table.last_commit(spark, db).load)], schemas.UNLOADED)
    unloaded.write.mode("overwrite").parquet(_pending(root))
    return True


def load(spark: SparkSession, root: str, db: str, as_of: datetime.date) -> None:
    """Processed zone to tables. Posts come last: they move the mark that opens a batch again."""
    path = processed.processed_path(root, "user")
    accounts = processed.read_processed(spark, path, schemas.PROCESSED[fixed.ACCOUNTS])
    accounts = accounts.withColumn("date_creation", date_prefix(F.col("date_creation")))
    tables.load_snapshot(spark, accounts, db)
    tables.load_accounts(spark, tables.day_snapshot(spark, db, as_of), db, as_of)
    path = processed.processed_path(root, "tweet")
    posts = processed.read_processed(spark, path, schemas.PROCESSED[fixed.POSTS])
    post_table.load_posts(spark, posts, db, True)
    for table in (fixed.ACCOUNTS_TABLE, fixed.POSTS_TABLE):
        require_rows(tables.scan(spark, f"{db}.{table}"), table)
    folders.remove(spark, _pending(root))


def resume(spark: SparkSession, root: str, db: str) -> bool:
    """Complete what an earlier run has processed and not loaded; returns whether there was anything."""
    shown = post_table.show_last(spark, db)
    if not folders.exists(spark, f"{_pending(root)}/_SUCCESS"):
        return shown
    unloaded = spark.read.schema(schemas.UNLOADED).parquet(_pending(root)).first()
    if post_table.last_commit(spark, db).load > unloaded["load"]:
        # Posts are loaded last, so all of the batch is in the tables.
        folders.remove(spark, _pending(root))
    else:
        load(spark, root, db, unloaded["date"])
    return True


def run_day(
    spark: SparkSession,
    payload_path: str | None,
    root: str,
    db: str,
    as_of: datetime.date,
    newest: int | None = fixed.TIMELINE_LENGTH,
    account: str | None = None,
) -> bool:
    """One daily run; returns whether it loaded anything. Running a day again changes nothing.

    What an earlier run has left unfinished is completed first. Without a
    payload, what lies in the landing zone is processed; `account` is whose it
    is, if its files do not say so.
    """
    require_utc(spark)
    tables.create_tables(spark, db, f"{root.rstrip('/')}/warehouse")
    resumed = resume(spark, root, db)
    source = payload_path or f"{root.rstrip('/')}/{fixed.LANDING_ZONE}"
    with sized_shuffles(spark, SPREAD * folders.size_of(spark, source)):
        if payload_path:
            land(spark, payload_path, root, newest)
        if not transform(spark, root, db, as_of, account):
            return resumed
        load(spark, root, db, as_of)
    return True
