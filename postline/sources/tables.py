"""Warehouse tables: creation, append by name, snapshots, upserts, scans.

    <db>.tweets           a view: one row per post (see `posts`)
    <db>.user_snapshots   one row per account and day, in date folders
    <db>.users            a view: one row per account, its latest state

The latest states are a table of their own, `user_states`, in which each run
writes a whole new state folder (`as_of`) from the last older one, and then
turns the view to it. So a run never overwrites what it reads, and a repeated
run replaces its own folder only.
"""

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postline import fixed_values as fixed
from postline import schemas
from postline.operators.layout import sort_key_layout
from postline.operators.timeline import latest_per_key
from postline.operators.upsert import replace_keys, require_keys, without_keys
from postline.session import stage
from postline.sources import posts
from postline.sources.processed import by_date

SNAPSHOTS_TABLE = "user_snapshots"
STATES_TABLE = "user_states"
DYNAMIC = "partitionOverwriteMode"


def _columns_sql(schema: T.StructType) -> str:
    return ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema)


def create_table(
    spark: SparkSession, table: str, schema: T.StructType, location: str, partition_by: list[str]
) -> None:
    """Create a table in folders where absent, over the data its location may hold already.

    Overwriting the table replaces only the folders that are written.
    """
    if spark.catalog.tableExists(table):
        return
    # Appending nothing makes sure that there is a folder to look for partitions in.
    nothing = spark.createDataFrame([], schema).limit(0)
    nothing.write.mode("append").partitionBy(*partition_by).parquet(location)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({_columns_sql(schema)}) USING parquet "
        f"OPTIONS ({DYNAMIC} 'dynamic', compression '{fixed.CODEC}') PARTITIONED BY ({', '.join(partition_by)}) LOCATION '{location}'"
    )
    spark.catalog.recoverPartitions(table)


def create_tables(spark: SparkSession, db: str, location: str) -> None:
    """Create the database, its tables and the view, where absent."""
    root = location.rstrip("/")
    accounts = schemas.WAREHOUSE[fixed.ACCOUNTS_TABLE]
    states = T.StructType([*accounts.fields, T.StructField("as_of", T.DateType())])
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{root}'")
    for name, schema, partition_by in (
        (posts.VERSIONS_TABLE, schemas.POST_VERSIONS, ["load", "date"]),
        (posts.KEYS_TABLE, schemas.POST_KEYS, ["run", "bucket"]),
        (SNAPSHOTS_TABLE, accounts, ["date"]),
        (STATES_TABLE, states, ["as_of"]),
    ):
        create_table(spark, f"{db}.{name}", schema, f"{root}/{name}", partition_by)
    if not spark.catalog.tableExists(f"{db}.{fixed.ACCOUNTS_TABLE}"):
        _show_state(spark, db, _last_state(spark, db))
    posts.show_last(spark, db)


def _last_state(spark: SparkSession, db: str) -> datetime.date | None:
    """The newest state, from the names of the folders."""
    last = spark.sql(f"SHOW PARTITIONS {db}.{STATES_TABLE}").agg(F.max("partition")).first()[0]
    return datetime.date.fromisoformat(last.split("=")[1]) if last else None


def _show_state(spark: SparkSession, db: str, as_of: datetime.date | None) -> None:
    """Turn the view to a state; the day is a literal, so no other folder is opened."""
    columns = ", ".join(f"`{name}`" for name in schemas.WAREHOUSE[fixed.ACCOUNTS_TABLE].fieldNames())
    shown = f"as_of = DATE '{as_of}'" if as_of else "false"
    spark.sql(
        f"CREATE OR REPLACE VIEW {db}.{fixed.ACCOUNTS_TABLE} AS "
        f"SELECT {columns} FROM {db}.{STATES_TABLE} WHERE {shown}"
    )


def scan(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)


def append_by_name(df: DataFrame, table: str) -> None:
    """Append to a table, matching columns by name; a column the frame lacks becomes NULL.

    `insertInto` would match by position and take swapped columns of one type
    without complaint. Posts need ids, and folders of their load.
    """
    if table.split(".")[-1] == fixed.POSTS_TABLE:
        raise ValueError("posts are added by append_posts")
    _in_table_order(df, table).write.mode("append").insertInto(table)


def _in_table_order(df: DataFrame, table: str) -> DataFrame:
    fields = df.sparkSession.table(table).schema.fields
    unknown = set(df.columns) - {field.name for field in fields}
    if unknown:
        raise ValueError(f"{table} has no column {', '.join(sorted(unknown))}")
    return df.select(
        *(
            (F.col(field.name) if field.name in df.columns else F.lit(None))
            .cast(field.dataType)
            .alias(field.name)
            for field in fields
        )
    )


def replace_partitions(df: DataFrame, table: str, partition_by: str, order: list[str]) -> None:
    """Replace the folders of the partition values in the frame, and no others.

    Files are sorted: by the partition, which the write needs, and by `order`,
    which gives narrow statistics and long runs of equal values.
    """
    gathered = by_date(_in_table_order(df, table), partition_by)
    _overwrite_partitions(gathered.sortWithinPartitions(partition_by, *order), table)


def _overwrite_partitions(df: DataFrame, table: str) -> None:
    # insertInto takes the mode from the table, not from the writer's options.
    # A table made elsewhere, without it, would lose all its other folders.
    if DYNAMIC not in df.sparkSession.sql(f"SHOW CREATE TABLE {table}").first()[0]:
        raise ValueError(f"{table} was not created with {DYNAMIC} dynamic")
    df.write.mode("overwrite").insertInto(table)


def _in_folders(target: DataFrame, dates: list[datetime.date | None]) -> DataFrame:
    """The target's rows of the dates, None for the folder of unknown dates. Only those folders are opened."""
    known = [day for day in dates if day is not None]
    touched = F.col("date").isin(known) if known else F.lit(False)
    return target.filter(touched | F.col("date").isNull() if None in dates else touched)


def _dates_of(*frames: DataFrame) -> list[datetime.date | None]:
    """The distinct dates: one value per calendar day."""
    dates = frames[0].select("date")
    for frame in frames[1:]:
        dates = dates.unionByName(frame.select("date"))
    days, unknown = dates.agg(F.sort_array(F.collect_set("date")), F.max(F.col("date").isNull())).first()
    return [*days, *([None] if unknown else [])]


def _one_per_account(accounts: DataFrame) -> DataFrame:
    keys = schemas.ACCOUNT_KEY
    first = [name for name in ("date", "collected_at") if name in accounts.columns]
    others = [name for name in accounts.columns if name not in (*first, *keys)]
    return latest_per_key(require_keys(accounts, keys), keys, [*first, *others])


def load_snapshot(spark: SparkSession, accounts: DataFrame, db: str) -> None:
    """Keep the accounts' state of their day.

    Loading an account again on a day replaces its state of that day; the other
    accounts and days stay.
    """
    table, keys = f"{db}.{SNAPSHOTS_TABLE}", [*schemas.ACCOUNT_KEY, "date"]
    batch = _one_per_account(accounts).drop("collected_at")
    batch = stage(_in_table_order(batch, table), "snapshot_batch")
    touched = _in_folders(spark.table(table), _dates_of(batch))
    kept = stage(without_keys(touched, batch, keys), "kept_snapshot")
    replace_partitions(kept.unionByName(batch), table, "date", schemas.ACCOUNT_KEY)


def day_snapshot(spark: SparkSession, db: str, day: datetime.date) -> DataFrame:
    return spark.table(f"{db}.{SNAPSHOTS_TABLE}").filter(F.col("date") == F.lit(day))


def load_accounts(
    spark: SparkSession, accounts: DataFrame, db: str, as_of: datetime.date
) -> None:
    """Upsert the accounts by name into the latest states.

    The new state starts from the newest one before `as_of` and replaces what a
    former run of the same day wrote, so `accounts` are all those loaded that
    day (see `day_snapshot`). Days are loaded in order: a day before the newest
    state is refused, as what it changes would not be seen.
    """
    table, keys = f"{db}.{STATES_TABLE}", schemas.ACCOUNT_KEY
    newest = _last_state(spark, db)
    if newest and newest > as_of:
        raise ValueError(f"the state of {newest} is loaded, {as_of} comes too late")
    states = spark.table(table)
    before = spark.sql(f"SHOW PARTITIONS {table}").filter(F.col("partition") < f"as_of={as_of}")
    last = before.agg(F.max("partition")).first()[0]
    last = states.filter(F.col("as_of") == last.split("=")[1] if last else F.lit(False))
    batch = _one_per_account(accounts).drop("collected_at").withColumn("as_of", F.lit(as_of))
    batch = stage(_in_table_order(batch, table), "account_batch")
    # Stored before it is laid out in ranges, which reads it twice.
    state = stage(replace_keys(last.withColumn("as_of", F.lit(as_of)), batch, keys), "account_state")
    _overwrite_partitions(sort_key_layout(_in_table_order(state, table), keys), table)
    _show_state(spark, db, as_of)

