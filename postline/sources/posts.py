"""The table of posts: folders that are written once, and commits that say which of them it consists of.

    <db>.post_versions    posts, in folders of loads and dates
    <db>.post_keys        where each post is: account, post id, id, date, load; in folders of runs and buckets
    <root>/post_commits   a folder per load: the folders and runs that make up the table after it
    <db>.tweets           a view of the folders that the last commit names

A load writes new folders beside those that are shown, then its commit, and
last turns the view. A reader sees the table before the load or after it,
never a part; a load that breaks off leaves the table as it was, or, if its
commit is stored, is shown by whoever opens the table next. A date none of
whose posts change is added to, by one more folder; only dates with posts that
change or leave are written anew. Earlier states can be read for as long as
their commits are kept.

Keys are kept in runs, which are merged like this: FANOUT runs of a level
become one of the next. So after k loads some log(k) runs are there to be
looked through, and a key has been rewritten log(k) times.
"""

import datetime
from collections import defaultdict
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from postline import fixed_values as fixed
from postline import schemas
from postline.operators.checks import has_copies
from postline.operators.layout import sort_key_layout, surrogate_id
from postline.operators.timeline import latest_per_key
from postline.operators.upsert import require_keys, without_keys
from postline.session import require_utc, stage
from postline.sources import folders

VERSIONS_TABLE = "post_versions"
KEYS_TABLE = "post_keys"
COMMITS = "post_commits"
# The view's property that names the commit it shows.
SHOWN = "postline.load"
# Commits that stay readable, the last one included.
KEPT = 3
# Runs of a level that are merged into one of the next, and folders of a date that are written into one.
FANOUT = 4
MOST_FOLDERS = 8
# Keys in a bucket of a run; buckets are a power of two, so that those of one run nest in those of another.
BUCKET_KEYS = 1 << 20
MOST_BUCKETS = 4096
# Fixed value: the folder of NULL.
UNKNOWN_DATE = "__HIVE_DEFAULT_PARTITION__"

Day = datetime.date | None


@dataclass(frozen=True)
class Run:
    number: int
    level: int
    buckets: int


@dataclass(frozen=True)
class Commit:
    """`dates`: the loads whose folders hold the posts of a date. `gone`: folders (load, date) no longer named."""

    load: int = 0
    last_id: int = 0
    dates: dict[Day, tuple[int, ...]] = field(default_factory=dict)
    runs: tuple[Run, ...] = ()
    gone: tuple[tuple[int, Day], ...] = ()
    gone_runs: tuple[Run, ...] = ()


def _root(spark: SparkSession, db: str) -> str:
    return spark.catalog.getDatabase(db).locationUri.rstrip("/")


def _commit_path(spark: SparkSession, db: str, load: int) -> str:
    return f"{_root(spark, db)}/{COMMITS}/load={load}"


# Commits


def commits(spark: SparkSession, db: str) -> list[int]:
    """The loads whose states can be read, in order. A commit counts once it is stored whole."""
    found = folders.names(spark, f"{_root(spark, db)}/{COMMITS}")
    loads = sorted(int(name.split("=")[1]) for name in found if name.startswith("load="))
    return [load for load in loads if folders.exists(spark, f"{_commit_path(spark, db, load)}/_SUCCESS")]


def read_commit(spark: SparkSession, db: str, load: int) -> Commit:
    """A commit has a row per date and folder, and per run: a few per calendar day."""
    rows = spark.read.schema(schemas.POST_COMMIT).parquet(_commit_path(spark, db, load))
    by_kind = defaultdict(list)
    for row in rows.agg(F.collect_list(F.struct(*rows.columns))).first()[0]:
        by_kind[row.kind].append(row)
    dates: dict[Day, tuple[int, ...]] = {}
    for row in sorted(by_kind["posts"], key=lambda row: row.number):
        dates[row.date] = (*dates.get(row.date, ()), row.number)
    runs = {
        kind: tuple(Run(row.number, row.level, row.buckets) for row in sorted(by_kind[kind], key=lambda row: row.number))
        for kind in ("run", "gone_run")
    }
    gone = tuple((row.number, row.date) for row in by_kind["gone"])
    return Commit(load, by_kind["last_id"][0].number, dates, runs["run"], gone, runs["gone_run"])


def last_commit(spark: SparkSession, db: str) -> Commit:
    known = commits(spark, db)
    return read_commit(spark, db, known[-1]) if known else Commit()


def _write_commit(spark: SparkSession, db: str, commit: Commit) -> None:
    rows = [("last_id", commit.last_id, None, None, None)]
    rows += [("posts", load, day, None, None) for day, loads in commit.dates.items() for load in loads]
    rows += [("gone", load, day, None, None) for load, day in commit.gone]
    rows += [("run", run.number, None, run.level, run.buckets) for run in commit.runs]
    rows += [("gone_run", run.number, None, run.level, run.buckets) for run in commit.gone_runs]
    stored = spark.createDataFrame(rows, schemas.POST_COMMIT).coalesce(2)
    stored.write.mode("overwrite").parquet(_commit_path(spark, db, commit.load))


def _is_day(days: list[Day]) -> str:
    known = ", ".join(f"DATE '{day}'" for day in sorted(day for day in days if day))
    return " OR ".join([*([f"date IN ({known})"] if known else []), *(["date IS NULL"] if None in days else [])])


def _named(dates: dict[Day, tuple[int, ...]]) -> str:
    """The folders as a condition, which is checked against names of folders alone."""
    by_load = defaultdict(list)
    for day, loads in dates.items():
        for load in loads:
            by_load[load].append(day)
    return " OR ".join(f"(load = {load} AND ({_is_day(days)}))" for load, days in sorted(by_load.items())) or "false"


def _columns() -> str:
    return ", ".join(f"`{name}`" for name in schemas.WAREHOUSE[fixed.POSTS_TABLE].fieldNames())


def _shown(spark: SparkSession, db: str) -> int | None:
    view = f"{db}.{fixed.POSTS_TABLE}"
    if not spark.catalog.tableExists(view):
        return None
    value = spark.sql(f"SHOW TBLPROPERTIES {view}").filter(F.col("key") == SHOWN).select("value").first()
    return int(value[0]) if value else None


def _show(spark: SparkSession, db: str, commit: Commit) -> None:
    """The switch: one statement of the catalog."""
    spark.sql(
        f"CREATE OR REPLACE VIEW {db}.{fixed.POSTS_TABLE} TBLPROPERTIES ('{SHOWN}' = '{commit.load}') AS "
        f"SELECT {_columns()} FROM {db}.{VERSIONS_TABLE} WHERE {_named(commit.dates)}"
    )


def show_last(spark: SparkSession, db: str) -> bool:
    """Turn the view to the last commit, if it shows another; returns whether it did."""
    known = commits(spark, db)
    last = known[-1] if known else 0
    if _shown(spark, db) == last:
        return False
    _show(spark, db, read_commit(spark, db, last) if last else Commit())
    return True


def posts_after(spark: SparkSession, db: str, load: int) -> DataFrame:
    """The table as it was after a load, for as long as its commit is kept."""
    if load not in commits(spark, db):
        raise ValueError(f"the state after load {load} is not kept")
    stored = spark.table(f"{db}.{VERSIONS_TABLE}")
    named = stored.filter(_named(read_commit(spark, db, load).dates))
    return named.select(*schemas.WAREHOUSE[fixed.POSTS_TABLE].fieldNames())


def _drop(spark: SparkSession, table: str, parts: dict[str, str | int | None]) -> None:
    """Remove a folder of a table, and its name from the catalog."""
    sql = ", ".join(f"{name} = {'NULL' if value is None else repr(value)}" for name, value in parts.items())
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({sql})")
    path = "/".join(f"{name}={UNKNOWN_DATE if value is None else value}" for name, value in parts.items())
    db, name = table.split(".")
    folders.remove(spark, f"{_root(spark, db)}/{name}/{path}")


def _drop_run(spark: SparkSession, db: str, run: Run) -> None:
    path = f"{_root(spark, db)}/{KEYS_TABLE}/run={run.number}"
    for name in folders.names(spark, path):
        if name.startswith("bucket="):
            _drop(spark, f"{db}.{KEYS_TABLE}", {"run": run.number, "bucket": int(name.split("=")[1])})
    folders.remove(spark, path)


def expire(spark: SparkSession, db: str, keep: int = KEPT) -> None:
    """Give up all commits but the last `keep`, and the folders that only they name. May be repeated."""
    known = commits(spark, db)
    for load, after in zip(known[:-keep], known[1:], strict=False):
        # What this commit names and the next does not, no later one names again.
        following = read_commit(spark, db, after)
        for number, day in following.gone:
            _drop(spark, f"{db}.{VERSIONS_TABLE}", {"load": number, "date": day and str(day)})
            if not [name for name in folders.names(spark, f"{_root(spark, db)}/{VERSIONS_TABLE}/load={number}") if "=" in name]:
                folders.remove(spark, f"{_root(spark, db)}/{VERSIONS_TABLE}/load={number}")
        for run in following.gone_runs:
            _drop_run(spark, db, run)
        folders.remove(spark, _commit_path(spark, db, load))


def _clear(spark: SparkSession, db: str, load: int) -> None:
    """Remove what a load of this number, which has broken off, may have left."""
    path = f"{_root(spark, db)}/{VERSIONS_TABLE}/load={load}"
    for day in _days_in(spark, path):
        _drop(spark, f"{db}.{VERSIONS_TABLE}", {"load": load, "date": day and str(day)})
    folders.remove(spark, path)
    _drop_run(spark, db, Run(load, 0, 1))
    folders.remove(spark, _commit_path(spark, db, load))


def _days_in(spark: SparkSession, path: str) -> list[Day]:
    values = [name.split("=", 1)[1] for name in folders.names(spark, path) if name.startswith("date=")]
    return [None if value == UNKNOWN_DATE else datetime.date.fromisoformat(value) for value in values]


# Keys


def buckets_for(keys: int) -> int:
    return min(MOST_BUCKETS, 1 << max(0, -(-keys // BUCKET_KEYS) - 1).bit_length())


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("user"), F.lit(buckets)).cast("int")


def to_merge(runs: tuple[Run, ...]) -> tuple[Run, ...]:
    """The runs, of all levels that are full, that become one; none if no level is."""
    merged: list[Run] = []
    level = 0
    while True:
        here = [run for run in runs if run.level == level]
        if len(here) + bool(merged) < FANOUT:
            return tuple(merged)
        merged += here
        level += 1


def _keys_in(spark: SparkSession, db: str, runs: tuple[Run, ...], buckets: set[int] | None = None) -> DataFrame:
    """The rows of the runs, in the buckets of accounts; only those folders are opened.

    `buckets` are those of the run with the most buckets; None for all.
    """
    named = []
    for run in runs:
        own = "" if buckets is None else ", ".join(str(b) for b in sorted({b % run.buckets for b in buckets}))
        named.append(f"(run = {run.number}{f' AND bucket IN ({own})' if own else ''})")
    return spark.table(f"{db}.{KEYS_TABLE}").filter(" OR ".join(named) if named and buckets != set() else "false")


def _keys_of(spark: SparkSession, db: str, runs: tuple[Run, ...], accounts: DataFrame) -> DataFrame:
    most = max((run.buckets for run in runs), default=1)
    if most == 1:
        return _keys_in(spark, db, runs)
    touched = accounts.select(_bucket(most).alias("bucket")).agg(F.collect_set("bucket")).first()[0]
    return _keys_in(spark, db, runs, set(touched))


def latest_places(keys: DataFrame) -> DataFrame:
    """user, post_id, id, date and load, a row per post: the latest load says where it is."""
    latest = keys.groupBy("user", "post_id", "id").agg(F.max(F.struct("load", "date")).alias("_at"))
    return latest.select("user", "post_id", "id", "_at.date", "_at.load")


def known_posts(spark: SparkSession, db: str, batch: DataFrame, commit: Commit | None = None) -> DataFrame:
    """user, post_id, id and date of the batch's posts that are loaded."""
    commit = commit or last_commit(spark, db)
    keys = schemas.POST_KEY
    found = _keys_of(spark, db, commit.runs, batch).join(batch.select(*keys).distinct(), keys, "left_semi")
    return latest_places(found).drop("load")


def account_marks(spark: SparkSession, db: str, accounts: DataFrame) -> DataFrame:
    """user and mark: the newest date of the accounts' loaded posts. Reads keys, not posts."""
    found = _keys_of(spark, db, last_commit(spark, db).runs, accounts)
    found = found.join(accounts.select("user").distinct(), "user", "left_semi")
    return latest_places(found).groupBy("user").agg(F.max("date").alias("mark"))


# Loads


def _batch(posts: DataFrame, stored: bool) -> DataFrame:
    """One row per named post, all others, and `_row`, a number of its own for each row without post id.

    Texts are shuffled only if there are copies, which are looked for on the keys alone.
    """
    carried = [name for name in ("collected_at",) if name in posts.columns]
    # Without the time of the collection, the copy with the greater counts is taken for the later one.
    newest = [*carried, "favorite_count", "retweet_count", "date_creation", "text", "date"]
    whole = require_keys(posts if stored else stage(posts, "unloaded_posts"), ["user"])
    named, others = whole.filter(F.col("post_id").isNotNull()), whole.filter(F.col("post_id").isNull())
    if has_copies(named, schemas.POST_KEY):
        named = stage(latest_per_key(named, schemas.POST_KEY, newest), "post_batch")
    named = named.withColumn("_row", F.lit(None).cast("bigint"))
    if others.isEmpty():
        return named
    return named.unionByName(stage(others.withColumn("_row", F.monotonically_increasing_id()), "unnamed_posts"))


def _placed(batch: DataFrame, known: DataFrame | None, last_id: int) -> DataFrame:
    """_row, user, post_id, date, id and, of known posts, `_known` and the date `_from`. Narrow columns only.

    New posts get the next ids, those with post id first, by date, account and post id.
    """
    keys = schemas.POST_KEY
    order = [name for name in ("collected_at", "favorite_count", "retweet_count", "date_creation") if name in batch.columns]
    narrow = batch.select("_row", *keys, "date", *order, F.col("post_id").isNull().alias("_unnamed"))
    fresh = narrow if known is None else without_keys(narrow, known, keys)
    numbered = surrogate_id(fresh, ["_unnamed", "date", *keys, *order, "_row"], start=last_id + 1)
    columns = ["_row", *keys, "date", "id"]
    nowhere = {"_known": F.lit(False), "_from": F.lit(None).cast("date")}
    rows = numbered.select(*columns).withColumns(nowhere)
    if known is not None:
        there = known.select(*keys, "id", F.col("date").alias("_from"), F.lit(True).alias("_known"))
        rows = rows.unionByName(narrow.select("_row", *keys, "date").join(there, keys))
    return stage(rows, "placed_posts")


def load_posts(spark: SparkSession, posts: DataFrame, db: str, stored: bool = False) -> None:
    """Upsert the posts; a known post keeps its id, a new one gets the next.

    Posts are known by account and post id, whatever date they are stored
    under: one that has moved leaves its old folder. Posts without post id are
    added, each with the next id. Dates with changed posts are written anew,
    others are added to, and the rest is not touched. Ids are found and
    numbered on narrow columns; whole posts are shuffled once, in which they
    meet their ids and are laid out by date. The rows that are read and written
    are counted on the way; a load in which they do not add up is not committed.
    Posts that are `stored` are read where they are, as often as needed; others
    are stored first.
    """
    require_utc(spark)
    before = last_commit(spark, db)
    load = before.load + 1
    _clear(spark, db, load)
    batch = _batch(posts, stored)
    rows, named = batch.agg(F.count(F.lit(1)), F.count("post_id")).first()
    known = None
    if named and before.runs:
        known = stage(known_posts(spark, db, batch.filter("post_id IS NOT NULL"), before), "known_posts")
    placed = _placed(batch, known, before.last_id)
    changed, unknown, fresh, moved = placed.agg(
        F.collect_set(F.when(F.col("_known"), F.col("_from"))),
        F.max(F.col("_known") & F.col("_from").isNull()),
        F.count_if(~F.col("_known")),
        F.count_if(F.col("_known") & ~F.col("_from").eqNullSafe(F.col("date"))),
    ).first()
    full = [day for day, loads in before.dates.items() if len(loads) >= MOST_FOLDERS]
    anew = {*changed, *([None] if unknown else []), *full}

    written = _write_folders(spark, db, load, before, anew, batch, placed, known, rows, rows - fresh)
    dates = {day: loads for day, loads in before.dates.items() if day not in anew}
    dates |= {day: (*dates.get(day, ()), load) for day in written}
    gone = tuple((number, day) for day in anew for number in before.dates.get(day, ()))
    runs, merged = _write_keys(spark, db, load, before.runs, placed, fresh + moved)
    commit = Commit(load, before.last_id + fresh, dates, runs, gone, merged)
    _write_commit(spark, db, commit)
    _show(spark, db, commit)
    expire(spark, db)


def _part(kind: str, rows: DataFrame, own: Column) -> DataFrame:
    """Rows in the table's types with their kind, and `_own`, which tells those without post id apart."""
    own = F.when(F.col("post_id").isNull(), own).cast("bigint")
    fields = [field for field in schemas.WAREHOUSE[fixed.POSTS_TABLE] if field.name in rows.columns]
    typed = [F.col(field.name).cast(field.dataType).alias(field.name) for field in fields]
    return rows.select(*typed, own.alias("_own"), F.lit(kind).alias("_kind"))


def _staying(stored: DataFrame, known: DataFrame | None) -> tuple[DataFrame, int]:
    """The stored posts that are not `known`, and how many are stored. By id, which all of them have.

    Which they are is found on ids alone. Texts are then looked through with
    the shorter list, of those that stay or of those that leave.
    """
    count = stored.count()
    if known is None:
        return stored, count
    leaving = known.select("id")
    staying = stage(stored.select("id").join(leaving, "id", "left_anti"), "staying_posts")
    if staying.count() <= leaving.count():
        return stored.join(staying, "id", "left_semi"), count
    return stored.join(leaving, "id", "left_anti"), count


def _write_folders(
    spark: SparkSession, db: str, load: int, before: Commit, anew: set[Day], batch: DataFrame,
    placed: DataFrame, known: DataFrame | None, rows: int, replaced: int,
) -> list[Day]:
    """Write the folders of a load: the batch, and what stays of the dates that are written anew. Returns their dates.

    Posts and the ids of the batch go through one shuffle, in ranges of date
    and key. There a post meets its id, and from there it is written: no join
    shuffles the texts of a batch, however many posts it has.
    """
    table, columns = f"{db}.{VERSIONS_TABLE}", schemas.WAREHOUSE[fixed.POSTS_TABLE].fieldNames()
    held = {day: before.dates[day] for day in anew if day in before.dates}
    parts, read = [_part("new", batch, F.col("_row")), _part("id", placed, F.col("_row"))], 0
    if held:
        stays, read = _staying(spark.table(table).filter(_named(held)), known)
        # Of stored posts without post id the ids, negative ones, as numbers of rows are not.
        parts.append(_part("old", stays, -F.col("id")))
    if rows or held:
        whole = reduce(lambda one, other: one.unionByName(other, allowMissingColumns=True), parts)
        place, found = ["date", *schemas.POST_KEY, "_own"], Observation()
        given = F.max(F.when(F.col("_kind") == "id", F.col("id"))).over(Window.partitionBy(*place))
        met = sort_key_layout(whole, place).withColumn("_id", F.when(F.col("_kind") == "new", given).otherwise(F.col("id")))
        met = met.filter((F.col("_kind") != "id") & F.col("_id").isNotNull())
        # Counted behind the shuffle: ranges are found by reading what is ahead of it once more.
        met = met.observe(found, F.count_if(F.col("_kind") == "new").alias("batch"), F.count_if(F.col("_kind") == "old").alias("kept"))
        written = met.withColumns({"id": F.col("_id"), "load": F.lit(load).cast("bigint")})
        written.select(*columns[:-1], "load", "date").write.mode("overwrite").insertInto(table)
        n = {name: found.get.get(name, 0) for name in ("batch", "kept")}
        if n["batch"] != rows or (held and read - n["kept"] != replaced):
            raise RuntimeError(f"load {load}: {n} of {read} stored rows do not match {rows} new ones, {replaced} of them known")
    return _days_in(spark, f"{_root(spark, db)}/{VERSIONS_TABLE}/load={load}")


def _write_keys(
    spark: SparkSession, db: str, load: int, runs: tuple[Run, ...], placed: DataFrame, entries: int
) -> tuple[tuple[Run, ...], tuple[Run, ...]]:
    """Write the run of a load, merged with earlier ones where a level is full. Returns the runs, and those merged."""
    if not entries:
        return runs, ()
    # How many keys a merged run has is known roughly: by the buckets of its parts.
    new = Run(load, 0, buckets_for(entries))
    merged = to_merge((*runs, new))
    moved = ~F.col("_known") | ~F.col("_from").eqNullSafe(F.col("date"))
    rows = placed.filter(moved).select(*schemas.POST_KEY, "id", "date", F.lit(load).cast("bigint").alias("load"))
    if merged:
        buckets = min(MOST_BUCKETS, buckets_for(BUCKET_KEYS * sum(run.buckets for run in merged)))
        new = Run(load, max(run.level for run in merged) + 1, buckets)
        parts = tuple(run for run in merged if run.number != load)
        rows = latest_places(_keys_in(spark, db, parts).select(*rows.columns).unionByName(rows))
    rows = rows.withColumns({"run": F.lit(load).cast("bigint"), "bucket": _bucket(new.buckets)})
    gathered = rows.hint("rebalance", F.col("bucket")).select(*schemas.POST_KEYS.fieldNames())
    gathered.write.mode("overwrite").insertInto(f"{db}.{KEYS_TABLE}")
    left = tuple(run for run in runs if run not in merged)
    return (*left, new), tuple(run for run in merged if run.number != load)


def append_posts(spark: SparkSession, posts: DataFrame, db: str) -> None:
    """Add posts that have no post id, each with the next id. Writes new folders only."""
    load_posts(spark, posts.withColumn("post_id", F.lit(None).cast("bigint")), db)
