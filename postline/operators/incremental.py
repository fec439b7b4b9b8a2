"""High-water mark and batch gate."""

import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postline.functions.dates import processing_day
from postline.session import stage


def _day_before(as_of: datetime.date | None) -> Column:
    return F.date_sub(processing_day(as_of), 1)


def high_water_mark(loaded: DataFrame, date: str, as_of: datetime.date | None = None) -> DataFrame:
    """The newest loaded date, as one row `mark`; the day before the run if nothing is loaded."""
    return loaded.agg(F.coalesce(F.max(F.col(date)), _day_before(as_of)).alias("mark"))


def marks_per_key(loaded: DataFrame, keys: list[str], date: str) -> DataFrame:
    """The newest loaded date of each key."""
    return loaded.groupBy(*keys).agg(F.max(F.col(date)).alias("mark"))


def at_granularity(time: str, granularity: str) -> Column:
    """What is compared with the mark: the day, or the exact time."""
    if granularity not in ("day", "timestamp"):
        raise ValueError(f"granularity is day or timestamp, not {granularity}")
    return F.col(time).cast("date") if granularity == "day" else F.col(time)


def gate_batch(
    batch: DataFrame, time: str, mark: DataFrame, granularity: str = "day"
) -> DataFrame:
    """The whole batch if its newest time is past the mark, else nothing. No shuffle of the batch."""
    newest = batch.agg(F.max(at_granularity(time, granularity)).alias("newest"))
    return batch.filter(newest.scalar() > mark.select("mark").scalar())


def _newest_times(rows: DataFrame, batch: list[str], time: str, granularity: str) -> DataFrame:
    """Aggregated partially before the shuffle, so a batch may be of any size."""
    return rows.groupBy(*batch).agg(F.max(at_granularity(time, granularity)).alias("newest"))


def gate_batches(
    rows: DataFrame, batch: list[str], time: str, mark: DataFrame, granularity: str = "day"
) -> DataFrame:
    """All rows of the batches whose newest time is past the mark.

    The accepted batches are stored, so that the planner knows their size:
    small, they are broadcast and the rows are not shuffled; large, the join is
    sort-merge with skewed batches split.
    """
    newest = _newest_times(rows, batch, time, granularity)
    accepted = newest.filter(F.col("newest") > mark.select("mark").scalar()).select(*batch)
    return rows.join(stage(accepted, "accepted_batches"), batch, "left_semi")


def opened_accounts(
    posts: DataFrame,
    account: str,
    time: str,
    marks: DataFrame,
    granularity: str = "day",
) -> DataFrame:
    """The accounts whose newest post is past their own mark (see `marks_per_key`).

    An account of which nothing is loaded is open, however old its posts are.
    """
    newest = _newest_times(posts, [account], time, granularity)
    opened = F.col("mark").isNull() | (F.col("newest") > F.col("mark"))
    return newest.join(marks, account, "left").filter(opened).select(account)


def rows_of_opened(rows: DataFrame, account: str, accounts: DataFrame, opened: DataFrame) -> DataFrame:
    """The rows whose account is opened, of `accounts`, which are all that the rows have.

    The shorter list, of the opened or of the other accounts, is stored and
    looked through: on most days few accounts are closed, or few are open, so
    it is small enough to leave the rows unshuffled.
    """
    known = accounts.select(account).filter(F.col(account).isNotNull()).distinct()
    closed = stage(known.join(opened, account, "left_anti"), "closed_accounts")
    if opened.count() <= closed.count():
        return rows.join(opened, account, "left_semi")
    return rows.filter(F.col(account).isNotNull()).join(closed, account, "left_anti")


def gate_timelines(
    timelines: DataFrame, account: str, time: str, mark: Column, granularity: str = "day"
) -> DataFrame:
    """Whole timelines of the accounts whose newest post is past the mark.

    For timelines already cut to their newest posts: the window then finds the
    rows where that cut left them, without a shuffle, and its groups are small.
    """
    newest = F.max(at_granularity(time, granularity)).over(Window.partitionBy(account))
    return timelines.withColumn("_newest", newest).filter(F.col("_newest") > mark).drop("_newest")
