"""Newest rows per account, latest date, preview."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postline import fixed_values as fixed


def _first_n(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= n).drop("_rank")


def newest_per_key(df: DataFrame, keys: list[str], newest: list[str], n: int) -> DataFrame:
    """The n newest rows of each key; `newest` must order the rows of a key without ties.

    One shuffle of whole rows, ahead of which each input task keeps only its
    own n newest rows of a key. So the task where a key's rows meet gets n rows
    of it from each input task at most, however hot the key is.
    """
    return _first_n(df, keys, [F.col(column).desc() for column in newest], n)


def timeline_top_n(
    posts: DataFrame,
    account: str = "user",
    newest: tuple[str, ...] = ("date_creation", "post_id"),
    n: int | None = fixed.TIMELINE_LENGTH,
) -> DataFrame:
    """The n newest posts of each account; all of them if n is None."""
    return posts if n is None else newest_per_key(posts, [account], list(newest), n)


def latest_per_key(df: DataFrame, keys: list[str], newest: list[str]) -> DataFrame:
    """One row per key, the newest. An input task passes on one row of a key, be it hot or not."""
    return newest_per_key(df, keys, newest, 1)


def max_date(df: DataFrame, date: str) -> DataFrame:
    """The greatest date, as one row; NULL if there is none."""
    return df.agg(F.max(date).alias(date))


def latest_date(df: DataFrame, date: str) -> DataFrame:
    """The first date in descending order; no row if there is none. NULL dates do not count."""
    return df.select(date).filter(F.col(date).isNotNull()).orderBy(F.col(date).desc()).limit(1)


def preview(df: DataFrame, order: list[str] | None = None, n: int = fixed.PREVIEW_ROWS) -> DataFrame:
    """A few rows: any, or the first in an order."""
    return df.limit(n) if order is None else df.orderBy(*order).limit(n)
