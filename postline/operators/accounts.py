"""Accounts joined to their activity."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postline.functions.columns import whole_number
from postline.operators.timeline import latest_per_key

METRICS = ["retweet_count", "favorite_count"]


def attach_account_metrics(
    accounts: DataFrame,
    activity: DataFrame,
    key: str = "user",
    newest: list[str] | None = None,
    metrics: list[str] = METRICS,
) -> DataFrame:
    """Each account with its activity counts; NULL for an account without activity.

    `newest` orders an account's activity rows if it can have several. The two
    sides are left to the planner, which broadcasts one only if it is small.
    """
    if newest:
        activity = latest_per_key(activity, [key], newest)
    counts = activity.select(key, *(whole_number(F.col(name)).alias(name) for name in metrics))
    return accounts.join(counts, key, "left")


def attach_single_activity(
    accounts: DataFrame, activity: DataFrame, newest: list[str], metrics: list[str] = METRICS
) -> DataFrame:
    """For files of one account, without a key: the newest activity row on every account row.

    The row is a scalar subquery: it is computed once, by partial aggregation,
    and no account is lost if there is no activity.
    """
    counts = F.struct(*(whole_number(F.col(name)).alias(name) for name in metrics))
    latest = activity.agg(F.max_by(counts, F.struct(*newest)).alias("counts"))
    return accounts.withColumn("_counts", latest.scalar()).select(
        *accounts.columns, *(F.col(f"_counts.{name}").alias(name) for name in metrics)
    )
