"""States of accounts over time: validity intervals of daily snapshots, and the state that held at a time."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def validity_intervals(
    snapshots: DataFrame, keys: list[str], date: str, values: list[str], max_gap: int | None = None
) -> DataFrame:
    """keys, values, valid_from and valid_to: the runs of days over which the values of a key stay the same.

    `snapshots` has a row per key and day. `valid_to` is the first day on which
    the interval does not hold any more, NULL for the last one. A state holds
    until the next snapshot; with `max_gap`, until that many days after its
    last one at most, where the next comes later. Snapshots without a date say
    nothing. A key has a row per day at most, so its window is small.
    """
    by_day = Window.partitionBy(*keys).orderBy(date)
    known = snapshots.filter(F.col(date).isNotNull()).select(*keys, date, *values)
    state = F.struct(*values)
    before, last_day = F.lag(state).over(by_day), F.lag(date).over(by_day)
    starts = last_day.isNull() | ~state.eqNullSafe(before)
    if max_gap is not None:
        starts = starts | (F.date_diff(F.col(date), last_day) > max_gap)
    numbered = known.withColumn("_starts", starts.cast("int"))
    numbered = numbered.withColumn("_island", F.sum("_starts").over(by_day.rowsBetween(Window.unboundedPreceding, 0)))
    islands = numbered.groupBy(*keys, "_island").agg(
        F.min(date).alias("valid_from"), F.max(date).alias("_last"), *[F.any_value(name).alias(name) for name in values]
    )
    following = F.lead("valid_from").over(Window.partitionBy(*keys).orderBy("valid_from"))
    if max_gap is not None:
        following = F.least(following, F.when(following.isNotNull(), F.date_add("_last", max_gap)))
    return islands.withColumn("valid_to", following).select(*keys, *values, "valid_from", "valid_to")


def as_of_join(
    facts: DataFrame, states: DataFrame, keys: list[str], fact_time: str, state_time: str, values: list[str], period: str = "day"
) -> DataFrame:
    """The facts with the values of their key's last state at or before their time; NULL if there is none.

    No range join: facts and states go through one sorted pass, in which the
    last state seen is carried on. The pass is cut into periods, so that a hot
    key spreads over as many tasks as it has periods; into each period goes the
    state that the one before ends with, worked out from one row per key and
    period. Of several states at one time the one with the greatest values
    counts. Facts without key or time have no state; states without take no part.
    """
    first = [*keys, "_period"]
    cut = lambda time: F.date_trunc(period, F.col(time).cast("timestamp"))
    known = states.filter(F.col(state_time).isNotNull()).dropna(subset=keys)
    known = known.select(*keys, cut(state_time).alias("_period"), F.col(state_time).alias("_time"), F.struct(*values).alias("_state"))
    dated = facts.withColumn("_period", cut(fact_time)).withColumn("_time", F.col(fact_time))

    ends = known.groupBy(*first).agg(F.max(F.struct("_time", "_state")).alias("_end"))
    periods = dated.select(*first).dropna().distinct().withColumn("_end", F.lit(None).cast(ends.schema["_end"].dataType))
    in_order = Window.partitionBy(*keys).orderBy("_period").rowsBetween(Window.unboundedPreceding, -1)
    summed = ends.unionByName(periods).groupBy(*first).agg(F.max("_end").alias("_end"))
    carried = summed.withColumn("_end", F.last("_end", ignorenulls=True).over(in_order)).filter("_end IS NOT NULL")
    carried = carried.select(*first, F.col("_end._time").alias("_time"), F.col("_end._state").alias("_state"))

    # Of rows at one time the states come first.
    events = known.unionByName(carried).withColumn("_is_fact", F.lit(False))
    passed = dated.withColumn("_is_fact", F.lit(True)).unionByName(events, allowMissingColumns=True)
    order = Window.partitionBy(*first).orderBy("_time", "_is_fact", "_state")
    held = F.last("_state", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    joined = passed.withColumn("_held", F.when(F.col("_time").isNotNull(), held)).filter("_is_fact")
    return joined.select(*facts.columns, *[F.col(f"_held.{name}").alias(name) for name in values])
