"""Upsert by key."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postline.operators.timeline import latest_per_key
from postline.session import stage


def require_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Fail the job on a row whose key is NULL: such rows cannot be matched."""
    return df.withColumns(
        {
            key: F.when(F.col(key).isNotNull(), F.col(key)).otherwise(
                F.raise_error(F.lit(f"NULL in key column {key}"))
            )
            for key in keys
        }
    )


def without_keys(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """The target's rows whose key the source does not have.

    For a source that is stored: the planner then knows its size, and a small
    one leaves the target unshuffled.
    """
    return target.join(source.select(*keys), keys, "left_anti").select(*target.columns)


def replace_keys(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """The target without the source's keys, and the source, which has one row per key."""
    return without_keys(target, source, keys).unionByName(source.select(*target.columns))


def upsert_by_key(
    target: DataFrame, source: DataFrame, keys: list[str], newest: list[str]
) -> DataFrame:
    """The target with the source's newest row of each key put in or added.

    The source is cut to one row per key first, so no key is large in the
    join, and stored, so that it is worked out once for both of its uses.
    """
    batch = stage(latest_per_key(require_keys(source, keys), keys, newest), "upsert_batch")
    return replace_keys(target, batch, keys)
