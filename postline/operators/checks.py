"""Checks after a load."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def row_presence(df: DataFrame) -> DataFrame:
    """One row: are there rows? Stops at the first."""
    return df.limit(1).agg((F.count(F.lit(1)) > 0).alias("has_rows"))


def require_rows(df: DataFrame, name: str) -> None:
    if df.isEmpty():
        raise RuntimeError(f"no rows were loaded into {name}")


def has_copies(df: DataFrame, keys: list[str]) -> bool:
    """Whether several rows share a key. Reads and shuffles the keys alone."""
    return not df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") > 1).isEmpty()
