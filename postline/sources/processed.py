"""The processed zone: Parquet in one folder per date, delimited text on request."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postline import fixed_values as fixed
from postline.sources.landing import write_delimited


def processed_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{fixed.PROCESSED_ZONE}/{table}"


def by_date(df: DataFrame, date: str = "date") -> DataFrame:
    """Gather rows by date before a write into date folders.

    Rebalancing splits a date that holds much of the data into files of the
    advisory size and merges small ones; a plain repartition by date would
    give each date, whatever its size, to one task.
    """
    return df.hint("rebalance", F.col(date))


def write_processed(
    df: DataFrame, path: str, date: str = "date", replace_dates: bool = False
) -> None:
    """Write date folders; replace the whole zone table, or only the dates in the frame."""
    options = {"partitionOverwriteMode": "dynamic" if replace_dates else "static", "compression": fixed.CODEC}
    by_date(df, date).write.mode("overwrite").options(**options).partitionBy(date).parquet(path)


def read_processed(spark: SparkSession, path: str, schema=None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def export_processed(df: DataFrame, path: str) -> None:
    """The processed table as delimited text, written by all tasks at once."""
    write_delimited(df, path)
