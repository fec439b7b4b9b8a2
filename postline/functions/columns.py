"""Casts and stamps."""

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postline import schemas
from postline.functions.dates import processing_day


def whole_number(metric: Column) -> Column:
    """Cut a metric to a whole number, toward zero."""
    return metric.cast("bigint")


def stamp_day(df: DataFrame, as_of: datetime.date | None = None) -> DataFrame:
    return df.withColumn("date", processing_day(as_of))


def stamp_account(df: DataFrame, account: str) -> DataFrame:
    """The account name as a constant, for landing files that do not carry it."""
    return df.withColumn("user", F.lit(account))


def warehouse_types(df: DataFrame, table: str) -> DataFrame:
    """The table's columns that the frame has, by name, in the table's types."""
    return df.select(
        *(
            F.col(field.name).cast(field.dataType).alias(field.name)
            for field in schemas.WAREHOUSE[table].fields
            if field.name in df.columns
        )
    )
