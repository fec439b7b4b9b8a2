"""Landed posts to processed posts."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postline.functions.dates import day_of
from postline.functions.text import clean_text


def transform_posts(posts: DataFrame) -> DataFrame:
    """Clean the texts and derive the date."""
    return posts.withColumns(
        {"text": clean_text(F.col("text")), "date": day_of(F.col("date_creation"))}
    )
