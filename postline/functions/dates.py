"""Date expressions. A session in UTC is assumed; malformed values become NULL."""

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from postline import fixed_values as fixed


def day_text(instant: Column) -> Column:
    """The first ten characters, as text."""
    return F.substring(instant.cast("string"), 1, fixed.DAY_LENGTH)


def date_prefix(instant: Column) -> Column:
    """The date in the first ten characters of a timestamp or of its text."""
    return F.try_to_date(day_text(instant), fixed.DAY_FORMAT)


def day_of(instant: Column) -> Column:
    """The date of a typed timestamp, without a detour over text."""
    return instant.cast("date")


def parse_creation(text: Column) -> Column:
    """The timestamp of a text that ends in the literal offset +00:00."""
    return F.try_to_timestamp(text, F.lit(fixed.CREATION_FORMAT))


def creation_day(text: Column) -> Column:
    return F.to_date(parse_creation(text))


def iso_day(day: Column) -> Column:
    return F.date_format(day, fixed.DAY_FORMAT)


def time_of_day(instant: Column) -> Column:
    return F.date_format(instant, fixed.TIME_FORMAT)


def processing_day(as_of: datetime.date | None = None) -> Column:
    """The run's date: given, so that a run can be repeated, or today's."""
    return F.current_date() if as_of is None else F.lit(as_of)
