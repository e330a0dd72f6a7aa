"""Text to typed values. Every conversion gives null on bad input instead of failing the job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Format of the time field of a bar file, and its length.
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
TIME_LENGTH = 19


def bar_time(text: Column) -> Column:
    """The first 19 characters as a timestamp."""
    return F.try_to_timestamp(F.substring(text, 1, TIME_LENGTH), F.lit(TIME_FORMAT))


def price(text: Column, price_type: str) -> Column:
    """A number written with a decimal comma; null when it is no number or does not fit the type."""
    return F.replace(F.trim(text), F.lit(","), F.lit(".")).try_cast(price_type)


def comma_text(number: Column) -> Column:
    """The way back: a number as text with a decimal comma."""
    return F.replace(number.cast("string"), F.lit("."), F.lit(","))


def time_text(time: Column) -> Column:
    return F.date_format(time, TIME_FORMAT)


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def flag(text: Column) -> Column:
    """Text ``true`` / ``false`` to boolean, null for anything else."""
    return text.try_cast("boolean")


def whole_second(time: Column) -> Column:
    return F.date_trunc("second", time)


def never() -> Column:
    """The time that stands for "never loaded"."""
    return F.timestamp_seconds(F.lit(0))
