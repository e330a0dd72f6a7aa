"""Calendar grains: how a time maps to a period, and how periods are named as columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Column names of the month table, January first.
MONTH_NAMES = [
    "january", "february", "march", "april", "may", "june",
    "july", "august", "september", "october", "november", "december",
]
# Column names of the weekday table, Monday first.
WEEKDAY_NAMES = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]


@dataclass(frozen=True)
class Grain:
    """A period inside a year. ``column`` orders the periods of one year."""

    column: str

    def of(self, time: Column) -> Column:
        return F.month(time) if self.column == "month" else F.to_date(time)


MONTH = Grain("month")
DAY = Grain("day")


def with_period(bars: DataFrame, grain: Grain) -> DataFrame:
    """Add ``year`` and the grain column. An existing ``year`` (a partition column) is kept as it is."""
    if "year" not in bars.columns:
        bars = bars.withColumn("year", F.year("time"))
    return bars.withColumn(grain.column, grain.of(F.col("time")))


def weekday_number(day: Column) -> Column:
    """Monday is 0."""
    return F.weekday(day)
