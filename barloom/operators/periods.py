"""First open and last close per period, and the close of the period before."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions.calendar import MONTH, Grain, with_period


def period_open_close(
    bars: DataFrame, grain: Grain = MONTH, tie: str | Column | None = None
) -> DataFrame:
    """Open of the first and close of the last bar of each (market, year, period).

    One aggregation with a map-side half: a market that holds a third of all bars arrives at the shuffle
    as one row per period and task. With ``tie`` (a load order, larger is newer) bars need not be unique
    per time: the newest bar of the first and of the last time counts, so no shuffle of the bars is
    spent on making them unique.
    """
    time = F.col("time")
    if tie is None:
        open_price, close_price = F.min_by("open", time), F.max_by("close", time)
    else:
        newest = (F.col(tie) if isinstance(tie, str) else tie).alias("newest")
        earlier = (-F.unix_micros(time.cast("timestamp"))).alias("earlier")
        open_price = F.max_by("open", F.struct(earlier, newest))
        close_price = F.max_by("close", F.struct(time, newest))
    return (
        with_period(bars, grain)
        .groupBy("market", "year", grain.column)
        .agg(open_price.alias("open"), close_price.alias("close"))
    )


def with_previous_close(prices: DataFrame, grain: Grain = MONTH, carry: bool = False) -> DataFrame:
    """Add ``prev_close``: the close of the period before, or the own open where there is none.

    By default the year starts anew; with ``carry`` January continues from the last period of the
    year before. Input is at most one row per period, so a window partition is small.
    """
    if carry:
        window = Window.partitionBy("market").orderBy("year", grain.column)
    else:
        window = Window.partitionBy("market", "year").orderBy(grain.column)
    return prices.withColumn("prev_close", F.coalesce(F.lag("close").over(window), F.col("open")))


def with_previous_value(
    rows: DataFrame, key: str, order: list[str], value: str, bucket: Column, name: str, default: Column | None = None
) -> DataFrame:
    """Add ``name``: the value of the row before, in the whole series of a key, without one task holding the series.

    ``bucket`` is a range of the order, such as the day of a time, never smaller for a later row. Inside a
    bucket the row before is looked up by a window; the first row of a bucket takes the last value of the
    nearest bucket before it that has rows, from a table of one row per bucket. So a task holds a bucket, and
    only the buckets of a key are put in one order. ``order`` tells rows of a key apart; where it ties, any of
    them comes first. The first row of a key has ``default``, or null; a null value is carried as null.
    """
    cut = rows.withColumn("_bucket", bucket)
    inside = Window.partitionBy(key, "_bucket").orderBy(*order)
    ends = cut.groupBy(key, "_bucket").agg(F.max(F.struct(*order, F.col(value).alias("_value"))).alias("_end"))
    before = ends.select(
        key, "_bucket", F.lag(F.struct(F.col("_end._value").alias("v"))).over(Window.partitionBy(key).orderBy("_bucket")).alias("_before")
    )
    looked = cut.withColumn("_inside", F.lag(F.struct(F.col(value).alias("v"))).over(inside))
    found = looked.join(before, [key, "_bucket"], "left")
    previous = F.coalesce("_inside", "_before")
    filled = previous["v"] if default is None else F.when(previous.isNull(), default).otherwise(previous["v"])
    return found.withColumn(name, filled).drop("_bucket", "_inside", "_before")


def with_previous_bar_close(bars: DataFrame, bucket: str = "day") -> DataFrame:
    """Bars of any grain with ``prev_close``, the close of the market's bar before; the own open where there is none.

    For bars as fine as seconds, where a market's series is too much for one window: tasks hold a market's
    ``bucket`` ('year', 'day', 'hour', ...) of bars. Times are unique per market.
    """
    return with_previous_value(bars, "market", ["time"], "close", F.date_trunc(bucket, "time"), "prev_close", F.col("open"))
