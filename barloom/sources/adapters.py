"""Other tables seen as price bars: (market, time, open, close), one row per market and time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def sample_table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def orders_bars(orders: DataFrame) -> DataFrame:
    """Daily bars per order priority: price of the first and of the last order of the day."""
    return (
        orders.groupBy(F.col("o_orderpriority").alias("market"), F.col("o_orderdate").alias("time"))
        .agg(
            F.min_by("o_totalprice", "o_orderkey").alias("open"),
            F.max_by("o_totalprice", "o_orderkey").alias("close"),
        )
    )


def lineitem_bars(lineitem: DataFrame) -> DataFrame:
    """Daily bars per return flag. Line keys repeat, so the price itself ends the order."""
    order = F.struct("l_orderkey", "l_linenumber", "l_extendedprice")
    return (
        lineitem.groupBy(F.col("l_returnflag").alias("market"), F.col("l_shipdate").alias("time"))
        .agg(
            F.min_by("l_extendedprice", order).alias("open"),
            F.max_by("l_extendedprice", order).alias("close"),
        )
    )


def events_bars(events: DataFrame) -> DataFrame:
    """One bar per event; an event type has no two events at one time."""
    return events.select(
        F.col("event_type").alias("market"),
        F.col("ts").alias("time"),
        F.col("value").alias("open"),
        F.col("value").alias("close"),
    )


def order_ticks(orders: DataFrame) -> DataFrame:
    """Every order as a bar of its own: days repeat, ``seq`` tells which row is newer."""
    return orders.select(
        F.col("o_orderpriority").alias("market"),
        F.col("o_orderdate").alias("time"),
        F.col("o_totalprice").alias("open"),
        F.col("o_totalprice").alias("close"),
        F.col("o_orderkey").alias("seq"),
    )
