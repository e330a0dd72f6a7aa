"""What is new since a watermark, and which slices a load touched."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions.parsing import never
from barloom.schemas import SLICE_KEY, TOTAL


def newer_than(rows: DataFrame, marks: DataFrame, time: str, mark: str, keys: list[str]) -> DataFrame:
    """Rows later than the mark of their key; a key without a mark was never done, so all of it is new.

    ``marks`` has at most one row per key.
    """
    marked = rows.join(marks.select(*keys, mark), keys, "left")
    return marked.where(F.col(time) > F.coalesce(F.col(mark), never())).drop(mark)


def slices_of(rows: DataFrame) -> DataFrame:
    return rows.select(*SLICE_KEY).distinct()


def slice_counts(rows: DataFrame) -> DataFrame:
    """(market, year, rows)."""
    return rows.groupBy(*SLICE_KEY).agg(F.count(F.lit(1)).alias("rows"))


def filled(slices: DataFrame) -> DataFrame:
    """Slices with rows, for a semi join that should read only those partitions of a table.

    Spark prunes partitions by a join only if the other side has a filter of its own. A slice that is
    listed has rows, so this one takes nothing away.
    """
    return slices.where(F.col("rows") > 0).select(*SLICE_KEY)


def yearly_rows(overview: DataFrame) -> DataFrame:
    return overview.where(F.col("year") != TOTAL)


def total_rows(overview: DataFrame) -> DataFrame:
    return overview.where(F.col("year") == TOTAL)


def any_row(rows: DataFrame, condition: Column | None = None) -> bool:
    """Existence test: stops at the first row found."""
    return not (rows if condition is None else rows.where(condition)).isEmpty()


def any_per_key(rows: DataFrame, keys: list[str], condition: Column, name: str) -> DataFrame:
    """Existence test for every key at once: one pass, a row per key and task reaches the shuffle."""
    return rows.groupBy(*keys).agg(F.bool_or(F.coalesce(condition, F.lit(False))).alias(name))


def refresh_reach(prices: DataFrame, changed: DataFrame, carry: bool) -> DataFrame:
    """Slices whose changes can differ after ``changed`` slices got new bars.

    Without carry a change depends on its own year only. With carry the first period of a year is
    measured from the last close before it, so the next year with prices is touched too, also if the
    changed one has no prices any more. Works on the years of the price table, a handful of rows per market.
    """
    if not carry:
        return changed.select(*SLICE_KEY)
    years = slices_of(prices.select(*SLICE_KEY).unionByName(changed.select(*SLICE_KEY)))
    hit = changed.select(*SLICE_KEY).distinct().withColumn("hit", F.lit(True))
    before = Window.partitionBy("market").orderBy("year")
    return (
        years.join(hit, SLICE_KEY, "left")
        .withColumn("hit_before", F.lag("hit").over(before))
        .where(F.coalesce("hit", F.lit(False)) | F.coalesce("hit_before", F.lit(False)))
        .select(*SLICE_KEY)
    )
