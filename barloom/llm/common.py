"""Helpers the operators share."""

from __future__ import annotations

from collections.abc import Callable
from typing import TypeVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from barloom.session import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

# One byte to one byte, so places in the result are places in the source: A-Z to a-z, other
# ASCII that is no letter or digit to a space, bytes of longer characters as they are.
WORD_BYTES = bytes(
    b if b >= 0x80 or chr(b).isdigit() else ord(chr(b).lower()) if chr(b).isalpha() else 0x20 for b in range(256)
)


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{directory}/{name}.parquet")


def keep(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared folder, read back: a lost executor costs no recomputation
    beyond it, and what was drawn once (samples, salts) stays as it was drawn."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, nothing else changed."""
    return F.translate(text, UPPER, LOWER)


def word_list(text: str | None) -> list[bytes]:
    """Runs of ASCII letters, digits and characters beyond ASCII, A-Z in lower case, as UTF-8."""
    return text.encode().translate(WORD_BYTES).split() if text else []


Built = TypeVar("Built")
_built: dict[str, object] = {}


def built_once(key: str, make: Callable[[], Built]) -> Built:
    """What a Python worker builds from shared data, kept for its next tasks; the last one only."""
    if key not in _built:
        _built.clear()
        _built[key] = make()
    return _built[key]


def ranked(rows: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """Adds place (from 0, without gaps) and total (rows) of each row within its group, in the order given.

    Ranges of (group, order) are sorted side by side and numbered, and the counts of the ranges before
    are added: a group that holds a third of all rows, or all, is spread over as many tasks as its
    rows fill. ``order`` must be total but for rows that may change places; ``group`` has no nulls.
    """
    by_range = rows.repartitionByRange(F.col(group), *order).sortWithinPartitions(group, *order)
    numbered = by_range.withColumn("_at", F.monotonically_increasing_id())
    low = (1 << 33) - 1
    sorted_rows = keep(
        numbered.withColumn("_part", F.shiftright("_at", 33)).withColumn("_at", F.col("_at").bitwiseAND(low)), name
    )
    counts = sorted_rows.groupBy(group, "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    earlier = W.partitionBy(group).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select(
        group, "_part",
        (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_n").over(W.partitionBy(group)).alias("total"),
    )
    placed = sorted_rows.join(offsets, [group, "_part"])
    return placed.withColumn("place", F.col("_at") + F.col("_shift")).drop("_at", "_part", "_shift")
