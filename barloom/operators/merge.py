"""Newest row wins, upsert by key, and replacement of whole slices.

Parquet tables know no MERGE, UPDATE or DELETE. These operators compute the new content as a plan;
``barloom.sinks`` writes it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_wins(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the one with the largest ``order``, and of equals the one with the largest values.

    An aggregation, not a window: copies of one key are folded before the shuffle, so a key re-sent
    in a third of all rows is no hot spot. Each column travels once.
    """
    values = [c for c in rows.columns if c not in keys and c not in order]
    newest = F.max(F.struct(*order, *values)).alias("newest")
    return rows.groupBy(*keys).agg(newest).select(*keys, "newest.*").select(*rows.columns)


def only_keys(rows: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is among the wanted ones (IN)."""
    return rows.join(wanted.select(*keys), keys, "left_semi")


def except_keys(rows: DataFrame, unwanted: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is not among the unwanted ones (NOT EXISTS)."""
    return rows.join(unwanted.select(*keys), keys, "left_anti")


def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """New rows replace old rows of equal key, all others stay. Keys must be unique in ``new``."""
    return except_keys(old, new, keys).unionByName(new)


def replace_slices(old: DataFrame, new: DataFrame, slices: DataFrame, keys: list[str]) -> DataFrame:
    """Everything outside the slices stays; the slices are what ``new`` holds."""
    return except_keys(old, slices, keys).unionByName(new)
