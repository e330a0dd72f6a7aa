"""Reading persisted tables, and small literal ones."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def table_or_empty(spark: SparkSession, name: str, schema: T.StructType) -> DataFrame:
    """The table, or no rows of the given schema if it does not exist yet."""
    if spark.catalog.tableExists(name):
        return spark.table(name)
    return spark.createDataFrame([], schema)


def literal_rows(spark: SparkSession, rows: Iterable[tuple], schema: T.StructType) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)
