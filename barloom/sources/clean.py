"""Text rows to typed bars. Bad rows are told apart, counted and kept, never fatal."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.functions.parsing import bar_time, price
from barloom.schemas import BAD_LINE, DEFAULT_PRICE_TYPE


def tag_load(rows: DataFrame, market: str, load_id: str, load_time: datetime) -> DataFrame:
    """Attach which market, load and load time the rows belong to."""
    return rows.withColumns(
        {"load_time": F.lit(load_time).cast("timestamp"), "market": F.lit(market), "load_id": F.lit(load_id)}
    )


def _reason() -> Column:
    """Why a row is no valid bar; null for a valid one. The first reason counts."""

    def bad_price(name: str) -> Column:
        return F.coalesce(F.col(name) == 0, F.lit(True))

    return (
        F.when(F.col(BAD_LINE).isNotNull(), "field count")
        .when(F.col("time").isNull(), "time")
        .when(bad_price("open"), "open")
        .when(bad_price("close"), "close")
        .when(F.col("market").isNull(), "market")
        .when(F.col("load_time").isNull(), "load time")
    )


def parse_bars(raw: DataFrame, price_type: str = DEFAULT_PRICE_TYPE) -> DataFrame:
    """Typed time, open and close, plus ``reject_reason``. Other columns pass through."""
    if BAD_LINE not in raw.columns:
        raw = raw.withColumn(BAD_LINE, F.lit(None).cast("string"))
    typed = F.struct(
        bar_time(F.col("time")).alias("time"),
        price(F.col("open"), price_type).alias("open"),
        price(F.col("close"), price_type).alias("close"),
    )
    others = [c for c in raw.columns if c not in ("time", "open", "close")]
    # Unnested from an array of one: a filter on plain columns would be pushed below the
    # conversion by repeating it, and every text would be parsed twice.
    rows = raw.select(*others, F.inline(F.array(typed)))
    return rows.withColumn("reject_reason", _reason())


def valid_bars(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("reject_reason").isNull()).drop("reject_reason", BAD_LINE)


def rejected_bars(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col("reject_reason").isNotNull())


def clean_bars(raw: DataFrame, price_type: str = DEFAULT_PRICE_TYPE) -> DataFrame:
    return valid_bars(parse_bars(raw, price_type))
