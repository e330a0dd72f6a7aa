"""Long table of percent changes per period."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.functions.calendar import DAY, MONTH, Grain
from barloom.functions.returns import basis_rows
from barloom.operators.periods import period_open_close, with_previous_close


def as_double_prices(prices: DataFrame) -> DataFrame:
    return prices.withColumns({c: F.col(c).cast("double") for c in ("open", "close")})


def changes_of_prices(
    prices: DataFrame, basis: str = "both", carry: bool = False, grain: Grain = MONTH, as_double: bool = False
) -> DataFrame:
    """(market, year, period, basis, pct) from one open and close per period."""
    if as_double:
        prices = as_double_prices(prices)
    with_reference = with_previous_close(prices, grain, carry)
    rows = basis_rows(basis, F.col("open"), F.col("prev_close"), F.col("close"))
    return with_reference.select("market", "year", grain.column, F.inline(rows))


def monthly_changes(
    bars: DataFrame, basis: str = "both", carry: bool = False, as_double: bool = False, market: str | None = None
) -> DataFrame:
    """Percent change per calendar month, measured from the month's open or the previous close."""
    prices = period_open_close(of_market(bars, market), MONTH)
    return changes_of_prices(prices, basis, carry, MONTH, as_double)


def daily_changes(
    bars: DataFrame, basis: str = "both", carry: bool = False, as_double: bool = False, market: str | None = None
) -> DataFrame:
    """Percent change per calendar day with bars."""
    prices = period_open_close(of_market(bars, market), DAY)
    return changes_of_prices(prices, basis, carry, DAY, as_double)


def of_market(rows: DataFrame, market: str | None) -> DataFrame:
    return rows if market is None else rows.where(F.col("market") == market)
