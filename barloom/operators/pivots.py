"""Wide year-by-period tables with a total column and an average row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.functions.calendar import MONTH_NAMES, WEEKDAY_NAMES, weekday_number
from barloom.operators.changes import daily_changes, monthly_changes
from barloom.schemas import TOTAL


def pivot_periods(
    changes: DataFrame, number: Column, names: dict[int, str], missing: str = "null", cell: str = "sum"
) -> DataFrame:
    """One row per (market, year, basis), one column per period number, and the sum of all as ``total``.

    All cells and the total come out of one aggregation; the value list is explicit, so no extra
    job looks for it. ``missing='zero'`` turns empty cells into 0, which then count in averages.
    """
    if missing not in ("null", "zero"):
        raise ValueError(f"missing must be 'null' or 'zero', not {missing!r}")
    if cell not in ("sum", "avg"):
        raise ValueError(f"cell must be 'sum' or 'avg', not {cell!r}")
    fold = F.sum if cell == "sum" else F.avg

    def filled(column: Column) -> Column:
        return F.coalesce(column, F.lit(0)) if missing == "zero" else column

    cells = [filled(fold(F.when(number == k, F.col("pct")))).alias(name) for k, name in names.items()]
    return changes.groupBy("market", "year", "basis").agg(*cells, filled(fold("pct")).alias(TOTAL))


def pivot_months(changes: DataFrame, missing: str = "null") -> DataFrame:
    return pivot_periods(changes, F.col("month"), dict(enumerate(MONTH_NAMES, start=1)), missing)


def pivot_weekdays(changes: DataFrame, missing: str = "null", cell: str = "sum") -> DataFrame:
    return pivot_periods(changes, weekday_number(F.col("day")), dict(enumerate(WEEKDAY_NAMES)), missing, cell)


def average_row(wide: DataFrame, names: list[str]) -> DataFrame:
    """Mean of the yearly rows per (market, basis). Rows that are averages themselves are left out."""
    yearly = wide.where(F.col("year").cast("string") != TOTAL)
    means = [F.avg(n).alias(n) for n in [*names, TOTAL]]
    return yearly.groupBy("market", "basis").agg(*means).withColumn("year", F.lit(TOTAL))


def with_total_row(wide: DataFrame, names: list[str]) -> DataFrame:
    """Yearly rows plus their average row.

    Each yearly row goes to two groups, its own year and ``total``. The mean of a single row is that
    row, so one aggregation gives both kinds and the plan below runs once. A union of the rows with
    their average would read the bars a second time wherever Spark cannot reuse the exchange.
    """
    both = F.explode(F.array(F.col("year").cast("string"), F.lit(TOTAL)))
    cells = [*names, TOTAL]
    rows = wide.select("market", "basis", both.alias("year"), *cells)
    return rows.groupBy("market", "year", "basis").agg(*[F.avg(n).alias(n) for n in cells])


def display_order(overview: DataFrame) -> DataFrame:
    """For showing only: years upwards, then the average row."""
    return overview.orderBy("market", "basis", "year")


def overview_of_changes(changes: DataFrame, missing: str = "null") -> DataFrame:
    """Year by month table with the average row, from the long table."""
    return with_total_row(pivot_months(changes, missing), MONTH_NAMES)


def monthly_overview(
    bars: DataFrame,
    basis: str = "both",
    carry: bool = False,
    missing: str = "null",
    as_double: bool = False,
    market: str | None = None,
) -> DataFrame:
    """Bars to the year by month table."""
    return overview_of_changes(monthly_changes(bars, basis, carry, as_double, market), missing)


def weekday_overview(
    bars: DataFrame,
    basis: str = "both",
    carry: bool = False,
    missing: str = "null",
    as_double: bool = False,
    market: str | None = None,
    cell: str = "sum",
) -> DataFrame:
    """The same table by day of week: a cell folds the changes of all such days of the year."""
    changes = daily_changes(bars, basis, carry, as_double, market)
    return with_total_row(pivot_weekdays(changes, missing, cell), WEEKDAY_NAMES)
