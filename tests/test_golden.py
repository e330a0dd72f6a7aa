"""Results known from elsewhere: two days of bars, and two years of month prices."""

from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from barloom.functions.calendar import MONTH_NAMES
from barloom.operators.changes import changes_of_prices, monthly_changes
from barloom.operators.pivots import average_row, overview_of_changes
from barloom.schemas import prices_schema
from barloom.sources.clean import clean_bars, tag_load
from barloom.sources.files import read_bars
from conftest import ts

# First open and last close of the two days.
DAYS = [("2012-02-22 09:47:40", 1754.304, 1754.722, 72), ("2013-02-08 14:20:00", 1667.391, 1667.767, 58)]

# Fixed values: (year, month, open, close) of one market.
MONTHS = [
    (2012, 1, "1291.400", "1314.100"), (2012, 2, "1754.304", "1754.722"), (2012, 8, "1409.750", "1409.640"),
    (2012, 10, "1438.170", "1437.600"), (2012, 12, "1426.660", "1426.190"), (2013, 1, "1472.050", "1472.050"),
    (2013, 2, "1667.391", "1667.767"), (2013, 5, "1668.400", "1668.400"), (2013, 8, "1692.122", "1691.822"),
    (2013, 10, "1676.616", "1676.616"), (2013, 12, "1807.414", "1848.391"),
]

# Percent per month and in total, by (basis, year).
EXPECTED = {
    ("open", "2012"): {1: "1.75778225200", 2: "0.02382711300", 8: "-0.00780280200", 10: "-0.03963370100",
                       12: "-0.03294407900", "total": "1.70122878300"},
    ("open", "2013"): {1: "0", 2: "0.02255020000", 5: "0", 8: "-0.01772921800", 10: "0",
                       12: "2.26716181200", "total": "2.27198279400"},
    ("prev", "2012"): {1: "1.75778225200", 2: "33.53032493700", 8: "-19.66590719200", 10: "1.98348514500",
                       12: "-0.79368391800", "total": "16.81200122400"},
    ("prev", "2013"): {1: "0", 2: "13.29554023300", 5: "0.03795494200", 8: "1.40385998600",
                       10: "-0.89879431800", 12: "10.24533942200", "total": "24.08390026500"},
}


def day_rows():
    """Ten-second bars from the first open to the last close; what lies between does not matter."""
    for start, first, last, n in DAYS:
        time = datetime.fromisoformat(start)
        for i in range(n):
            open_price = first if i == 0 else first + i / 100
            close = last if i == n - 1 else first - i / 100
            yield (time + timedelta(seconds=10 * i), open_price, close)


@pytest.fixture
def month_prices(spark):
    rows = [("M", y, m, Decimal(o), Decimal(c)) for y, m, o, c in MONTHS]
    return spark.createDataFrame(rows, prices_schema())


def cells(row):
    named = {k: row[name] for k, name in enumerate(MONTH_NAMES, 1) if row[name] is not None}
    return named | {"total": row["total"]}


def test_two_days(spark, tmp_path, bar_file):
    bar_file(tmp_path / "a.csv", list(day_rows()))
    bars = clean_bars(tag_load(read_bars(spark, str(tmp_path)), "M", "run", ts("2030-01-01")))
    assert bars.count() == 130
    changes = monthly_changes(bars)
    by_basis = {(r.basis, r.year, r.month): r.pct for r in changes.collect()}
    for basis in ("open", "prev"):
        assert by_basis[basis, 2012, 2] == Decimal("0.02382711300")
        assert by_basis[basis, 2013, 2] == Decimal("0.02255020000")
    total = overview_of_changes(changes).where("year = 'total' AND basis = 'open'").first()
    assert total.february == Decimal("0.023188656500000")
    assert total.total == Decimal("0.023188656500000")


def test_two_years(month_prices):
    wide = overview_of_changes(changes_of_prices(month_prices))
    found = {(r.basis, r.year): cells(r) for r in wide.where("year <> 'total'").collect()}
    expected = {key: {k: Decimal(v) for k, v in row.items()} for key, row in EXPECTED.items()}
    assert found == expected


def test_average_of_two_years(month_prices):
    wide = overview_of_changes(changes_of_prices(month_prices))
    for row in wide.where("year = 'total'").collect():
        for k, value in cells(row).items():
            both = [Decimal(EXPECTED[row.basis, y][k]) for y in ("2012", "2013") if k in EXPECTED[row.basis, y]]
            assert round(value, 11) == round(sum(both) / len(both), 11)


def test_carried_over_new_year(month_prices):
    wide = overview_of_changes(changes_of_prices(month_prices, "prev", carry=True))
    row = wide.where("year = '2013'").first()
    assert row.january == Decimal("3.21556033900")
    assert row.total == Decimal("27.29946060400")
    assert wide.where("year = '2012'").first().total == Decimal("16.81200122400")


def test_doubles_agree_with_decimals(month_prices):
    exact = overview_of_changes(changes_of_prices(month_prices))
    double = overview_of_changes(changes_of_prices(month_prices, as_double=True))
    pairs = exact.select("year", "basis", F.col("total").cast("double").alias("a")).join(
        double.select("year", "basis", F.col("total").alias("b")), ["year", "basis"]
    )
    assert pairs.where(F.abs(F.col("a") - F.col("b")) > 1e-7).count() == 0 and pairs.count() == 6


def test_missing_month_is_left_out_or_zero(month_prices):
    changes = changes_of_prices(month_prices, "open")
    null = overview_of_changes(changes).where("year = 'total'").first()
    zero = overview_of_changes(changes, missing="zero").where("year = 'total'").first()
    assert null.march is None and zero.march == 0
    assert null.may == 0 and zero.may == 0
    assert null.january == zero.january


# January, november, december and total of the yearly rows, by basis and year.
YEARS = {
    "open": {
        2012: ("1.757782252", None, "-0.032944079", "1.701228783"),
        2013: ("0", None, "2.267161812", "2.271982794"),
        2014: ("0", None, "-0.109213045", "-0.095271551"),
        2015: ("0", None, "0", "0"),
        2016: ("0", "5.781121444", "0", "5.787328028"),
        2017: ("0", None, "0", "-0.000033869"),
        2018: ("0", "-0.010965594", "0", "-0.018363910"),
    },
    "prev": {
        2012: ("1.757782252", None, "-0.793683918", "16.812001224"),
        2013: ("0", None, "10.245339422", "24.083900265"),
        2014: ("0", None, "4.350732777", "11.762553238"),
        2015: ("0", None, "1.865834899", "-0.156160579"),
        2016: ("0", "5.326016384", "1.571359093", "10.355274027"),
        2017: ("0", None, "4.730770886", "17.851513546"),
        2018: ("0", "-5.860631902", "-6.766476697", "-4.320826398"),
    },
}
# The recorded average rows, good to 11 digits.
AVERAGES = {
    "open": ("0.251111750290000", "2.885077925000000", "0.303572098290000", "1.378124325000000"),
    "prev": ("0.251111750290000", "-0.267307759000000", "2.171982351710000", "10.912607903290000"),
}


def test_average_of_seven_years(spark):
    def number(text):
        return None if text is None else Decimal(text)

    names = ["january", "november", "december"]
    rows = [("M", y, b, *map(number, cells)) for b, years in YEARS.items() for y, cells in years.items()]
    kinds = ", ".join(f"{n} decimal(33,11)" for n in [*names, "total"])
    wide = spark.createDataFrame(rows, f"market string, year int, basis string, {kinds}")
    found = {r.basis: [round(r[n], 11) for n in [*names, "total"]] for r in average_row(wide, names).collect()}
    assert found == {b: [round(Decimal(v), 11) for v in values] for b, values in AVERAGES.items()}
