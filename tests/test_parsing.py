from datetime import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from barloom.functions.calendar import MONTH_NAMES, WEEKDAY_NAMES, weekday_number
from barloom.functions.parsing import (
    bar_time, base_name, comma_text, flag, never, price, time_text, whole_second,
)
from barloom.functions.returns import percent_change


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_time_is_first_19_characters(spark):
    assert one(spark, bar_time(F.lit("2012-02-22 09:47:40"))) == datetime(2012, 2, 22, 9, 47, 40)
    assert one(spark, bar_time(F.lit("2012-02-22 09:47:40.123 UTC"))) == datetime(2012, 2, 22, 9, 47, 40)


def test_bad_time_is_null(spark):
    for text in ["", "Time (UTC)", "2012-02-30 00:00:00", "2012-02-22"]:
        assert one(spark, bar_time(F.lit(text))) is None


def test_price_with_comma(spark):
    assert one(spark, price(F.lit("1754,28"), "decimal(7,3)")) == Decimal("1754.280")
    assert one(spark, price(F.lit(" 5 "), "decimal(7,3)")) == Decimal("5.000")


def test_price_that_does_not_fit_is_null(spark):
    for text in ["", "abc", "10000", "1,2,3"]:
        assert one(spark, price(F.lit(text), "decimal(7,3)")) is None
    assert one(spark, price(F.lit("10000"), "decimal(12,3)")) == Decimal("10000.000")


def test_comma_text_is_the_way_back(spark):
    number = F.lit("1754.28").cast("decimal(7,3)")
    assert one(spark, comma_text(number)) == "1754,280"


def test_small_functions(spark):
    moment = F.lit("2012-02-22 09:47:40.75").cast("timestamp")
    assert one(spark, whole_second(moment)) == datetime(2012, 2, 22, 9, 47, 40)
    assert one(spark, time_text(moment)) == "2012-02-22 09:47:40"
    assert one(spark, never()) == datetime(1970, 1, 1)
    assert one(spark, base_name(F.lit("a/b/c.csv"))) == "c.csv"
    assert one(spark, flag(F.lit("true"))) is True
    assert one(spark, flag(F.lit("maybe"))) is None


def test_percent_change_scale(spark):
    """The quotient of two (7,3) prices is cut at 11 digits before it is multiplied."""
    a, c = (F.lit(p).cast("decimal(7,3)") for p in ("1754.304", "1754.722"))
    assert one(spark, percent_change(a, c)) == Decimal("0.02382711300")


def test_percent_change_from_zero_is_null(spark):
    zero, ten = F.lit(0).cast("decimal(7,3)"), F.lit(10).cast("decimal(7,3)")
    assert one(spark, percent_change(zero, ten)) is None
    assert one(spark, percent_change(F.lit(0.0), F.lit(1.0))) is None


def test_names():
    assert len(MONTH_NAMES) == 12 and len(WEEKDAY_NAMES) == 7


def test_monday_is_zero(spark):
    assert one(spark, weekday_number(F.lit("2024-01-01").cast("date"))) == 0
    assert one(spark, weekday_number(F.lit("2024-01-07").cast("date"))) == 6
