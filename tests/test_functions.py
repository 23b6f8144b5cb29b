import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ambertill.functions import calendar, numbers, ordering, text
from conftest import rows


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


@pytest.mark.parametrize(
    "value, digits, expected",
    [("2.345", 2, "2.35"), ("0.125", 2, "0.13"), ("-2.345", 2, "-2.35"), ("63.6", 2, "63.60"), ("7", 4, "7.0000")],
)
def test_fixed_rounds_half_away_from_zero(spark, value, digits, expected):
    assert one(spark, numbers.fixed(F.lit(value).cast("decimal(18,4)"), digits)) == expected


def test_null_stays_null_through_text(spark):
    nothing = F.lit(None).cast("decimal(18,2)")
    assert one(spark, numbers.with_unit(numbers.fixed(nothing, 2), " %")) is None
    assert one(spark, numbers.grouped(F.lit("1234567.5").cast("decimal(18,2)"))) == "1,234,568"


def test_ratio_is_not_an_integer_division(spark):
    assert one(spark, numbers.ratio(F.lit(1), F.lit(2))) == 0.5


def test_concat_null_rules(spark):
    null = F.lit(None).cast("string")
    assert one(spark, text.joined_address(F.lit("a"), null)) == "a"
    assert one(spark, text.joined_address(F.lit("a"), F.lit("b"))) == "a, b"
    assert one(spark, text.full_name(F.lit("a"), null)) is None


def test_numbered_code_widens_instead_of_cutting(spark):
    assert one(spark, text.numbered_code("R", F.lit(7), 6)) == "R000007"
    assert one(spark, text.numbered_code("R", F.lit(12345678), 6)) == "R12345678"


def test_labels(spark):
    labels = {"G": "everyone", "R": "adults"}
    assert one(spark, text.labelled(F.lit("R"), labels, "unknown")) == "adults"
    assert one(spark, text.labelled(F.lit(None).cast("string"), labels, "unknown")) == "unknown"


def test_null_order(spark):
    df = spark.createDataFrame([(1,), (None,), (3,)], "x int")
    assert rows(df.orderBy(*ordering.sort_columns(["x"]))) == [(1,), (3,), (None,)]
    assert rows(df.orderBy(*ordering.sort_columns(["-x"]))) == [(None,), (3,), (1,)]


@pytest.mark.parametrize(
    "day, expected",
    [
        (dt.date(2017, 5, 9), (dt.date(2017, 4, 1), dt.date(2017, 7, 1))),
        (dt.date(2016, 12, 31), (dt.date(2016, 10, 1), dt.date(2017, 1, 1))),
        (dt.date(2016, 1, 1), (dt.date(2016, 1, 1), dt.date(2016, 4, 1))),
    ],
)
def test_quarter_bounds(day, expected):
    assert calendar.quarter_bounds(day) == expected


def test_month_bounds():
    assert calendar.month_bounds(dt.date(2016, 12, 5)) == (dt.date(2016, 12, 1), dt.date(2017, 1, 1))


def test_calendar_columns_at_the_edge_of_an_iso_year(spark):
    df = spark.createDataFrame([(dt.date(1999, 1, 2),)], "d date")
    row = calendar.calendar_columns(df, "d").first()
    assert (row.calendar_year, row.calendar_week_number, row.calendar_week_year) == (1999, 53, 1998)
    assert (row.calendar_quarter_number, row.calendar_month_desc, row.day_name) == (1, "1999-01", "Saturday")


def test_money_sums_are_exact(spark):
    df = spark.createDataFrame([(0.1,)] * 10, "x double")
    assert df.agg(numbers.total("x")).first()[0] == Decimal("1.00")
