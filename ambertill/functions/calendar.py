"""Calendar attributes of a date, and date ranges that reach the file scan."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def calendar_year(day: Column) -> Column:
    return F.year(day)


def calendar_columns(df: DataFrame, day: str) -> DataFrame:
    """The attributes of a calendar dimension, worked out from one date column."""
    d = F.col(day)
    return df.withColumns(
        {
            "calendar_year": F.year(d),
            "calendar_quarter_number": F.quarter(d),
            "calendar_month_desc": F.date_format(d, "yyyy-MM"),
            "calendar_week_number": F.weekofyear(d),
            "calendar_week_year": F.extract(F.lit("YEAROFWEEK"), d),
            "day_name": F.date_format(d, "EEEE"),
        }
    )


def between_days(day: Column, first: dt.date, after: dt.date) -> Column:
    """Half-open range on the raw column: Parquet statistics can skip row groups."""
    return (day >= F.lit(first)) & (day < F.lit(after))


def in_years(day: Column, first: int, last: int, pad_days: int = 0) -> Column:
    pad = dt.timedelta(days=pad_days)
    return between_days(day, dt.date(first, 1, 1) - pad, dt.date(last + 1, 1, 1) + pad)


def quarter_bounds(day: dt.date) -> tuple[dt.date, dt.date]:
    """First day of the quarter of ``day`` and first day of the next one."""
    start_month = 3 * ((day.month - 1) // 3) + 1
    first = dt.date(day.year, start_month, 1)
    after = dt.date(day.year + (start_month == 10), (start_month + 3 - 1) % 12 + 1, 1)
    return first, after


def month_bounds(day: dt.date) -> tuple[dt.date, dt.date]:
    after = dt.date(day.year + (day.month == 12), day.month % 12 + 1, 1)
    return day.replace(day=1), after


def month_of(text: str) -> dt.date:
    """First day of a month given as yyyy-MM."""
    return dt.date.fromisoformat(f"{text}-01")


def any_of(ranges: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, ranges)


def days_between(later: Column, earlier: Column) -> Column:
    return F.datediff(later.cast("date"), earlier.cast("date"))


def moment(value: dt.datetime, df: DataFrame, column: str) -> Column:
    """A literal of the column's own time type, so that the column stays bare in comparisons."""
    return F.lit(value).cast(df.schema[column].dataType)
