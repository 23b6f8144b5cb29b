"""Exact money sums, ratios and fixed-decimal text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MONEY = "decimal(18,2)"


def money(column: str | Column) -> Column:
    """Amounts as exact decimals, so that sums do not depend on row order."""
    return (F.col(column) if isinstance(column, str) else column).cast(MONEY)


def total(column: str | Column) -> Column:
    return F.sum(money(column))


def total_of_sums(column: str) -> Column:
    """A sum over amounts or over their sums."""
    return F.sum(F.col(column).cast("decimal(28,2)"))


def as_double(column: Column) -> Column:
    return column.cast("double")


def ratio(part: Column, whole: Column) -> Column:
    """Quotient of two exact sums; never an integer division."""
    return as_double(part) / as_double(whole)


def percent_of(part: Column, whole: Column) -> Column:
    return as_double(part) * F.lit(100.0) / as_double(whole)


def rounded(column: Column, digits: int) -> Column:
    """Round half away from zero on decimals."""
    return F.round(column.cast("decimal(38,10)"), digits)


def fixed(column: Column, digits: int) -> Column:
    """Text with exactly ``digits`` decimals; NULL stays NULL."""
    return rounded(column, digits).cast("string")


def grouped(column: Column) -> Column:
    """Text of a whole number with a comma every three digits."""
    return F.format_number(rounded(column, 0), 0)


def with_unit(text: Column, unit: str) -> Column:
    return F.concat(text, F.lit(unit))
