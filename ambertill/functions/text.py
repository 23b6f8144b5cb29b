"""String helpers whose NULL rules differ from Spark's ``concat``."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, functions as F


def concat_skipping_nulls(*parts: Column) -> Column:
    return F.concat_ws("", *parts)


def joined_address(first: Column, second: Column, separator: str = ", ") -> Column:
    """``first`` alone, or both parts when the second is known."""
    return concat_skipping_nulls(first, F.concat(F.lit(separator), second))


def full_name(first: Column, last: Column) -> Column:
    """NULL as soon as one part is NULL."""
    return F.concat(first, F.lit(" "), last)


def folded(column: Column) -> Column:
    """Trimmed, case-insensitive form used to compare names."""
    return F.upper(F.btrim(column))


def labelled(column: Column, labels: Mapping[str, str], otherwise: str) -> Column:
    result: Column | None = None
    for value, label in labels.items():
        hit = column == F.lit(value)
        result = F.when(hit, F.lit(label)) if result is None else result.when(hit, F.lit(label))
    return F.lit(otherwise) if result is None else result.otherwise(F.lit(otherwise))


def numbered_code(prefix: str, number: Column, width: int) -> Column:
    """Zero-padded code. ``lpad`` cuts longer numbers, so the width grows instead."""
    digits = number.cast("string")
    padded = F.lpad(digits, width, "0")
    return F.concat(F.lit(prefix), F.when(F.length(digits) > width, digits).otherwise(padded))
