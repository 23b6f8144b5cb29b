"""Sort keys with the NULL placement of the source system.

Ascending keys put NULL last and descending keys put NULL first, which is the
reverse of Spark's default in both cases.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, functions as F

#: ``"name"`` sorts ascending, ``"-name"`` descending.
SortKeys = Sequence[str]


def _name(key: str) -> str:
    return key.removeprefix("-")


def _is_descending(key: str) -> bool:
    return key.startswith("-")


def names(keys: SortKeys) -> list[str]:
    return [_name(k) for k in keys]


def sort_columns(keys: SortKeys) -> list[Column]:
    return [
        F.col(_name(k)).desc_nulls_first() if _is_descending(k) else F.col(_name(k)).asc_nulls_last()
        for k in keys
    ]


def reverse_sort_columns(keys: SortKeys) -> list[Column]:
    return [
        F.col(_name(k)).asc_nulls_last() if _is_descending(k) else F.col(_name(k)).desc_nulls_first()
        for k in keys
    ]


def not_after(keys: SortKeys, bound_row: str) -> Column:
    """True for rows that sort before, or level with, the row held in a struct column."""

    def step(rest: Column, key: str) -> Column:
        value, bound = F.col(_name(key)), F.col(f"{bound_row}.{_name(key)}")
        if _is_descending(key):
            before = F.coalesce(value > bound, F.lit(False)) | (value.isNull() & bound.isNotNull())
        else:
            before = F.coalesce(value < bound, F.lit(False)) | (value.isNotNull() & bound.isNull())
        return before | (value.eqNullSafe(bound) & rest)

    return reduce(step, reversed(list(keys)), F.lit(True))
