"""Rows to columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ambertill.functions.numbers import money


def sums_when(cases: Mapping[str, Column], measure: Column) -> list[Column]:
    """One conditional sum per output column; 0 where nothing matches."""
    return [F.sum(F.when(hit, measure).otherwise(F.lit(0))).alias(name) for name, hit in cases.items()]


def counts_when(cases: Mapping[str, Column], weight: Column | int = 1) -> list[Column]:
    return [F.sum(F.when(hit, weight).otherwise(0)).cast("long").alias(name) for name, hit in cases.items()]


def crosstab(
    df: DataFrame, rows: Sequence[str], category: str, labels: Mapping[object, str], measure: str
) -> DataFrame:
    """Sums per row key and category. The category list is given by the caller,
    so no extra job looks for it; a missing combination is NULL."""
    wide = df.groupBy(*rows).pivot(category, list(labels)).agg(F.sum(money(measure)))
    return wide.select(*rows, *(F.col(f"`{value}`").alias(name) for value, name in labels.items()))


def with_row_total(df: DataFrame, columns: Sequence[str], out: str) -> DataFrame:
    filled = df.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in columns})
    total = sum((F.col(c) for c in columns[1:]), F.col(columns[0]))
    return filled.withColumn(out, total)
