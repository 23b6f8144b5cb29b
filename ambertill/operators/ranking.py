"""Top-k forms: per group, with ties, first row per key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ambertill.functions.ordering import SortKeys, names, not_after, reverse_sort_columns, sort_columns


def top_n_per_group(df: DataFrame, keys: Sequence[str], order: SortKeys, n: int, out: str = "rn") -> DataFrame:
    """Exactly ``n`` rows per group.

    The filter on ``row_number`` lets Spark keep only ``n`` rows per group and
    task before the shuffle (WindowGroupLimit), so a hot group stays small.
    """
    window = Window.partitionBy(*keys).orderBy(*sort_columns(order))
    return df.withColumn(out, F.row_number().over(window)).where(F.col(out) <= n)


def first_per_key(df: DataFrame, keys: Sequence[str], order: SortKeys) -> DataFrame:
    return top_n_per_group(df, keys, order, 1, "_first").drop("_first")


def first_per_known_key(df: DataFrame, keys: Sequence[str], order: SortKeys) -> DataFrame:
    """As above, but rows with a NULL in the key are all kept: they match nothing.

    Each of them is made a group of its own, so they are spread as well.
    """
    unknown = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    marked = df.withColumn("_alone", F.when(unknown, F.monotonically_increasing_id()))
    return first_per_key(marked, [*keys, "_alone"], order).drop("_alone")


def top_with_ties(df: DataFrame, order: SortKeys, n: int) -> DataFrame:
    """``FETCH FIRST n ROWS WITH TIES``: ties are level on the whole sort list.

    The n-th row is found by a distributed top-k and enters the filter as a
    scalar subquery, so even a very long tie is produced in parallel.
    """
    columns = names(order)
    nth = df.select(*columns).orderBy(*sort_columns(order)).limit(n).orderBy(*reverse_sort_columns(order)).limit(1)
    bound = nth.select(F.struct(*columns)).scalar()
    kept = df.withColumn("_bound", bound).where(not_after(order, "_bound"))
    # Without any row there is no bound either, and nothing to keep.
    return kept.select(*df.columns)


def best_with_ties(df: DataFrame, keys: Sequence[str], measure: str) -> DataFrame:
    """All rows level with the maximum of their group.

    Joined to the group maxima (one row per group) rather than ranked, so a
    group whose rows all tie is not gathered in one task.
    """
    for k in keys:  # the join drops NULL keys; said here, both sides share one plan up to the maximum
        df = df.where(F.col(k).isNotNull())
    best = df.groupBy(*keys).agg(F.max(measure).alias("_best"))
    best = best.select(*(F.col(k).alias(f"_k_{k}") for k in keys), "_best")
    same: Column = F.col(measure) == F.col("_best")
    for k in keys:
        same = same & (F.col(k) == F.col(f"_k_{k}"))
    return df.join(best, same).select(*df.columns)
