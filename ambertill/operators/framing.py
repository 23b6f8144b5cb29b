"""Sliding frames over one global order: RANGE and GROUPS.

Both frames depend only on the order key, so values are summed per key first.
The keys are then cut into buckets at least one frame wide; keys near a border
are copied to the neighbouring bucket, and each bucket runs its own window.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, functions as F

from ambertill.operators.ordered import number_rows

#: Ranks per bucket of the GROUPS frame.
RANKS_PER_BUCKET = 4096


def _bucketed_range(
    df: DataFrame, key: str, value: str, before: Decimal | int, after: Decimal | int, width: Decimal | int, out: str
) -> DataFrame:
    """``SUM(value) OVER (ORDER BY key RANGE before PRECEDING..after FOLLOWING)``; ``key`` is unique."""
    bucket = lambda shift: F.expr(f"cast(floor((`{key}` + ({shift})) / {width}) as bigint)")
    # A row is in the frames of keys from key - after to key + before.
    copies = F.array_distinct(F.array(bucket(0), bucket(f"-{after}"), bucket(f"{before}")))
    frame = F.expr(
        f"sum(`{value}`) over (partition by _bucket order by `{key}` "
        f"range between {before} preceding and {after} following)"
    )
    return (
        df.withColumn("_home", bucket(0))
        .withColumn("_bucket", F.explode(copies))
        .withColumn(out, frame)
        .where(F.col("_bucket").eqNullSafe(F.col("_home")))
        .drop("_home", "_bucket")
    )


def per_key(df: DataFrame, key: str, value: str) -> DataFrame:
    return df.groupBy(key).agg(F.sum(value).alias(value))


def range_sums(keyed: DataFrame, key: str, value: str, before, after, out: str) -> DataFrame:
    """RANGE frame on a numeric key; a NULL key is its own peer group."""
    width = max(before, after, 1) * 8
    return _bucketed_range(keyed, key, value, before, after, width, out)


def rank_keys(keyed: DataFrame, key: str, rank: str = "key_rank") -> DataFrame:
    """Dense rank of distinct keys of any sortable type, NULL last."""
    return number_rows(keyed, [key], rank)


def groups_sums(
    ranked: DataFrame, value: str, before: int, after: int, out: str, rank: str = "key_rank"
) -> DataFrame:
    """GROUPS frame: neighbours are counted in distinct keys, whatever their distance."""
    width = max(RANKS_PER_BUCKET, before, after)
    return _bucketed_range(ranked, rank, value, before, after, width, out)
