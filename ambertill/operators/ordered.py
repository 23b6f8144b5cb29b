"""Ordered computations that never hand an unbounded group to one task.

A plain window gives every row of a partition key to one task. Here the rows
are first split into range slices of ``(keys, order)``, so a key that holds a
third of the table is spread over many slices. Each slice is computed on its
own, and only the state at the slice borders - at most one row per slice - is
carried over.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ambertill.functions.ordering import SortKeys, names, sort_columns
from ambertill.session import scratch_dir, stage

SLICE = "_slice"


def _ranged(df: DataFrame, order: SortKeys) -> DataFrame:
    slices = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(slices, *sort_columns(order))


def slice_by_order(df: DataFrame, order: SortKeys) -> DataFrame:
    """Range-partition, note each row's slice and store the outcome.

    The borders come from sampling and would differ if the plan ran twice, so
    the slice number is written down once.
    """
    return stage(_ranged(df, order).withColumn(SLICE, F.spark_partition_id()), "sliced")


#: ``monotonically_increasing_id`` holds the partition above these bits and the row below.
ROW_BITS = 33


def number_rows(df: DataFrame, order: SortKeys, out: str, start: Column | int = 1) -> DataFrame:
    """Consecutive numbers in the given order, without a global sort in one task.

    Each slice is sorted and written with its rows' positions in a single
    shuffle; the numbers follow from the slice sizes. ``order`` should end in a
    unique column: rows that tie on all of it share a slice and are numbered
    arbitrarily among themselves.
    """
    sorted_slices = _ranged(df, order).sortWithinPartitions(*sort_columns(order))
    placed = stage(sorted_slices.withColumn("_place", F.monotonically_increasing_id()), "placed")
    placed = placed.withColumn(SLICE, F.shiftright("_place", ROW_BITS))
    # One row per slice, so the running total below is over a bounded set.
    before = Window.orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(SLICE)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(SLICE, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    )
    first = F.lit(start) if isinstance(start, int) else start
    within = F.col("_place").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    return (
        placed.join(F.broadcast(offsets), SLICE)
        .withColumn(out, (first + F.col("_before") + within).cast("long"))
        .drop(SLICE, "_before", "_place")
    )


def _over(kind: str, column: Column, window) -> Column:
    if kind == "last":
        return F.last(column, ignorenulls=True).over(window)
    return {"max": F.max, "sum": F.sum}[kind](column).over(window)


def _join_state(kind: str, here: Column, carried: Column) -> Column:
    if kind == "last":
        return F.coalesce(here, carried)
    if kind == "max":
        return F.greatest(here, carried)
    return F.coalesce(here + carried, here, carried)


def running(
    df: DataFrame, keys: Sequence[str], order: SortKeys, outputs: Mapping[str, tuple[str, str]]
) -> DataFrame:
    """Running ``last`` (not null), ``max`` or ``sum`` up to and including each row.

    ``outputs`` maps a new column to ``(kind, input column)``; its type is that of the input, for a sum
    that of Spark's sum of the input. ``order`` is ascending. There is one plan for all sizes of groups.
    """
    upto = (Window.unboundedPreceding, Window.currentRow)
    sums = [F.sum(c).alias(o) for o, (kind, c) in outputs.items() if kind == "sum"]
    types = {f.name: f.dataType for f in df.select(*sums).schema} if sums else {}
    # Read back bucketed by slice: the window and the slice ends below need no second exchange.
    sliced = bucketed_slices(df, sort_columns([*keys, *order]))
    within = Window.partitionBy(SLICE, *keys).orderBy(*sort_columns(order)).rowsBetween(*upto)
    position = F.struct(*names(order))
    ends = sliced.groupBy(SLICE, *keys).agg(
        *(
            {
                "last": F.max_by(F.col(c), F.when(F.col(c).isNotNull(), position)),
                "max": F.max(c),
                "sum": F.sum(c),
            }[kind].alias(f"_end_{o}")
            for o, (kind, c) in outputs.items()
        )
    )
    earlier = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(
        F.col(SLICE).alias("_carry_slice"),
        *(F.col(k).alias(f"_carry_{k}") for k in keys),
        *(_over(kind, F.col(f"_end_{o}"), earlier).alias(f"_carry_{o}") for o, (kind, _) in outputs.items()),
    ).where(" or ".join(f"`_carry_{o}` is not null" for o in outputs))
    # Only the first key of a slice can go on from an earlier slice, so
    # `carried` has at most one row per slice and is safe to broadcast.
    same_run = F.col(SLICE) == F.col("_carry_slice")
    for k in keys:
        same_run = same_run & F.col(k).eqNullSafe(F.col(f"_carry_{k}"))
    local = sliced.withColumns(
        {f"_here_{o}": _over(kind, F.col(c), within) for o, (kind, c) in outputs.items()}
    )
    joined = local.join(F.broadcast(carried), same_run, "left")
    result = {
        o: _join_state(kind, F.col(f"_here_{o}"), F.col(f"_carry_{o}")) for o, (kind, _) in outputs.items()
    }
    typed = {o: c.cast(types[o]) if o in types else c for o, c in result.items()}
    return joined.select(*df.columns, *(c.alias(o) for o, c in typed.items()))


def bucketed_slices(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Range slices of ``order`` written as a table bucketed by slice, and read back.

    Spark reads such a table as partitioned by ``_slice``: windows and aggregates whose
    keys start with the slice need no second shuffle of the rows. The range borders come
    from sampling, so the slice numbers are written down once (a table in the shared folder).
    """
    spark = df.sparkSession
    slices = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(slices, *order).withColumn(SLICE, F.spark_partition_id())
    name = f"slices_{uuid.uuid4().hex}"
    path = f"{scratch_dir(spark)}/slices/{name}"
    ranged.write.bucketBy(slices, SLICE).option("path", path).format("parquet").saveAsTable(name)
    return spark.table(name)


def next_distinct(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """Distinct ``(keys, value)`` with the smallest larger value of the same key (NULL comes last and has none).

    One range shuffle of the rows: equal rows share a slice, so the distinct rows and the next
    value are found inside each slice; the last row of a slice takes the first row of the
    next non-empty slice when the key goes on. Only one row per slice crosses slices.
    """
    order = [*(F.col(k).asc_nulls_first() for k in keys), F.col(value).asc_nulls_last()]
    sliced = bucketed_slices(df.select(*keys, value), order)
    rows = sliced.select(SLICE, *keys, value).distinct()
    within = Window.partitionBy(SLICE).orderBy(*order)
    same_key = [F.col(k).eqNullSafe(F.lead(k).over(within)) for k in keys]
    marked = rows.select(
        SLICE,
        *keys,
        value,
        F.when(reduce(lambda a, b: a & b, same_key, F.lit(True)), F.lead(value).over(within)).alias("_within"),
        F.lead(F.lit(1)).over(within).isNull().alias("_last"),
        F.lag(F.lit(1)).over(within).isNull().alias("_first"),
    )
    marked = stage(marked, "next")
    firsts = marked.where("_first").select(
        F.lag(SLICE).over(Window.orderBy(SLICE)).alias("_from"), *(F.col(k).alias(f"_f_{k}") for k in keys), F.col(value).alias("_f_value")
    )
    lasts = marked.where("_last").select(SLICE, *keys)
    carried = lasts.join(firsts, F.col(SLICE) == F.col("_from"))
    goes_on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_f_{k}")) for k in keys], F.lit(True))
    # At most one row per slice: safe to broadcast.
    border = carried.where(goes_on).select(F.col(SLICE).alias("_b_slice"), F.col("_f_value").alias("_border"))
    joined = marked.join(F.broadcast(border), (F.col(SLICE) == F.col("_b_slice")) & F.col("_last"), "left")
    return joined.select(*keys, value, F.when(F.col(value).isNotNull(), F.coalesce("_within", "_border")).alias(out))
