"""Data-change jobs as snapshot jobs: read, compute the next snapshot, write it elsewhere.

Parquet tables have no row updates. Every function returns the next state of
the table as a DataFrame (and the affected rows, the counterpart of
``RETURNING``); nothing is overwritten in place.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from ambertill.functions.ordering import SortKeys
from ambertill.operators.ordered import number_rows
from ambertill.operators.ranking import first_per_key


class Change(NamedTuple):
    """``snapshot`` is the next state, ``affected`` the rows inserted, deleted or updated."""

    snapshot: DataFrame
    affected: DataFrame


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def few_copies(df: DataFrame, keys: Sequence[str], copies: int = 16) -> DataFrame:
    """Keys with at most ``copies`` rows each.

    Enough to keep a frequent key from filling a task of the join that follows.
    A full ``distinct`` would arrive already arranged by the join key, and
    adaptive execution could then no longer split the other side.
    """
    marked = df.select(*keys, (F.spark_partition_id() % copies).alias("_copy"))
    return marked.distinct().drop("_copy")


def _absent(batch: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``batch`` without a partner in ``target``. A NULL key has none by definition."""
    return batch.join(target.select(*keys), list(keys), "left_anti").select(*batch.columns)


def insert_ignore(target: DataFrame, batch: DataFrame, keys: Sequence[str], order: SortKeys) -> Change:
    """``ON CONFLICT (keys) DO NOTHING``: also drops repeats inside the batch.

    ``order`` says which of several batch rows with one key wins. Rows with a NULL in the key match nothing and are all
    added; only the others are shuffled, once for the choice and the join.
    """
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    once = first_per_key(batch.where(known), keys, order)
    added = _absent(once, target, keys).unionByName(batch.where(~known))
    return Change(target.unionByName(added, allowMissingColumns=True), added)


def insert_missing(target: DataFrame, batch: DataFrame, match: Sequence[str]) -> Change:
    """``INSERT .. WHERE NOT EXISTS``: repeats inside the batch are all inserted.

    The match columns need not be unique in the target.
    """
    added = _absent(batch, few_copies(target, match), match)
    return Change(target.unionByName(added, allowMissingColumns=True), added)


def assign_ids(rows: DataFrame, existing: DataFrame, id_column: str, order: SortKeys) -> DataFrame:
    """Dense ids after the largest one in use, in the given order."""
    highest = existing.agg(F.coalesce(F.max(id_column), F.lit(0))).first()[0]
    return number_rows(rows.drop(id_column), order, id_column, start=int(highest) + 1)


def delete_matching(target: DataFrame, doomed: DataFrame, keys: Mapping[str, str]) -> Change:
    """Delete rows whose key appears in ``doomed``; ``keys`` maps target to doomed columns."""
    other = few_copies(doomed, list(keys.values()))
    other = other.select(*(F.col(theirs).alias(f"_d_{mine}") for mine, theirs in keys.items()))
    same = reduce(lambda a, b: a & b, [F.col(mine) == F.col(f"_d_{mine}") for mine in keys])
    return Change(target.join(other, same, "left_anti"), target.join(other, same, "left_semi"))


def delete_where(target: DataFrame, predicate: Column) -> Change:
    """Rows where the predicate is NULL stay."""
    hit = F.coalesce(predicate, F.lit(False))
    return Change(target.where(~hit), target.where(hit))


def truncate(target: DataFrame) -> DataFrame:
    return target.limit(0)


def update_where(target: DataFrame, predicate: Column, values: Mapping[str, Column]) -> Change:
    hit = F.coalesce(predicate, F.lit(False))
    types = dict(target.dtypes)
    new = {c: v.cast(types[c]) for c, v in values.items()}
    snapshot = target.withColumns({c: F.when(hit, v).otherwise(F.col(c)) for c, v in new.items()})
    return Change(snapshot, target.where(hit).withColumns(new))


def update_from(target: DataFrame, source: DataFrame, keys: Sequence[str], values: Mapping[str, Column]) -> Change:
    """``UPDATE .. FROM source``: rows with a partner in ``source`` get the new values.

    ``source`` holds each key once. Values may use its columns as ``_s_<name>``.
    """
    marked = source.select(*(F.col(c).alias(f"_s_{c}") for c in source.columns), F.lit(True).alias("_found"))
    same = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_s_{k}") for k in keys])
    change = update_where(target.join(marked, same, "left"), F.col("_found"), values)
    return Change(change.snapshot.select(*target.columns), change.affected.select(*target.columns))


def close_latest_open(
    target: DataFrame, keys: Sequence[str], id_column: str, closed_column: str, values: Mapping[str, Column]
) -> Change:
    """Update the open row with the highest id of each key; other rows stay."""
    opened = target.where(F.col(closed_column).isNull())
    latest = first_per_key(opened, keys, [f"-{id_column}"]).select(id_column)
    return update_from(target, latest, [id_column], values)


def add_column(df: DataFrame, name: str, default: Column) -> DataFrame:
    """``ADD COLUMN .. DEFAULT``; a table that has the column is left alone."""
    return df if name in df.columns else df.withColumn(name, default)


class Patch(NamedTuple):
    snapshot: DataFrame
    messages: DataFrame
    rejected: DataFrame


def patch_columns(
    target: DataFrame, patches: DataFrame, key: str, allowed: Sequence[str], sequence: str
) -> Patch:
    """Apply a batch of ``(key, column_name, new_value)`` rows to allowed columns.

    The last patch (by ``sequence``) of a key and column wins; a NULL value is a
    real patch. Rejected: columns not allowed, keys not found.
    """
    permitted = patches.where(F.col("column_name").isin(list(allowed)))
    wide = (
        permitted.groupBy(key)
        .pivot("column_name", list(allowed))
        .agg(F.max_by(F.struct("new_value"), sequence))
        .withColumnsRenamed({c: f"_new_{c}" for c in allowed})
        .withColumnRenamed(key, "_key")
    )
    types = dict(target.dtypes)
    joined = target.join(wide, F.col(key) == F.col("_key"), "left")
    snapshot = joined.withColumns(
        {
            c: F.when(F.col(f"_new_{c}").isNotNull(), F.col(f"_new_{c}.new_value").cast(types[c])).otherwise(F.col(c))
            for c in allowed
        }
    ).select(*target.columns)
    not_allowed = patches.where(~F.coalesce(F.col("column_name").isin(list(allowed)), F.lit(False))).withColumn(
        "reject_reason", F.format_string("column %s may not be changed", "column_name")
    )
    unknown = permitted.join(target.select(key), key, "left_anti").withColumn(
        "reject_reason", F.format_string(f"no row has {key} %s", key)
    )
    messages = permitted.join(target.select(key), key, "left_semi").withColumn(
        "message",
        F.format_string(f"{key} %s: %s is now %s", key, "column_name", F.coalesce("new_value", F.lit("empty"))),
    )
    columns = [*patches.columns, "reject_reason"]
    return Patch(snapshot, messages, not_allowed.select(columns).unionByName(unknown.select(columns)))
