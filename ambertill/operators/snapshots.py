"""Partition-pruned changes of a partitioned table: rewrite only the partitions a change touches.

A snapshot is a catalogue table partitioned by one column whose partitions may live in different
folders. A change finds the partitions that hold affected keys (a scan of the key and partition
columns only), reads just those partitions (a partition filter at the scan), writes their next
state into a new folder, and creates the next table from the new partitions plus the *old folders*
of every untouched partition. Untouched files are neither read nor copied: they stay byte for
byte and both snapshots share them. The previous snapshot stays readable.

The driver holds one location per partition (catalogue metadata, as Spark's own file listing
does), never rows.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Mapping
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ambertill.operators.changes import few_copies
from ambertill.session import scratch_dir

_PLAIN = re.compile(r"^[A-Za-z0-9_.\-]+$")
#: The folder name Spark gives the partition of null values.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


class Snapshot(NamedTuple):
    table: str
    column: str
    base: str
    locations: dict

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.table(self.table)


class Rewrite(NamedTuple):
    snapshot: Snapshot
    affected: DataFrame
    rewritten: list


def _literal(value) -> str:
    return "NULL" if value is None else "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _folder(base: str, column: str, value) -> str:
    name = NULL_PARTITION if value is None else str(value)
    if not _PLAIN.match(name):
        raise ValueError(f"partition value {name!r} needs escaping; use plain values")
    return f"{base}/{column}={name}"


def _create(spark: SparkSession, df: DataFrame, column: str, base: str, extra: Mapping) -> Snapshot:
    """A table over ``base`` (already written) plus ``extra`` partitions in other folders."""
    name = f"snapshot_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY (`{column}`) LOCATION '{base}'")
    spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    locations = {v: _folder(base, column, v) for v in _partitions(spark, name)}
    if extra:
        added = " ".join(f"PARTITION (`{column}` = {_literal(v)}) LOCATION '{where}'" for v, where in extra.items())
        spark.sql(f"ALTER TABLE {name} ADD {added}")
        locations.update(extra)
    return Snapshot(name, column, base, locations)


def _partitions(spark: SparkSession, name: str) -> list:
    """Partition values from the catalogue (no file is read)."""
    values = []
    for row in spark.sql(f"SHOW PARTITIONS {name}").collect():
        value = row[0].split("=", 1)[1]
        values.append(None if value == NULL_PARTITION else value)
    return values


def partitioned(df: DataFrame, column: str) -> Snapshot:
    """The first snapshot: ``df`` written once, partitioned by the string ``column`` (moved to the end)."""
    spark = df.sparkSession
    base = f"{scratch_dir(spark)}/snapshots/{uuid.uuid4().hex}"
    ordered = df.select(*[c for c in df.columns if c != column], column)
    ordered.repartition(column).write.mode("errorifexists").partitionBy(column).parquet(base)
    return _create(spark, ordered, column, base, {})


def touched(snapshot: Snapshot, spark: SparkSession, keys: DataFrame, match: Mapping[str, str]) -> list:
    """Partition values that hold a row matching ``keys`` (``match`` maps table to key columns)."""
    table = snapshot.read(spark)
    wanted = few_copies(keys, list(match.values())).select(*(F.col(k).alias(f"_k_{t}") for t, k in match.items()))
    same = reduce(lambda a, b: a & b, [F.col(t) == F.col(f"_k_{t}") for t in match])
    found = table.select(snapshot.column, *match).join(wanted, same, "left_semi").select(snapshot.column).distinct()
    return [r[0] for r in found.collect()]


def rewrite(snapshot: Snapshot, spark: SparkSession, parts: list, change: Callable[[DataFrame], DataFrame]) -> Snapshot:
    """Next snapshot: ``change`` applied to the rows of ``parts`` only; every other partition keeps its folder."""
    column = snapshot.column
    table = snapshot.read(spark)
    base = f"{scratch_dir(spark)}/snapshots/{uuid.uuid4().hex}"
    if parts:
        before = table.where(_within(column, parts))
        after = change(before).select(*table.columns)
        after.repartition(column).write.mode("errorifexists").partitionBy(column).parquet(base)
    else:
        table.limit(0).write.mode("errorifexists").partitionBy(column).parquet(base)
    kept = {v: where for v, where in snapshot.locations.items() if v not in parts}
    return _create(spark, table, column, base, kept)


def delete_pruned(snapshot: Snapshot, spark: SparkSession, doomed: DataFrame, match: Mapping[str, str]) -> Rewrite:
    """``DELETE .. WHERE key IN (doomed)`` rewriting only the partitions that hold such keys.

    ``affected`` (the deleted rows, the counterpart of ``RETURNING``) reads the old snapshot,
    so it stays valid after the change. A NULL key matches nothing.
    """
    parts = touched(snapshot, spark, doomed, match)
    wanted = few_copies(doomed, list(match.values())).select(*(F.col(k).alias(f"_k_{t}") for t, k in match.items()))
    same = reduce(lambda a, b: a & b, [F.col(t) == F.col(f"_k_{t}") for t in match])
    new = rewrite(snapshot, spark, parts, lambda rows: rows.join(wanted, same, "left_anti"))
    old = snapshot.read(spark)
    gone = old.where(_within(snapshot.column, parts)).join(wanted, same, "left_semi")
    return Rewrite(new, gone, parts)


def update_pruned(snapshot: Snapshot, spark: SparkSession, chosen: DataFrame, match: Mapping[str, str], values: Mapping[str, Column]) -> Rewrite:
    """``UPDATE .. SET values WHERE key IN (chosen)`` rewriting only the partitions that hold such keys.

    The partition column itself may not be set. ``affected`` holds the updated rows with their new values.
    """
    if snapshot.column in values:
        raise ValueError("the partition column cannot be updated in place")
    parts = touched(snapshot, spark, chosen, match)
    wanted = few_copies(chosen, list(match.values())).select(*(F.col(k).alias(f"_k_{t}") for t, k in match.items()), F.lit(True).alias("_hit"))
    same = reduce(lambda a, b: a & b, [F.col(t) == F.col(f"_k_{t}") for t in match])
    old = snapshot.read(spark)
    types = dict(old.dtypes)

    def change(rows: DataFrame) -> DataFrame:
        marked = rows.join(wanted, same, "left")
        hit = F.coalesce(F.col("_hit"), F.lit(False))
        return marked.withColumns({c: F.when(hit, v.cast(types[c])).otherwise(F.col(c)) for c, v in values.items()}).select(*rows.columns)

    new = rewrite(snapshot, spark, parts, change)
    hits = old.where(_within(snapshot.column, parts)).join(wanted.drop("_hit"), same, "left_semi")
    updated = hits.withColumns({c: v.cast(types[c]) for c, v in values.items()})
    return Rewrite(new, updated, parts)


def _within(column: str, parts: list) -> Column:
    known = [p for p in parts if p is not None]
    inside = F.col(column).isin(known) if known else F.lit(False)
    return inside | F.col(column).isNull() if None in parts else inside
