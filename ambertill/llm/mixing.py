"""Mixing sources to target weights, in built-in expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ambertill.llm.rows import packed, unpacked
from ambertill.operators.ordered import number_rows
from ambertill.session import stage

#: Weights of the sources in their order, repeated; and how often a source may be taken at most.
WEIGHTS = (1, 2, 3)
MOST = 3
SEED = 20
#: A blank ends a word; written for Java's expressions.
_WORD = r"[^\x20\x09-\x0D]+"


def words(column: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(column).cast("string"), F.lit(_WORD)), F.lit(0)).cast("long")


def chance(seed: int = SEED) -> Column:
    """A number from 0 to 1 for every document, the same in every run."""
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    return F.conv(F.substring(key, 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``source``, ``source_size`` and ``target`` of all sources, from ``source`` and ``size`` of the documents.

    Sources in order of their code points, null last, weigh ``weights`` in turn and share the sum of all
    sizes. A target stops at ``most`` times its source; the rest is shared again by weight until
    none is above. Each round is one sum over the sources: the share of a unit of weight
    only rises, and it alone says who has stopped.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = [F.col("source").isNull().alias("_none"), "source"]
    numbered = number_rows(totals.withColumn("_none", order[0]), ["_none", "source"], "_number", 0).drop("_none")
    weight = F.element_at(F.array(*(F.lit(w) for w in weights)), (F.col("_number") % len(weights) + 1).cast("int"))
    known = stage(numbered.select("source", "source_size", weight.cast("long").alias("weight")), "sources")
    cap = F.col("source_size") * most
    level = 0.0
    while True:
        stopped = cap < F.col("weight") * F.lit(level)
        row = known.agg(
            F.sum("source_size").alias("total"),
            F.sum(F.when(stopped, cap).otherwise(0)).alias("given"),
            F.sum(F.when(stopped, 0).otherwise(F.col("weight"))).alias("weight"),
        ).first()
        if not row.weight:
            break
        share = (row.total - row.given) / row.weight
        if share <= level:
            break
        level = share
    return known.select("source", "source_size", F.least(cap.cast("double"), F.col("weight") * F.lit(level)).alias("target"))


def _taken(docs: DataFrame, seed: int, weights: tuple[int, ...], most: int) -> DataFrame:
    """``_row``, ``_size``, ``_source_size``, ``_target`` and ``_copies`` of every document."""
    sizes = docs.select(F.col("source").cast("string").alias("source"), words().alias("size"))
    shares = stage(targets(sizes, weights, most), "targets").select(
        F.col("source").alias("_name"), F.col("source_size").alias("_source_size"), F.col("target").alias("_target")
    )
    rows = packed(docs, _source=F.col("source").cast("string"), _size=words(), _chance=chance(seed))
    joined = rows.join(shares, F.col("_source").eqNullSafe(F.col("_name")))
    rate = F.when(F.col("_source_size") > 0, F.col("_target") / F.col("_source_size")).otherwise(0.0)
    copies = F.floor(rate) + (F.col("_chance") < rate - F.floor(rate)).cast("long")
    return joined.select("_row", "_size", "_source_size", "_target", copies.cast("int").alias("_copies"))


def repetitions(docs: DataFrame, seed: int = SEED, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """The documents with ``_size``, ``_source_size``, ``_target`` and ``_copies``.

    A source's rate is its target over its size: each document is taken ``floor(rate)`` times and once
    more with the probability of the fraction, decided by a hash of its id. Documents without words
    have size 0 and share the rate of their source; a source without any words has rate 0. Null
    is a source of its own; rows with one id are decided alike; an empty table stays empty.
    """
    return _taken(docs, seed, weights, most).select("_row.*", "_size", "_source_size", "_target", "_copies")


def mixed(docs: DataFrame, seed: int = SEED, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Every document as often as the mix takes it, with its own columns only; the rest as in ``repetitions``."""
    taken = _taken(docs, seed, weights, most)
    return unpacked(taken.select("_row", F.explode(F.array_repeat(F.lit(0), F.col("_copies")))))
