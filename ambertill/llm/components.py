"""Connected components of a table of links, in rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ambertill.session import stage


def components(links: DataFrame) -> DataFrame:
    """The least node that each node reaches: ``node``, ``root``.

    ``links`` has columns ``a`` and ``b``; direction, repeats and loops don't matter. Each
    round ties the neighbours of a node to the least of them, first the larger neighbours, then
    the smaller ones, until no tie changes; the number of rounds grows with the
    logarithm of the longest chain. Each round is written to the shared folder. Nodes tied
    to a frequent root are not gathered: the root is found by an aggregate and joined back.
    """
    ties = stage(
        links.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("root")).where("node > root").distinct(), "ties"
    )
    state = _state(ties)
    while state[0]:
        ties = stage(_small_star(stage(_large_star(ties), "large-star")), "small-star")
        state, before = _state(ties), state
        if state == before:
            break
    roots = ties.select(F.col("root").alias("node"), "root")
    return ties.union(roots).distinct()


def _state(ties: DataFrame) -> tuple:
    """Changes with every change of a tie but for chance."""
    row = ties.agg(
        F.count("*"), F.sum(F.xxhash64("node", "root").cast("decimal(20,0)")), F.sum(F.hash("root", "node").cast("long"))
    ).first()
    return tuple(row)


def _large_star(ties: DataFrame) -> DataFrame:
    """Tie every larger neighbour to the least neighbour."""
    both = ties.select(F.col("node").alias("at"), F.col("root").alias("near")).union(
        ties.select(F.col("root").alias("at"), F.col("node").alias("near"))
    )
    least = stage(both.groupBy("at").agg(F.least(F.min("near"), F.col("at")).alias("low")), "least")
    return (
        both.where("near > at")
        .join(least, "at")
        .select(F.col("near").alias("node"), F.col("low").alias("root"))
        .where("node > root")
        .distinct()
    )


def _small_star(ties: DataFrame) -> DataFrame:
    """Tie every smaller neighbour, and the node itself, to the least neighbour."""
    least = stage(ties.groupBy("node").agg(F.min("root").alias("low")), "least")
    moved = ties.join(least, "node").where("root > low").select(F.col("root").alias("node"), F.col("low").alias("root"))
    return least.select("node", F.col("low").alias("root")).union(moved).distinct()
