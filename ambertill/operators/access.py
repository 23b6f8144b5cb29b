"""Row and column filters that a caller applies for a principal.

These are operators, not an enforcement layer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def principal_part(principal: str, position: int) -> Column:
    """``client_ann_lee`` has the parts client, ann and lee."""
    return F.split_part(F.lit(principal), F.lit("_"), F.lit(position))


def owners(people: DataFrame, principal: str, parts: Sequence[tuple[Column, int]], key: str) -> DataFrame:
    """Keys of the people whose lower-cased columns equal the parts of the principal's name."""
    matched = people
    for column, position in parts:
        matched = matched.where(F.lower(column) == principal_part(principal, position))
    return matched.select(key)


def own_rows(df: DataFrame, owner_keys: DataFrame, key: str) -> DataFrame:
    return df.join(owner_keys, key, "left_semi")


def not_in(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """``key NOT IN (subquery)`` with its NULL rules.

    An empty subquery keeps every row; a NULL among its keys keeps none; a row
    whose own key is NULL is kept only when the subquery is empty.
    """
    facts = F.struct(F.count(F.lit(1)).alias("n"), F.count_if(F.col(key).isNull()).alias("nulls"))
    unmatched = df.join(keys, key, "left_anti").withColumn("_keys", keys.agg(facts.alias("f")).scalar())
    kept = (F.col("_keys.n") == 0) | ((F.col("_keys.nulls") == 0) & F.col(key).isNotNull())
    return unmatched.where(kept).select(*df.columns)


def visible_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns)
