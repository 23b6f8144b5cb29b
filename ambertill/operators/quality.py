"""Audits of declared rules: keys, references, checks, counts, coverage."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ambertill.functions.numbers import total
from ambertill.operators.changes import union_all


def duplicate_keys(df: DataFrame, keys: Sequence[str], out: str = "row_count") -> DataFrame:
    """Keys held by more than one row. A key with a NULL part never repeats."""
    known = df
    for k in keys:
        known = known.where(F.col(k).isNotNull())
    return known.groupBy(*keys).agg(F.count(F.lit(1)).alias(out)).where(F.col(out) > 1)


def orphans(child: DataFrame, parent: DataFrame, keys: Mapping[str, str], out: str = "row_count") -> DataFrame:
    """Foreign-key values without a parent, with the number of child rows.

    The child is counted per key before the join: a value held by a third of
    the rows reaches the join as one row.
    """
    counted = child
    for mine in keys:
        counted = counted.where(F.col(mine).isNotNull())
    counted = counted.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))
    owners = parent.select(*(F.col(theirs).alias(f"_p_{mine}") for mine, theirs in keys.items()))
    same = F.lit(True)
    for mine in keys:
        same = same & (F.col(mine) == F.col(f"_p_{mine}"))
    return counted.join(owners, same, "left_anti")


def rule_violations(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """One row per rule with its violation count, from a single pass.

    A rule that evaluates to NULL is satisfied, as for a CHECK constraint.
    """
    counts = df.agg(*(F.count_if(r == F.lit(False)).alias(name) for name, r in rules.items()))
    pairs = ", ".join(f"'{name}', `{name}`" for name in rules)
    return counts.selectExpr(f"stack({len(rules)}, {pairs}) as (rule, violations)")


def null_rule(column: str) -> Column:
    return F.col(column).isNotNull()


def length_rule(column: str, limit: int) -> Column:
    return F.length(column) <= limit


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    return union_all(
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    )


def coverage(df: DataFrame, day: str) -> DataFrame:
    return df.agg(F.min(day).alias("min_date"), F.max(day).alias("max_date"))


def by_year_and_quarter(df: DataFrame, day: str, amount: str) -> DataFrame:
    return (
        df.groupBy(F.year(day).alias("payment_year"), F.quarter(day).alias("payment_quarter"))
        .agg(F.count(F.lit(1)).alias("payments_nmb"), total(amount).alias("total_revenue"))
        .orderBy("payment_year", "payment_quarter")
    )


def same_rows(left: DataFrame, right: DataFrame) -> bool:
    """Equal as multisets of rows."""
    right = right.select(*left.columns)
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


#: Two unrelated 64-bit hashes of a row: the second hashes the row after a fixed prefix.
_SECOND = "ambertill-multiset"


def checksum(df: DataFrame) -> DataFrame:
    """One row: ``rows`` and two order-independent sums of 64-bit row hashes (exact, as decimals).

    Every column is hashed with a flag of whether it is NULL, so that NULLs in different
    columns do not hash alike. One aggregate: tasks send partial sums, never rows.
    """
    cols = [F.col(f"`{c}`") for c in df.columns]
    flags = [c.isNull() for c in cols]
    first = F.xxhash64(*cols, *flags).cast("decimal(38,0)")
    second = F.xxhash64(F.lit(_SECOND), *cols, *flags).cast("decimal(38,0)")
    return df.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(first), F.lit(0)).alias("sum_1"), F.coalesce(F.sum(second), F.lit(0)).alias("sum_2"))


def same_multiset(left: DataFrame, right: DataFrame) -> bool:
    """Equal as multisets of rows (columns matched by name), by ``checksum`` of both sides.

    Unequal sums prove a difference; equal ones stand for equality up to a collision of two
    64-bit hash sums.
    """
    right = right.select(*left.columns)
    return checksum(left).first() == checksum(right).first()


def differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows that one side has more often than the other, with the side: only for listing, after ``same_multiset`` says no."""
    right = right.select(*left.columns)
    return left.exceptAll(right).withColumn("side", F.lit("left")).unionByName(right.exceptAll(left).withColumn("side", F.lit("right")))
