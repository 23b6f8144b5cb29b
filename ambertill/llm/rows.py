"""Whole rows in one column, so that columns an operator adds never clash with the table's own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def packed(docs: DataFrame, **added: Column) -> DataFrame:
    """``_row`` with all columns, and the added ones."""
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_row")
    return docs.select(row, *(c.alias(name) for name, c in added.items()))


def unpacked(rows: DataFrame) -> DataFrame:
    return rows.select("_row.*")


def content() -> Column:
    """A hash of the text (null as empty), to tell apart rows with one id."""
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))


def without(docs: DataFrame, bad: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose id and ``content`` are not in ``bad`` (``doc_id``, ``content``)."""
    keyed = packed(docs, _doc=F.col("doc_id").cast("long"), _content=content())
    named = bad.select(F.col("doc_id").alias("_bad_doc"), F.col("content").alias("_bad_content"))
    same = F.col("_doc").eqNullSafe(F.col("_bad_doc")) & (F.col("_content") == F.col("_bad_content"))
    return unpacked(keyed.join(named, same, "left_anti"))
