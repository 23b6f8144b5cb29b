"""Where rows come from: files, inline values, arrays, number ranges, views."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def read_table(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """Scan with a declared schema; no file is opened to guess it."""
    return spark.read.schema(schema).parquet(path)


def inline(spark: SparkSession, rows: Iterable[Sequence[object]], schema: str | T.StructType) -> DataFrame:
    """A small literal table (``VALUES`` or a chain of ``SELECT .. UNION ALL``)."""
    return spark.createDataFrame([tuple(r) for r in rows], schema)


def series(spark: SparkSession, first: int, last: int, name: str = "x") -> DataFrame:
    """``generate_series(first, last)``, both ends included, produced in parallel."""
    return spark.range(first, last + 1).withColumnRenamed("id", name)


def unnest(df: DataFrame, array: str, out: str) -> DataFrame:
    return df.withColumn(out, F.explode(array))


def unnest_with_position(df: DataFrame, array: str, out: str, position: str) -> DataFrame:
    """``WITH ORDINALITY``: positions start at 1."""
    return df.select("*", F.posexplode(array).alias("_p", out)).withColumn(
        position, F.col("_p") + 1
    ).drop("_p")


def define_view(spark: SparkSession, name: str, build: Callable[[SparkSession], DataFrame]) -> DataFrame:
    """``CREATE OR REPLACE VIEW``; the plan is kept, not its rows."""
    build(spark).createOrReplaceTempView(name)
    return spark.table(name)


def sample_rows(df: DataFrame, n: int) -> DataFrame:
    """Any ``n`` rows."""
    return df.limit(n)
