"""Where rows go. Snapshots are written to new paths; the caller switches over."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def create_table_as(df: DataFrame, path: str) -> DataFrame:
    """Fails when the path is taken."""
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def append_rows(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def write_snapshot(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """A whole next state. ``errorifexists`` keeps a job from replacing its own input."""
    df.write.mode("errorifexists").partitionBy(*partition_by).parquet(path)
    # With the schema given, a partition column of '001' is not read as a number.
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def save_table(df: DataFrame, name: str, bucket_by: tuple[str, ...] = (), buckets: int = 0) -> DataFrame:
    """A catalogue table. Facts that are joined again and again on one key can be
    bucketed by it: such joins then need no shuffle."""
    writer = df.write.mode("errorifexists").format("parquet")
    if bucket_by:
        writer = writer.bucketBy(buckets, *bucket_by).sortBy(*bucket_by)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def truncate_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"TRUNCATE TABLE {name}")


def add_column_with_default(spark: SparkSession, name: str, column: str, sql_type: str, default: str) -> bool:
    """``ALTER TABLE .. ADD COLUMN .. DEFAULT`` on a saved table; False when the column is there already.

    No row is rewritten: rows of older files read the default as worked out at this moment (so a
    run time is fixed once), and later inserts that leave the column out take the default.
    """
    if column in spark.table(name).columns:
        return False
    spark.sql(f"ALTER TABLE {name} ADD COLUMN `{column}` {sql_type} DEFAULT {default}")
    return True


def insert_columns(df: DataFrame, name: str) -> None:
    """``INSERT INTO name (columns of df) SELECT ...``: columns the batch leaves out take their defaults."""
    view = f"batch_{uuid.uuid4().hex}"
    df.createOrReplaceTempView(view)
    try:
        columns = ", ".join(f"`{c}`" for c in df.columns)
        df.sparkSession.sql(f"INSERT INTO {name} ({columns}) SELECT {columns} FROM {view}")
    finally:
        df.sparkSession.catalog.dropTempView(view)
