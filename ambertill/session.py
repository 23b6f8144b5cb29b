"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "ambertill", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> None:
    """Calendar parts of an instant depend on the session zone, so it is fixed for the whole session."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def scratch_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Without that setting the context's own checkpoint folder is used; a local
    session that has none gets a temporary one. A cluster session is refused
    then, because executors could not share a local path.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="ambertill-"))
    return context.getCheckpointDir().rstrip("/")


def clear_scratch(spark: SparkSession) -> None:
    """Remove what ``stage`` has written for this application; no table built on it can be read afterwards."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{scratch_dir(spark)}/ambertill-{spark.sparkContext.applicationId}")
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the files.

    Used where several later steps must see exactly the same rows, and where a
    join should know the size of its input. Unlike a cache it survives the loss
    of executors, and being columnar it still lets later steps read only the
    columns they need. Files lie in one folder per application.
    """
    spark = df.sparkSession
    folder = f"{scratch_dir(spark)}/ambertill-{spark.sparkContext.applicationId}"
    path = f"{folder}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
