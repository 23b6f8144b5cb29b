"""A training corpus from raw documents, in stages that each call one operator of ``ambertill.llm``.

``STAGES`` lists the stages in their order. Each takes what its predecessor kept, and all but the last
return the columns of ``documents``. The outcome of each stage is written and read again, so a lost executor
costs at most one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ambertill.llm import decontamination, language, mixing, sharding, simhash
from ambertill.session import stage

#: No SQL computes a learned language model or XXH64 fingerprints; tests compare with plain versions.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter have no language and go."""
    return language.drop_without_language(docs, language.train(docs.where(language.remainder(3) != 1)))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose fingerprints are linked only the one of the least id stays."""
    return simhash.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten words in a row of a benchmark item go."""
    return decontamination.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the weight of its source asks for."""
    return mixing.mixed(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard and slot of every document that the mix takes."""
    return sharding.sharded(docs).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


STAGES = [
    ("language", identify_language),
    ("near_copies", drop_near_copies),
    ("decontamination", decontaminate),
    ("mixing", mix_sources),
    ("sharding", shard),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
