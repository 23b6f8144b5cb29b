"""Sharding by minimax contiguous partition.

Equal texts are one atomic group. Rows are put in order of the group and numbered, with the bytes up
to each row, in slices of a range partition; only one row per slice is carried over. The
smallest feasible capacity of a shard is then found by a search in which every probe fills
the shards greedily: a step asks for the last group that ends within the capacity. Many
capacities are probed by one aggregate, so an interval shrinks by ``PROBES + 1`` a round.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ambertill.llm.rows import packed, unpacked
from ambertill.session import stage

SHARDS = 8
PROBES = 48
PLACED = "doc_id bigint, size bigint, text_crc32 bigint, digest string, slice int, nth bigint, upto bigint"


def _placed(docs: DataFrame) -> DataFrame:
    """Rows in order of text digest and id, with position (from 0) and the bytes up to the end of each."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.md5(text.cast("binary")).alias("digest"),
    )
    slices = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(slices, "digest", "doc_id").sortWithinPartitions("digest", "doc_id")

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, rows, size = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            n = batch.num_rows
            upto = np.cumsum(batch.column("size").to_numpy()) + size
            extra = [pa.array(np.full(n, part), pa.int32()), pa.array(np.arange(rows, rows + n)), pa.array(upto)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *extra], [*batch.schema.names, "slice", "nth", "upto"])
            if n:
                rows, size = rows + n, int(upto[-1])

    placed = stage(ranged.mapInArrow(number, PLACED), "placed")
    # One row per slice.
    totals = sorted(map(tuple, placed.groupBy("slice").agg(F.count("*"), F.sum("size")).collect()))
    before, rows, size = [], 0, 0
    for part, n, bytes_ in totals:
        before.append((part, rows, size))
        rows, size = rows + n, size + bytes_
    offsets = docs.sparkSession.createDataFrame(before, "slice int, _rows long, _bytes long")
    whole = placed.join(F.broadcast(offsets), "slice")
    return whole.select(
        "doc_id", "size", "text_crc32", "digest", (F.col("nth") + F.col("_rows")).alias("position"), (F.col("upto") + F.col("_bytes")).alias("upto")
    )


def _fill(ends: DataFrame, capacities: list[int], shards: int, total: int) -> list[list[int]]:
    """Where each capacity's greedy cuts lie; the last is the end of the last shard."""
    cuts: list[list[int]] = [[] for _ in capacities]
    at = [0] * len(capacities)
    for _ in range(shards - 1):
        reach = [a + c for a, c in zip(at, capacities)]
        near = ends.where((F.col("upto") > min(at)) & (F.col("upto") <= max(reach)))
        row = near.agg(*(F.max(F.when(F.col("upto") <= r, F.col("upto"))).alias(f"c{k}") for k, r in enumerate(reach))).first()
        for k, found in enumerate(row):
            at[k] = max(at[k], found or 0)
            cuts[k].append(at[k])
    for k, c in enumerate(capacities):
        cuts[k].append(min(total, at[k] + c))
    return cuts


def smallest_capacity(ends: DataFrame, largest: int, total: int, shards: int) -> tuple[int, list[int]]:
    """The least capacity whose greedy filling needs at most ``shards``, and its cuts."""
    share = -(-total // shards)
    low, high = max(share, largest), share + largest  # a shard less than full lacks room for one group at most
    best = None
    while True:
        step = max(1, -(-(high - low + 1) // PROBES))
        probes = sorted({*range(low, high, step), high})
        filled = _fill(ends, probes, shards, total)
        good = next(k for k, c in enumerate(filled) if c[-1] >= total)
        high, best = probes[good], filled[good]
        if good == 0 or step == 1:
            return high, best[:-1]
        low = probes[good - 1] + 1


def sharded(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Shards of near equal bytes: ``doc_id``, ``size``, ``text_crc32``, ``shard`` and ``slot``.

    Reads ``doc_id`` and ``text``; other columns are ignored. A row's size is the bytes of its text, and 1.
    Rows of equal texts (null counts as empty) share a shard. Slots of a shard are gapless from 0.
    Rows equal in text and id are numbered arbitrarily among themselves. With fewer groups than
    shards some shards are empty; an empty table stays empty.
    """
    rows = stage(_placed(docs), "numbered")
    ends = stage(rows.groupBy("digest").agg(F.max("upto").alias("upto"), F.sum("size").alias("size")), "group-ends")
    total, largest = ends.agg(F.max("upto"), F.max("size")).first()
    cuts = smallest_capacity(ends, largest, total, shards)[1] if total else []
    shard = sum(((F.col("upto") > c).cast("int") for c in cuts), F.lit(0))
    dealt = rows.withColumn("shard", shard)
    # One row per shard.
    first = {r[0]: r[1] for r in dealt.groupBy("shard").agg(F.min("position")).collect()}
    begin = F.lit(0)
    for k, p in first.items():
        begin = F.when(F.col("shard") == k, F.lit(p)).otherwise(begin)
    return dealt.select("doc_id", "size", "text_crc32", "shard", (F.col("position") - begin).cast("long").alias("slot"))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> None:
    """The documents with all their columns, in one folder per shard; rows of one id and text go together."""
    place = stage(
        sharded(docs, shards).select(F.col("doc_id").alias("_doc"), F.col("text_crc32").alias("_crc"), F.col("size").alias("_size"), "shard").distinct(), "places"
    )
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    keyed = packed(docs, _id=F.col("doc_id").cast("long"), _sum=F.crc32(text.cast("binary")), _bytes=F.octet_length(text) + 1)
    same = F.col("_id").eqNullSafe(F.col("_doc")) & (F.col("_sum") == F.col("_crc")) & (F.col("_bytes") == F.col("_size"))
    # A column of the documents called shard stays in their files under another name.
    rows = unpacked(keyed.join(place, same).withColumn("_row", F.col("_row").withField("_shard", F.col("shard"))))
    if "shard" in docs.columns:
        rows = rows.withColumnRenamed("shard", "own_shard")
    rows.withColumnRenamed("_shard", "shard").write.partitionBy("shard").parquet(path)
