"""Documents in blocks, and the exchange of hash sets between blocks and hash ranges.

A *block* is about ``ROWS`` documents chosen by hash. Operators that need a text more than
once group the same rows by block each time, so Spark shuffles the texts once and reuses that
exchange. Between the passes travel only packed sets of hashes: each block sends its sorted,
distinct values to every hash range (``part``), the range answers with one bit per value.
Since the order of a sorted set is fixed, a pass that is run again (a lost executor) finds
the same bits, and a value that occurs a million times travels once per block.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ambertill.llm.scan import flat

#: Documents in a block, on average.
ROWS = 512
#: Hash ranges for each shuffle partition.
RANGES = 2

OFFERS = "part int, block int, items binary, flags binary"
ANSWERS = "block int, part int, bits binary"


def in_blocks(docs: DataFrame, rows: int = ROWS) -> DataFrame:
    """``block``, ``doc_id`` and ``text`` of all documents; every other column is left behind."""
    blocks = max(1, math.ceil(docs.count() / rows))
    return docs.select(
        F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int").alias("block"),
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
    )


def ranges(spark: SparkSession) -> int:
    return RANGES * int(spark.conf.get("spark.sql.shuffle.partitions"))


class Block:
    """The texts of a block in one array, in the same order whenever the block is read."""

    def __init__(self, table: pa.Table):
        table = table.sort_by([("doc_id", "ascending"), ("text", "ascending")])
        self.number = table.column("block")[0].as_py()
        self.ids = table.column("doc_id").combine_chunks()
        self.data, self.starts = flat(table.column("text"))

    def text(self, row: int) -> bytes:
        return self.data[self.starts[row] : self.starts[row + 1]].tobytes()


class Distinct:
    """Sorted distinct hash values of a block, the range of each, and where each came from."""

    def __init__(self, high: np.ndarray, low: np.ndarray, parts: int):
        part = ((high >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
        order = np.lexsort((low, part))
        part, low = part[order], low[order]
        new = np.ones(len(low), bool)
        new[1:] = (low[1:] != low[:-1]) | (part[1:] != part[:-1])
        self.first = np.flatnonzero(new)
        self.order = order
        self.values, self.part = low[self.first], part[self.first]
        self.counts = np.diff(np.append(self.first, len(low)))
        self.edges = np.searchsorted(self.part, np.arange(parts + 1, dtype=np.uint64))
        rank = np.cumsum(new) - 1
        self.number = np.empty(len(low), np.int64)
        self.number[order] = rank

    def any(self, marks: np.ndarray) -> np.ndarray:
        """For every distinct value: is one of its places marked?"""
        return np.logical_or.reduceat(marks[self.order], self.first) if len(self.first) else np.zeros(0, bool)

    def offers(self, block: int, *flags: np.ndarray) -> pa.Table:
        """One row per range: its values, and the flags of the values, one bit each."""
        used = np.flatnonzero(np.diff(self.edges))
        items, bits = [], []
        for p in used:
            a, b = self.edges[p], self.edges[p + 1]
            items.append(self.values[a:b].tobytes())
            bits.append(b"".join(np.packbits(f[a:b]).tobytes() for f in flags))
        return pa.table(
            {
                "part": pa.array(used, pa.int32()),
                "block": pa.array(np.full(len(used), block), pa.int32()),
                "items": pa.array(items, pa.binary()),
                "flags": pa.array(bits, pa.binary()),
            }
        )

    def answers(self, table: pa.Table) -> np.ndarray:
        """The bit of every distinct value."""
        out = np.zeros(len(self.values), bool)
        for part, bits in zip(table.column("part").to_pylist(), table.column("bits").to_pylist()):
            a, b = self.edges[part], self.edges[part + 1]
            out[a:b] = np.unpackbits(np.frombuffer(bits, np.uint8), count=b - a).astype(bool)
        return out


def answer(judge: Callable[..., np.ndarray], dtype, flags: int) -> Callable[[pa.Table], pa.Table]:
    """The function of one hash range: ``judge(sorted values, first of each run, *flags)`` says which runs are hit."""

    def run(table: pa.Table) -> pa.Table:
        items = table.column("items").to_pylist()
        lengths = np.array([len(x) // np.dtype(dtype).itemsize for x in items])
        values = np.frombuffer(b"".join(items), dtype)
        marks: list[list[np.ndarray]] = [[] for _ in range(flags)]
        for n, raw in zip(lengths, table.column("flags").to_pylist()):
            raw, width = np.frombuffer(raw, np.uint8), -(-n // 8)
            for k in range(flags):
                marks[k].append(np.unpackbits(raw[k * width : (k + 1) * width], count=n).astype(bool))
        order = np.argsort(values, kind="stable")
        values = values[order]
        new = np.ones(len(values), bool)
        new[1:] = values[1:] != values[:-1]
        hit = judge(np.flatnonzero(new), len(values), *(np.concatenate(m)[order] for m in marks))
        told = np.empty(len(values), bool)
        told[order] = hit[np.cumsum(new) - 1]
        ends = np.cumsum(lengths)
        return pa.table(
            {
                "block": table.column("block").cast(pa.int32()),
                "part": table.column("part").cast(pa.int32()),
                "bits": pa.array([np.packbits(told[e - n : e]).tobytes() for n, e in zip(lengths, ends)], pa.binary()),
            }
        )

    return run


def per_block(blocks: DataFrame, work: Callable[[Block], pa.Table], schema: str) -> DataFrame:
    return blocks.groupBy("block").applyInArrow(lambda table: work(Block(table)), schema)


def with_answers(blocks: DataFrame, answers: DataFrame, work: Callable[[Block, pa.Table], pa.Table], schema: str) -> DataFrame:
    """``work`` on each block and the answers for it, if it has documents."""
    empty = to_arrow_schema(StructType.fromDDL(schema)).empty_table()

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        return work(Block(left), right) if left.num_rows else empty

    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, schema)


def repeats(offers: DataFrame, dtype=np.uint64) -> DataFrame:
    """Answers to offers with one flag (more than one place in the block): values with another place anywhere."""

    def judge(first: np.ndarray, n: int, several: np.ndarray) -> np.ndarray:
        counts = np.diff(np.append(first, n))
        return (counts > 1) | several[first]

    return offers.groupBy("part").applyInArrow(answer(judge, dtype, 1), ANSWERS)
