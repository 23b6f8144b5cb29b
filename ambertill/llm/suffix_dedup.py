"""Dedup of long byte strings with run-length indexes.

Suffixes of a whole corpus do not fit one index, so texts are first dealt out by content:
every string of ``length`` bytes has an anchor, its part of least hash, and strings with the
same anchor meet in one hash range. Consecutive strings with one anchor form a region.
Regions that occur twice byte for byte (by 128 bits of hash) are repeated as a whole. One copy
of each different region of a repeated anchor goes to the range, which builds a
run-compressed Burrows-Wheeler transform with sampled run ends, streams the matching
statistics of the regions and marks matches of ``length`` bytes. Regions of an anchor with
more than ``HOT_REGIONS`` different regions (a passage with other surroundings in very many
documents) are compared by the hashes of their strings, spread over all ranges.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ambertill.llm import scan
from ambertill.llm.blocks import Block, Distinct, answer, in_blocks, per_block, ranges, with_answers
from ambertill.llm.run_index import RunIndex

LENGTH = 400
GRAM = 32
#: Different regions of one anchor that are put in one index.
HOT_REGIONS = 4096
#: Bytes of one index; one anchor may need more.
INDEX_BYTES = 500_000
RESULT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary, removed array<struct<first:bigint,bytes:bigint>>"
_ANCHOR, _REGION, _SECOND = 21, 22, 23

#: A region: hashes of its anchor and of its bytes, its first string and the number of strings.
_REGIONS = np.dtype([("anchor", "<u8"), ("digest", "<u8"), ("first", "<u4"), ("strings", "<u4")])
_FULL, _INDEXED, _SPREAD = 1, 2, 4
_TOLD = np.dtype([("anchor", "<u8"), ("first", "<u4"), ("strings", "<u4"), ("how", "u1")])
_SENT = np.dtype([("anchor", "<u8"), ("first", "<u4"), ("strings", "<u4")])


def _range_of(anchors: np.ndarray, parts: int) -> np.ndarray:
    """The range of each anchor; being least hashes, anchors are small numbers and are mixed again."""
    hashes = scan.mix(anchors)
    return (((hashes >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)


def _dealt(part: np.ndarray, block: int, items: np.ndarray) -> pa.Table:
    """One row for each range that gets items of this block."""
    order = np.argsort(part, kind="stable")
    part, items = part[order], items[order]
    cuts = np.flatnonzero(np.diff(part, prepend=-1))
    ends = np.append(cuts[1:], len(part))
    return pa.table(
        {
            "part": pa.array(part[cuts], pa.int32()),
            "block": pa.array(np.full(len(cuts), block), pa.int32()),
            "items": pa.array([items[a:b].tobytes() for a, b in zip(cuts, ends)], pa.binary()),
        }
    )


def _returned(blocks: np.ndarray, items: np.ndarray) -> pa.Table:
    """Items of a range by block, all in one row for each block."""
    order = np.argsort(blocks, kind="stable")
    blocks, items = blocks[order], items[order]
    cuts = np.flatnonzero(np.diff(blocks, prepend=-1))
    ends = np.append(cuts[1:], len(blocks))
    return pa.table(
        {
            "block": pa.array(blocks[cuts], pa.int32()),
            "part": pa.array(np.zeros(len(cuts)), pa.int32()),
            "bits": pa.array([items[a:b].tobytes() for a, b in zip(cuts, ends)], pa.binary()),
        }
    )


def _gathered(table: pa.Table, column: str, kind: np.dtype) -> tuple[np.ndarray, np.ndarray]:
    """All items of the rows, and the block of each."""
    raw = table.column(column).to_pylist()
    counts = np.array([len(x) // kind.itemsize for x in raw], np.int64)
    joined = b"".join(raw)
    items = np.frombuffer(joined, kind) if joined else np.zeros(0, kind)
    return items, np.repeat(table.column("block").to_numpy(), counts)


def _judge(table: pa.Table) -> pa.Table:
    """Which regions of a range are repeated as a whole, which go into the index."""
    regions, blocks = _gathered(table, "items", _REGIONS)
    order = np.lexsort((blocks, regions["digest"], regions["anchor"]))
    regions, blocks = regions[order], blocks[order]
    anchor = np.ones(len(regions), bool)
    anchor[1:] = regions["anchor"][1:] != regions["anchor"][:-1]
    same = np.ones(len(regions), bool)
    same[1:] = anchor[1:] | (regions["digest"][1:] != regions["digest"][:-1])
    kinds = np.add.reduceat(same, np.flatnonzero(anchor))[np.cumsum(anchor) - 1]
    copies = np.diff(np.append(np.flatnonzero(same), len(same)))[np.cumsum(same) - 1]
    told = np.zeros(len(regions), _TOLD)
    for name in ("anchor", "first", "strings"):
        told[name] = regions[name]
    # Copies in a range of many kinds are known to be repeated, but others are compared with one of them.
    told["how"] = (
        _FULL * (copies > 1)
        + _INDEXED * (same & (kinds > 1) & (kinds <= HOT_REGIONS))
        + _SPREAD * (same & (kinds > HOT_REGIONS))
    )
    some = told["how"] > 0
    return _returned(blocks[some], told[some])


def _indexed(table: pa.Table, length: int) -> pa.Table:
    """Marks of one range: indexes of the regions of some anchors each, matches of the wanted length."""
    regions, blocks = _gathered(table, "items", _SENT)
    data, _ = scan.flat(table.column("flags"))
    sizes = regions["strings"].astype(np.int64) + length - 1
    starts = np.cumsum(sizes) - sizes
    order = np.argsort(regions["anchor"], kind="stable")
    anchor = regions["anchor"][order]
    new = np.flatnonzero(np.diff(anchor, prepend=anchor[:1] ^ np.uint64(1)))
    before = np.concatenate([[0], np.cumsum(sizes[order])])
    lot = before[new] // INDEX_BYTES
    cuts = [*new[np.flatnonzero(np.diff(lot, prepend=-1))].tolist(), len(order)]
    marks, holders = [], []
    for a, b in zip(cuts, cuts[1:]):
        chosen = order[a:b]
        text = np.concatenate([data[starts[k] : starts[k] + sizes[k]] for k in chosen])
        rows = before[a : b + 1] - before[a]
        long = RunIndex(text, rows).repeated(length)
        edges = np.flatnonzero(np.diff(long.astype(np.int8), prepend=0, append=0)).reshape(-1, 2)
        row = np.searchsorted(rows, edges[:, 0], side="right") - 1
        found = np.zeros(len(edges), _TOLD)
        found["first"] = regions["first"][chosen[row]] + (edges[:, 0] - rows[row])
        found["strings"] = edges[:, 1] - edges[:, 0]
        found["how"] = _FULL
        marks.append(found)
        holders.append(blocks[chosen[row]])
    return _returned(np.concatenate(holders), np.concatenate(marks))


def remove_repeated_bytes(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """Remove all bytes covered by a string of ``length`` bytes that also starts elsewhere.

    Reads ``doc_id`` and ``text``; other columns are ignored. Texts are taken as UTF-8 bytes,
    null as empty; matches stay inside a document. Returns one row per input row: ``doc_id``,
    ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs), ``kept`` (the other bytes) and
    ``removed``. Texts shorter than ``length`` keep everything; repeated rows lose a repeated string
    in every copy; an empty table gives an empty result.
    """
    gram = min(GRAM, length)
    parts = ranges(docs.sparkSession)
    blocks = in_blocks(docs)

    def find(block: Block) -> pa.Table:
        _, anchor, first, last = scan.anchors(block.data, block.starts, length, gram, _ANCHOR)
        prefix = scan.prefixes(scan.byte_values(_REGION)[block.data], _REGION)
        regions = np.zeros(len(first), _REGIONS)
        regions["anchor"], regions["first"], regions["strings"] = anchor, first, last - first + 1
        regions["digest"] = scan.span_hashes(prefix, first, last + length, _REGION)
        return _dealt(_range_of(anchor, parts), block.number, regions)

    told = (
        per_block(blocks, find, "part int, block int, items binary")
        .groupBy("part")
        .applyInArrow(_judge, "block int, part int, bits binary")
    )

    def windows(block: Block, regions: np.ndarray) -> tuple[np.ndarray, Distinct]:
        """The strings of the regions that are compared by hash."""
        spread = regions[(regions["how"] & _SPREAD) > 0]
        at = _each(spread)
        high, low = (
            scan.span_hashes(scan.prefixes(scan.byte_values(seed)[block.data], seed), at, at + length, seed) if len(at) else np.zeros(0, np.uint64)
            for seed in (_REGION, _SECOND)
        )
        return at, Distinct(high, low, parts)

    def send(block: Block, bits: pa.Table) -> pa.Table:
        regions = _sorted(_gathered(bits, "bits", _TOLD)[0])
        chosen = regions[(regions["how"] & _INDEXED) > 0]
        part = _range_of(chosen["anchor"], parts)
        sent = np.zeros(len(chosen), _SENT)
        for name in _SENT.names:
            sent[name] = chosen[name]
        out = _dealt(part, block.number, sent)
        texts = []
        for raw in out.column("items").to_pylist():
            texts.append(b"".join(block.data[f : f + s + length - 1].tobytes() for _, f, s in np.frombuffer(raw, _SENT).tolist()))
        out = out.append_column("flags", pa.array(texts, pa.binary()))
        _, found = windows(block, regions)
        if len(found.values):
            other = found.offers(block.number, found.counts > 1)
            other = other.set_column(0, "part", pa.array(-1 - other.column("part").to_numpy(), pa.int32()))
            out = pa.concat_tables([out, other])
        return out

    spread = answer(lambda first, n, several: (np.diff(np.append(first, n)) > 1) | several[first], np.uint64, 1)

    def mark(table: pa.Table) -> pa.Table:
        return _indexed(table, length) if table.column("part")[0].as_py() >= 0 else spread(table)

    # As many tasks as ranges: an index takes much more time than its bytes suggest.
    sent = with_answers(blocks, told, send, "part int, block int, items binary, flags binary").repartition(parts, "part")
    marked = sent.groupBy("part").applyInArrow(mark, "block int, part int, bits binary")
    both = told.withColumn("round", F.lit(0)).union(marked.withColumn("round", F.lit(1)))

    def finish(block: Block, bits: pa.Table) -> pa.Table:
        first_round = np.array(bits.column("round").to_pylist(), np.int64) == 0
        hashed = np.array(bits.column("part").to_pylist(), np.int64) < 0
        regions = _sorted(_gathered(bits.filter(pa.array(~hashed)), "bits", _TOLD)[0])
        full = regions[(regions["how"] & _FULL) > 0]
        repeated = [_each(full)]
        if hashed.any():
            at, found = windows(block, _sorted(_gathered(bits.filter(pa.array(first_round)), "bits", _TOLD)[0]))
            answers = bits.filter(pa.array(hashed))
            answers = answers.set_column(answers.schema.get_field_index("part"), "part", pa.array(-1 - answers.column("part").to_numpy(), pa.int32()))
            repeated.append(at[found.answers(answers)[found.number]])
        return _cut(block, scan.covered(np.concatenate(repeated), length, len(block.data)))

    return with_answers(blocks, both, finish, RESULT)


def _sorted(regions: np.ndarray) -> np.ndarray:
    return regions[np.argsort(regions["first"], kind="stable")]


def _each(regions: np.ndarray) -> np.ndarray:
    """Every start in the regions."""
    counts = regions["strings"].astype(np.int64)
    firsts = np.repeat(regions["first"].astype(np.int64) - (np.cumsum(counts) - counts), counts)
    return firsts + np.arange(len(firsts))


def _cut(block: Block, gone: np.ndarray) -> pa.Table:
    n_bytes = np.diff(block.starts)
    before = np.concatenate([[0], np.cumsum(gone)])
    n_removed = before[block.starts[1:]] - before[block.starts[:-1]]
    kept, removed = [], []
    for row in range(len(n_bytes)):
        a, b = block.starts[row], block.starts[row + 1]
        if n_removed[row]:
            part = gone[a:b]
            edges = np.flatnonzero(np.diff(part.astype(np.int8), prepend=0, append=0)).reshape(-1, 2)
            removed.append([{"first": int(s), "bytes": int(e - s)} for s, e in edges])
            kept.append(block.data[a:b][~part].tobytes())
        else:
            removed.append([])
            kept.append(block.text(row))
    kind = pa.list_(pa.struct([("first", pa.int64()), ("bytes", pa.int64())]))
    return pa.table(
        {
            "doc_id": block.ids,
            "n_bytes": pa.array(n_bytes, pa.int64()),
            "n_removed": pa.array(n_removed, pa.int64()),
            "n_spans": pa.array([len(r) for r in removed], pa.int64()),
            "kept": pa.array(kept, pa.binary()),
            "removed": pa.array(removed, kind),
        }
    )
