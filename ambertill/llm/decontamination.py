"""Benchmark decontamination with a positional inverted index.

``build_index`` stores the postings of all training tokens, partitioned by document: one row
holds some 2 MB of text as the sorted distinct terms and, for each, the ascending positions where it
stands. A search takes the stated test phrases to every row of the index, in lots of a bounded
size: it starts from the postings of the term that is rarest there, shifts them by the term's
place in the phrase, and intersects them with the postings of the other terms, rarest first.
Nothing is shuffled, and a frequent phrase costs only its own matches.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ambertill.llm import scan
from ambertill.llm.rows import content, without
from ambertill.session import stage

WINDOW = 10
#: Words of test items that are searched for at once; what is broadcast is some 100 bytes for each.
LOT_WORDS = 200_000
#: Candidate places that are intersected at once.
CANDIDATES = 200_000
_TERM = 41

INDEX = "doc_ids array<bigint>, contents array<bigint>, firsts binary, terms binary, offsets binary, positions binary"
MARKS = "hits binary, items array<array<bigint>>"
RESULT = "doc_id bigint, content bigint, n_words bigint, n_hit bigint, items array<bigint>"


def _lower() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table


def _letters() -> np.ndarray:
    table = np.zeros(256, bool)
    table[48:58] = table[97:123] = table[128:] = True
    return table


def _terms(column) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and the number of the first word of every row (one more at the end)."""
    data, starts = scan.flat(column)
    data = _lower()[data]
    begin, end, firsts = scan.word_spans(data, starts, _letters())
    return scan.span_hashes(scan.prefixes(scan.byte_values(_TERM)[data], _TERM), begin, end, _TERM), firsts


def build_index(docs: DataFrame) -> DataFrame:
    """The stored postings of all words (A-Z lower-cased) of ``docs``; null has none. Other columns are ignored."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in scan.sliced(batch, "text"):
                hashes, firsts = _terms(piece.column("text"))
                terms, number, counts = np.unique(hashes, return_inverse=True, return_counts=True)
                positions = np.argsort(number, kind="stable").astype(np.uint32)
                offsets = np.concatenate([[0], np.cumsum(counts)])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([piece.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                        pa.array([piece.column("content").to_pylist()], pa.list_(pa.int64())),
                        *(pa.array([x.tobytes()], pa.binary()) for x in (firsts.astype(np.int64), terms, offsets.astype(np.int64), positions)),
                    ],
                    ["doc_ids", "contents", "firsts", "terms", "offsets", "positions"],
                )

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), content().alias("content"), F.col("text").cast("string").alias("text"))
    return stage(chosen.mapInArrow(work, INDEX), "postings")


class Postings:
    """One row of the index."""

    def __init__(self, row: dict):
        self.firsts = np.frombuffer(row["firsts"], np.int64)
        self.terms = np.frombuffer(row["terms"], np.uint64) if row["terms"] else np.zeros(0, np.uint64)
        self.offsets = np.frombuffer(row["offsets"], np.int64)
        self.positions = np.frombuffer(row["positions"], np.uint32) if row["positions"] else np.zeros(0, np.uint32)
        self.total = int(self.firsts[-1])
        # Which posting list each position is in: a test of membership in any list takes one step.
        self.list_at = np.full(self.total, -1, np.int32)
        self.list_at[self.positions] = np.repeat(np.arange(len(self.terms), dtype=np.int32), np.diff(self.offsets))

    def lists(self, terms: np.ndarray) -> np.ndarray:
        """The number of the posting list of every term, -1 without one."""
        if not len(self.terms):
            return np.full(len(terms), -1, np.int64)
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return np.where(self.terms[at] == terms, at, -1)

    def document(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.firsts, positions, side="right") - 1

    def phrases(self, terms: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Exact matches of the phrases ``terms[start:start + length]``: phrase numbers and positions."""
        if not len(starts):
            return
        lists = self.lists(terms)
        sizes = np.where(lists >= 0, np.diff(self.offsets)[lists] if len(self.terms) else 0, 0)
        width = int(lengths.max())
        place = starts[:, None] + np.minimum(np.arange(width), lengths[:, None] - 1)
        frequency = sizes[place]
        possible = np.flatnonzero(frequency.min(axis=1) > 0)
        rank = np.argsort(frequency[possible], axis=1, kind="stable")
        candidates = frequency[possible, rank[:, 0]]
        lot = np.cumsum(candidates) // CANDIDATES
        cuts = [*np.flatnonzero(np.diff(lot, prepend=-1)).tolist(), len(possible)]
        for a, b in zip(cuts, cuts[1:]):
            phrase, turn, counts = possible[a:b], rank[a:b], candidates[a:b]
            shift = np.minimum(turn, lengths[phrase][:, None] - 1)
            rarest = lists[starts[phrase] + shift[:, 0]]
            which = np.repeat(np.arange(len(phrase)), counts)
            nth = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            at = self.positions[self.offsets[rarest][which] + nth].astype(np.int64) - shift[which, 0]
            keep = (at >= 0) & (at + lengths[phrase][which] <= self.total)
            which, at = which[keep], at[keep]
            for k in range(1, width):
                wanted = lists[starts[phrase] + shift[:, k]]
                keep = self.list_at[at + shift[which, k]] == wanted[which]
                which, at = which[keep], at[keep]
            same = self.document(at) == self.document(at + lengths[phrase][which] - 1)
            yield phrase[which[same]], at[same]

    def near(self, terms: np.ndarray, within: int) -> list[int]:
        """Documents where some ``within`` consecutive words hold all of the terms, however ordered."""
        lists = np.unique(self.lists(np.unique(terms)))
        if not len(lists) or lists[0] < 0:
            return []
        lists = lists[np.argsort(np.diff(self.offsets)[lists], kind="stable")]
        rarest = self.positions[self.offsets[lists[0]] : self.offsets[lists[0] + 1]].astype(np.int64)
        found = set()
        # A span that holds all terms can be taken to begin at any of the places left of a rarest term.
        begin = np.unique((rarest[:, None] - np.arange(within)).ravel())
        begin = begin[begin >= 0]
        end = np.minimum(begin + within, self.firsts[self.document(begin) + 1])
        for k in lists:
            held = self.positions[self.offsets[k] : self.offsets[k + 1]].astype(np.int64)
            keep = np.searchsorted(held, begin) < np.searchsorted(held, end)
            begin, end = begin[keep], end[keep]
        found.update(self.document(begin).tolist())
        return sorted(found)


def _lots(items: DataFrame) -> Iterator[tuple[bool, list, np.ndarray, np.ndarray]]:
    """Test items in lots: is it the last, ids, hashes of all words, and the first word of each item."""
    plain = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    size = plain.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    lots = max(1, math.ceil(size / (5 * LOT_WORDS)))
    for lot in range(lots):
        table = plain.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(lots)) == lot).toArrow()
        hashes, firsts = _terms(table.column("text"))
        yield lot == lots - 1, table.column("item_id").to_pylist(), hashes, firsts


def _windows(firsts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and item of every window of every item."""
    lengths = np.diff(firsts)
    counts = np.where(lengths > 0, np.maximum(lengths - width + 1, 1), 0)
    item = np.repeat(np.arange(len(lengths)), counts)
    start = firsts[:-1][item] + np.arange(len(item)) - np.repeat(np.cumsum(counts) - counts, counts)
    return start, np.minimum(lengths[item], width), item


def contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Which words of which documents stand in test items.

    Reads ``doc_id`` and ``text`` of ``docs``, ``item_id`` and ``text`` of ``items``; other columns are
    ignored. A window is ``window`` consecutive words of an item, or all of its words if they are fewer; a
    document word inside an occurrence of a window is hit. Returns one row per document row:
    ``doc_id``, ``content`` (hash of the text), ``n_words``, ``n_hit`` and ``items`` (distinct ids of items with a window there).
    Null and empty texts have no words; rows of ``items`` with one id count as one item, and items
    without an id mark words but are not listed; empty tables give no rows, or no hits.
    """
    found = build_index(docs).select("*", F.lit(None).cast("binary").alias("hits"), F.lit(None).cast("array<array<bigint>>").alias("items"))
    context = docs.sparkSession.sparkContext
    for last, ids, hashes, firsts in _lots(items):
        lot = context.broadcast((ids, hashes, *_windows(firsts, window)))

        def work(batches: Iterator[pa.RecordBatch], lot=lot, last=last) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in range(batch.num_rows):
                    one = batch.slice(row, 1)
                    hit, listed = _marked(one.to_pylist()[0], *lot.value)
                    yield _per_document(one, hit, listed) if last else _with_marks(one, hit, listed)

        found = found.mapInArrow(work, RESULT) if last else stage(found.mapInArrow(work, f"{INDEX}, {MARKS}"), "marks")
    return found


def _marked(row: dict, ids: list, terms: np.ndarray, starts: np.ndarray, lengths: np.ndarray, item: np.ndarray) -> tuple[np.ndarray, list[set]]:
    """Hit words and listed items of one row of the index, those of earlier lots included."""
    index = Postings(row)
    hit = np.unpackbits(np.frombuffer(row["hits"], np.uint8), count=index.total) if row["hits"] else np.zeros(index.total, np.uint8)
    listed = [set(x) for x in row["items"] or [[]] * (len(index.firsts) - 1)]
    ends = np.zeros(index.total + 1, np.int32)
    for phrase, at in index.phrases(terms, starts, lengths):
        np.add.at(ends, at, 1)
        np.add.at(ends, at + lengths[phrase], -1)
        for d, i in np.unique(np.stack([index.document(at), item[phrase]], 1), axis=0).tolist():
            listed[d].add(ids[i])
    return hit | (np.cumsum(ends[:-1]) > 0), listed


def _with_marks(row: pa.RecordBatch, hit: np.ndarray, listed: list[set]) -> pa.RecordBatch:
    marks = [pa.array([np.packbits(hit).tobytes()], pa.binary()), pa.array([[list(x) for x in listed]], pa.list_(pa.list_(pa.int64())))]
    return pa.RecordBatch.from_arrays([*row.columns[:-2], *marks], names=row.schema.names)


def _per_document(row: pa.RecordBatch, hit: np.ndarray, listed: list[set]) -> pa.RecordBatch:
    firsts = np.frombuffer(row.column("firsts")[0].as_py(), np.int64)
    before = np.concatenate([[0], np.cumsum(hit, dtype=np.int64)])
    return pa.RecordBatch.from_arrays(
        [
            pa.array(row.column("doc_ids")[0].as_py(), pa.int64()),
            pa.array(row.column("contents")[0].as_py(), pa.int64()),
            pa.array(np.diff(firsts), pa.int64()),
            pa.array(np.diff(before[firsts]), pa.int64()),
            pa.array([sorted(i for i in x if i is not None) for x in listed], pa.list_(pa.int64())),
        ],
        ["doc_id", "content", "n_words", "n_hit", "items"],
    )


def proximity_matches(docs: DataFrame, items: DataFrame, within: int) -> DataFrame:
    """``item_id`` and ``doc_id`` where some ``within`` consecutive words of the document hold all words of the item, in any order.

    Items without words match nothing. Null handling as in ``contaminated``.
    """
    index = build_index(docs)
    context = docs.sparkSession.sparkContext
    parts: list[DataFrame] = []
    for _, ids, hashes, firsts in _lots(items):
        lot = context.broadcast((ids, hashes, firsts))

        def work(batches: Iterator[pa.RecordBatch], lot=lot) -> Iterator[pa.RecordBatch]:
            ids, hashes, firsts = lot.value
            for batch in batches:
                for row in range(batch.num_rows):
                    values = batch.slice(row, 1).to_pylist()[0]
                    index = Postings(values)
                    pairs = [
                        (ids[i], values["doc_ids"][d])
                        for i in range(len(ids))
                        for d in index.near(hashes[firsts[i] : firsts[i + 1]], within)
                    ]
                    yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], ["item_id", "doc_id"])

        parts.append(index.mapInArrow(work, "item_id bigint, doc_id bigint"))
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out.distinct()


def drop_contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents without a hit word, with all their columns; the rest as ``contaminated`` says."""
    bad = contaminated(docs, items, window).where("n_hit > 0").select("doc_id", "content").distinct()
    return without(docs, stage(bad, "contaminated"))
