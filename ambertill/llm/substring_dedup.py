"""Substring dedup by fixed-block anchors.

Every text is cut into non-overlapping reference blocks of ``(window + 1) // 2`` words. A
repeated window holds one whole reference block of each of its places, so the index of
reference blocks, probed with every rolling run of the block's length, finds every repeat.
A hit is then extended by whole words to all windows around it; windows with equal words
(a 64-bit hash besides the hash range) elsewhere are exact repeats, and overlapping ones
form the maximal repeats that are removed.

Index and probes meet by hash range; see ``blocks``. No range holds more than its share of
the distinct values of each block of documents, so a passage in a third of all documents
is one value per block.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ambertill.llm import scan
from ambertill.llm.blocks import ANSWERS, OFFERS, Block, Distinct, answer, in_blocks, per_block, ranges, repeats, with_answers

WINDOW = 35
RESULT = "doc_id bigint, n_words bigint, n_removed bigint, kept string, removed array<struct<first:bigint,words:bigint>>"
_WORD, _RUN, _SECOND = 11, 12, 13


class _Words:
    """The words of a block, and hashes of runs of words."""

    def __init__(self, block: Block):
        self.begin, self.end, self.rows = scan.word_spans(block.data, block.starts, scan.not_blank())
        prefix = scan.prefixes(scan.byte_values(_WORD)[block.data], _WORD)
        self.hashes = scan.span_hashes(prefix, self.begin, self.end, _WORD)
        self.total = len(self.begin)

    def runs(self, width: int, seed: int) -> np.ndarray:
        return scan.window_hashes(scan.prefixes(self.hashes, seed), width, seed)


def _probes(words: _Words, width: int, parts: int) -> tuple[Distinct, np.ndarray, np.ndarray]:
    """All rolling runs of the block: distinct values, their places, and which are reference blocks."""
    at = scan.window_starts(words.rows, width, words.total)
    hashes = words.runs(width, _RUN)[at]
    row = np.searchsorted(words.rows, at, side="right") - 1
    reference = (at - words.rows[row]) % width == 0
    return Distinct(hashes, hashes.astype(np.uint32), parts), at, reference


def _windows(words: _Words, hits: np.ndarray, width: int, window: int) -> np.ndarray:
    """Starts of all windows that hold a hit: the hit extended by words on both sides."""
    possible = scan.window_starts(words.rows, window, words.total)
    near = np.zeros(words.total + 1, np.int32)
    np.add.at(near, np.maximum(hits - (window - width), 0), 1)
    np.add.at(near, hits + 1, -1)
    return possible[np.cumsum(near)[possible] > 0]


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Remove all words covered by a window of ``window`` words that also starts elsewhere.

    Reads ``doc_id`` and ``text``; other columns are ignored. Returns one row per input row:
    ``doc_id``, ``n_words``, ``n_removed``, ``kept`` (the other words, joined by one space) and
    ``removed`` (maximal runs: number of the first word, words). Null and empty texts and texts
    shorter than a window keep all words; rows that repeat a text lose it in every copy; an
    empty table gives an empty result. Windows are judged on the input.
    """
    if window < 1:
        raise ValueError("a window needs a word")
    width = (window + 1) // 2
    parts = ranges(docs.sparkSession)
    blocks = in_blocks(docs)

    def probe(block: Block) -> pa.Table:
        found, _, reference = _probes(_Words(block), width, parts)
        return found.offers(block.number, found.any(reference), found.counts > 1)

    def in_index(first: np.ndarray, n: int, reference: np.ndarray, several: np.ndarray) -> np.ndarray:
        if not n:
            return np.zeros(0, bool)
        counts = np.diff(np.append(first, n))
        known = np.logical_or.reduceat(reference, first)
        return known & ((counts > 1) | several[first])

    hits = per_block(blocks, probe, OFFERS).groupBy("part").applyInArrow(answer(in_index, np.uint32, 2), ANSWERS)

    def around(block: Block, bits: pa.Table) -> tuple[_Words, np.ndarray, Distinct]:
        words = _Words(block)
        found, at, _ = _probes(words, width, parts)
        hit = at[found.answers(bits)[found.number]]
        starts = _windows(words, hit, width, window)
        high, low = words.runs(window, _RUN)[starts], words.runs(window, _SECOND)[starts]
        return words, starts, Distinct(high, low, parts)

    def grow(block: Block, bits: pa.Table) -> pa.Table:
        _, _, found = around(block, bits)
        return found.offers(block.number, found.counts > 1)

    again = repeats(with_answers(blocks, hits, grow, OFFERS))
    both = hits.selectExpr("block", "part", "bits", "0 AS round").union(again.selectExpr("block", "part", "bits", "1 AS round"))

    def finish(block: Block, bits: pa.Table) -> pa.Table:
        second = np.array(bits.column("round").to_pylist(), np.int64) == 1
        words, starts, found = around(block, bits.filter(pa.array(~second)))
        repeated = starts[found.answers(bits.filter(pa.array(second)))[found.number]]
        return _cut(block, words, scan.covered(repeated, window, words.total))

    return with_answers(blocks, both, finish, RESULT)


def _cut(block: Block, words: _Words, gone: np.ndarray) -> pa.Table:
    n_words = np.diff(words.rows)
    before = np.concatenate([[0], np.cumsum(gone)])
    n_removed = before[words.rows[1:]] - before[words.rows[:-1]]
    kept, removed = [], []
    for row in range(len(n_words)):
        a, b = words.rows[row], words.rows[row + 1]
        spans = []
        if not n_removed[row]:
            text = b" ".join(block.text(row).split())
        else:
            edges = np.flatnonzero(np.diff(gone[a:b].astype(np.int8), prepend=0, append=0)).reshape(-1, 2)
            spans = [{"first": int(s), "words": int(e - s)} for s, e in edges]
            pieces, at = [], 0
            for s, e in [*edges.tolist(), (b - a, b - a)]:
                if s > at:
                    piece = block.data[words.begin[a + at] : words.end[a + s - 1]].tobytes()
                    pieces.append(b" ".join(piece.split()))
                at = e
            text = b" ".join(pieces)
        kept.append(text.decode("utf-8", "replace"))
        removed.append(spans)
    kind = pa.list_(pa.struct([("first", pa.int64()), ("words", pa.int64())]))
    return pa.table(
        {
            "doc_id": block.ids,
            "n_words": pa.array(n_words, pa.int64()),
            "n_removed": pa.array(n_removed, pa.int64()),
            "kept": pa.array(kept, pa.string()),
            "removed": pa.array(removed, kind),
        }
    )
