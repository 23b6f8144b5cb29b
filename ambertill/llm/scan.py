"""Whole texts as flat byte arrays: words, window hashes and sampled anchors with numpy.

The functions work on one block of documents at a time, all texts of the block in
one array, so that the cost per document is small. Hashes are polynomials over random byte
(or word) values modulo 2^64 with an odd base, and are mixed at the end.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

#: Bytes that separate words: space and tab to carriage return.
BLANKS = b" \t\n\v\f\r"
#: Bytes of text taken at once where a batch may hold more.
SLICE_BYTES = 2_000_000


def flat(column) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary column, and where each row starts (one more at the end); null is empty."""
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if isinstance(array, pa.ChunkedArray):
        array = pa.concat_arrays(array.chunks)
    array = array.cast(pa.large_binary())
    if array.null_count:
        array = array.fill_null(b"")
    if not len(array):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = array.buffers()
    starts = np.frombuffer(offsets, np.int64)[array.offset : array.offset + len(array) + 1]
    if data is None or starts[-1] == starts[0]:
        return np.zeros(0, np.uint8), np.zeros(len(array) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[starts[0] : starts[-1]], starts - starts[0]


def sliced(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive parts of a batch with about ``most`` bytes of text each; a longer text stands alone."""
    if not batch.num_rows:
        return
    lengths = np.diff(flat(batch.column(column))[1])
    part = np.cumsum(lengths) // most
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        yield batch.slice(a, b - a)


@lru_cache(maxsize=16)
def _base(seed: int) -> tuple[int, int]:
    base = random.Random(seed).getrandbits(64) | 5
    return base, pow(base, -1, 1 << 64)


_POWERS: dict[tuple[int, bool], np.ndarray] = {}


def powers(seed: int, n: int, inverse: bool = False) -> np.ndarray:
    """The first ``n`` powers of the base (or of its inverse). Even seeds share one base and odd ones another."""
    seed %= 2
    known = _POWERS.get((seed, inverse))
    if known is None or len(known) < n:
        factors = np.full(max(n, 1 << 16), _base(seed)[inverse], np.uint64)
        factors[0] = 1
        known = np.multiply.accumulate(factors)
        if len(known) <= 1 << 23:
            _POWERS[seed, inverse] = known
    return known[:n]


@lru_cache(maxsize=16)
def byte_values(seed: int) -> np.ndarray:
    draw = random.Random(seed * 7919 + 1)
    return np.array([draw.getrandbits(64) for _ in range(256)], np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the high bits over the low ones."""
    h = h ^ (h >> np.uint64(32))
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def prefixes(values: np.ndarray, seed: int) -> np.ndarray:
    """Prefix sums of values times powers; one longer than the input."""
    out = np.empty(len(values) + 1, np.uint64)
    out[0] = 0
    np.cumsum(values * powers(seed, len(values)), out=out[1:])
    return out


def span_hashes(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    """Hash of every span ``[start, end)`` of the sequence that ``prefix`` was made of."""
    return mix((prefix[ends] - prefix[starts]) * powers(seed, len(prefix), True)[starts])


def window_hashes(prefix: np.ndarray, width: int, seed: int) -> np.ndarray:
    """Hash of every run of ``width`` consecutive elements."""
    n = len(prefix) - width
    if n <= 0:
        return np.zeros(0, np.uint64)
    return mix((prefix[width:] - prefix[:n]) * powers(seed, n, True))


def word_spans(data: np.ndarray, starts: np.ndarray, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and end byte of each word, and the number of the first word of each row (one more at the end).

    ``letters`` says for each of the 256 bytes whether it belongs to words. A word never crosses rows.
    """
    inside = letters[data]
    n = len(data)
    begins = np.empty(n, bool)
    begins[:1] = inside[:1]
    begins[1:] = inside[1:] & ~inside[:-1]
    rows = starts[(starts > 0) & (starts < n)]
    begins[rows] = inside[rows]
    finishes = np.empty(n, bool)
    finishes[n - 1 :] = inside[n - 1 :]
    finishes[:-1] = inside[:-1] & ~inside[1:]
    finishes[rows - 1] = inside[rows - 1]
    first = np.flatnonzero(begins)
    return first, np.flatnonzero(finishes) + 1, np.searchsorted(first, starts)


@lru_cache(maxsize=4)
def not_blank() -> np.ndarray:
    table = np.ones(256, bool)
    table[list(BLANKS)] = False
    return table


def window_starts(firsts: np.ndarray, width: int, total: int) -> np.ndarray:
    """Which element numbers start a run of ``width`` elements inside one row.

    ``firsts`` are the numbers of the first elements of the rows, one more at the end.
    """
    ok = np.zeros(total + 1, np.int32)
    lengths = np.diff(firsts)
    has = lengths >= width
    np.add.at(ok, firsts[:-1][has], 1)
    np.add.at(ok, (firsts[1:] - width + 1)[has], -1)
    return np.flatnonzero(np.cumsum(ok[:-1]) > 0)


def covered(starts: np.ndarray, width: int | np.ndarray, total: int) -> np.ndarray:
    """Which of ``total`` elements lie in a run that begins at one of ``starts``."""
    ends = np.zeros(total + 1, np.int32)
    np.add.at(ends, starts, 1)
    np.add.at(ends, starts + width, -1)
    return np.cumsum(ends[:-1]) > 0


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, in linear time."""
    n = len(values)
    if n < width:
        return values[:0]
    padded = np.full(-(-n // width) * width, np.iinfo(values.dtype).max, values.dtype)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    forward = np.minimum.accumulate(blocks, axis=1).ravel()
    backward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[: n - width + 1], forward[width - 1 : n])


def anchors(data: np.ndarray, starts: np.ndarray, length: int, gram: int, seed: int) -> tuple[np.ndarray, ...]:
    """The anchor of every string of ``length`` bytes: its leftmost ``gram``-byte part of least hash.

    Equal strings have equal anchors at equal places. Returns per anchor its position, its hash,
    and the first and last start of the strings that it stands for.
    """
    n = len(data)
    width = length - gram + 1
    if n < length:
        empty = np.zeros(0, np.int64)
        return empty, np.zeros(0, np.uint64), empty, empty
    hashes = window_hashes(prefixes(byte_values(seed)[data], seed), gram, seed)
    # Half a hash, then the place, so that the least value is the leftmost of equals.
    least = sliding_min((hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=np.uint64), width)
    begin = window_starts(starts, length, n)
    least = least[begin]
    new = np.empty(len(begin), bool)
    new[:1] = True
    new[1:] = (np.diff(begin) != 1) | (least[1:] != least[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(begin)) - 1
    where = (least[first] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    return where, hashes[where], begin[first], begin[last]
