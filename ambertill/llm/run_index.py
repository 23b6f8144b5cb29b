"""A run-compressed Burrows-Wheeler transform of a set of byte strings, and its matching statistics."""

from __future__ import annotations

import numpy as np

from ambertill.llm import scan

#: Ends every row; valid UTF-8 never holds this byte.
END = 0xFF
_SEED = 31


class RunIndex:
    """Runs of the transform with the text position sampled at both ends of every run.

    ``data`` holds the rows one after another, ``starts`` says where each begins (one more at
    the end). Suffixes are sorted as far as rows are long, by prefix doubling of the groups that
    are not yet told apart.
    """

    def __init__(self, data: np.ndarray, starts: np.ndarray):
        rows = len(starts) - 1
        lengths = np.diff(starts)
        self.starts = starts[:-1] + np.arange(rows)
        self.ends = self.starts + lengths
        self.text = np.full(len(data) + rows, END, np.uint8)
        inside = np.ones(len(self.text), bool)
        inside[self.ends] = False
        self.text[inside] = data
        order = _sorted_suffixes(self.text, int(lengths.max(initial=0)) + 1)
        before = np.empty(len(order), np.int16)
        before[:] = self.text[order - 1]
        # No row goes on from another: what stands before a row is unlike anything else.
        first = np.zeros(len(self.text), bool)
        first[self.starts] = True
        fresh = first[order]
        cut = np.ones(len(order), bool)
        cut[1:] = (before[1:] != before[:-1]) | fresh[1:] | fresh[:-1]
        heads = np.flatnonzero(cut)
        self.symbols = before[heads]
        self.head_at = order[heads]
        self.tail_at = order[np.append(heads[1:], len(order)) - 1]

    def matching_statistics(self, least: int) -> np.ndarray:
        """For every position of the text, how far it agrees with another place.

        Inside a run the agreement is one less than at the position before it, so only the
        borders of runs are compared; the text is then streamed once, carrying on the
        furthest agreement. Only agreements of ``least`` bytes are followed.
        """
        n = len(self.text)
        reach = np.zeros(n, np.int64)
        if n >= least and len(self.head_at) > 1:
            prefix = scan.prefixes(scan.byte_values(_SEED)[self.text], _SEED)
            other, here = self.tail_at[:-1], self.head_at[1:]
            room = n - np.maximum(other, here)
            fits = room >= least
            other, here, room = other[fits], here[fits], room[fits]
            inverse = scan.powers(_SEED, n + 1, True)

            def equal(a, b, size):
                return (prefix[a + size] - prefix[a]) * inverse[a] == (prefix[b + size] - prefix[b]) * inverse[b]

            long = equal(other, here, least)
            other, here, room = other[long], here[long], room[long]
            low, high = np.full(len(here), least), room
            while np.any(low < high):
                middle = (low + high + 1) >> 1
                same = equal(other, here, middle)
                low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
            np.maximum.at(reach, here, here + low)
            np.maximum.at(reach, other, other + low)
        return np.maximum(np.maximum.accumulate(reach) - np.arange(n), 0)

    def repeated(self, length: int) -> np.ndarray:
        """For every byte of the rows: does the string of ``length`` bytes from there, inside its row, start elsewhere too?"""
        long = self.matching_statistics(length) >= length
        out = np.zeros(len(self.text) - len(self.starts), bool)
        shift = np.arange(len(self.starts))
        for start, end, k in zip(self.starts, self.ends, shift):
            last = end - length + 1
            if last > start:
                out[start - k : last - k] = long[start:last]
        return out


def _sorted_suffixes(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in the order of their first ``depth`` bytes."""
    n = len(text)
    padded = np.zeros(n + 8, np.uint8)
    padded[:n] = text
    key = np.ndarray(n, ">u8", padded, strides=(1,)).astype(np.uint64)
    order = np.argsort(key)
    key = key[order]
    new = np.ones(n, bool)
    new[1:] = key[1:] != key[:-1]
    rank = np.zeros(n + 1, np.int64)
    rank[order] = np.flatnonzero(new)[np.cumsum(new) - 1] + 1
    open_ = _shared(new)
    h = 8
    while h < depth and len(open_):
        suffix = order[open_]
        key = (rank[suffix] << 32) | rank[np.minimum(suffix + h, n)]
        turn = np.argsort(key)
        suffix, key = suffix[turn], key[turn]
        order[open_] = suffix
        new = np.ones(len(key), bool)
        new[1:] = key[1:] != key[:-1]
        rank[suffix] = open_[np.flatnonzero(new)[np.cumsum(new) - 1]] + 1
        open_ = open_[_shared(new)]
        h *= 2
    return order


def _shared(new: np.ndarray) -> np.ndarray:
    """Places whose group (begun where ``new``) has more than one member."""
    alone = new.copy()
    alone[:-1] &= new[1:]
    return np.flatnonzero(~alone)
