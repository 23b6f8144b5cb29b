"""Prediction by partial matching: a pruned trie of byte contexts, with escapes and symbol exclusion.

A node of the trie is a string of at most ``order + 1`` bytes, packed into an integer: its last byte is the
symbol, the rest its context. A symbol is coded in the longest known context. If it was not seen there, an
escape is coded (with the weight of the number of different symbols seen) and the next
shorter context is asked; symbols of the longer context are excluded from its counts, since the
escape ruled them out. Below the empty context all bytes not excluded are equally likely.

Symbols of a context are also symbols of every shorter one, so what is excluded depends on the context alone, and
a code length depends only on the last ``order + 1`` bytes. It is worked out once for each
different string of a block of texts.
"""

from __future__ import annotations

import numpy as np

#: Ends a text; valid UTF-8 never holds this byte. Before a text stand zero bytes.
END = 0xFF
SYMBOLS = 256


def packed(data: np.ndarray, starts: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of all texts, ends included, each with its context; and where each text begins (one more at the end)."""
    rows = len(starts) - 1
    lengths = np.diff(starts)
    begin = starts[:-1] + np.arange(rows) * (order + 1)
    padded = np.zeros(len(data) + rows * (order + 1), np.uint8)
    at = np.repeat(begin + order - starts[:-1], lengths) + np.arange(len(data))
    padded[at] = data
    ends = begin + order + lengths
    padded[ends] = END
    out = np.zeros(len(padded), np.uint64)
    for k in range(order + 1):
        out[order:] |= padded[order - k : len(padded) - k].astype(np.uint64) << np.uint64(8 * k)
    keep = np.ones(len(padded), bool)
    for k in range(order):
        keep[begin + k] = False
    return out[keep], starts + np.arange(rows + 1)


class Model:
    """Code lengths from the counts of trie nodes.

    ``nodes[k]`` holds the sorted nodes of ``k + 1`` bytes and ``counts[k]`` how often each occurs. Every
    suffix of a node must be a node too. If nodes were left out, ``whole[k]`` holds the total count and the number
    of symbols of each sorted context, from all nodes: what was left out is then escape mass.
    """

    def __init__(self, nodes: list[np.ndarray], counts: list[np.ndarray], whole: list[tuple[np.ndarray, np.ndarray]] | None = None):
        self.order = len(nodes) - 1
        self.nodes = nodes
        self.logs = [np.log10(c).astype(np.float32) for c in counts]
        self.contexts, self.first, self.first_escape, self.below, self.next_escape = [], [], [], [], []
        totals, kinds, left_out = [], [], []
        for k in range(self.order + 1):
            context, start = np.unique(nodes[k] >> np.uint64(8), return_index=True)
            total = np.add.reduceat(counts[k], start).astype(float) if len(start) else np.zeros(0)
            kind = own_kinds = np.diff(np.append(start, len(nodes[k]))).astype(float)
            own_total = total
            if whole:
                total, kind = (x.astype(float) for x in whole[k])
            missing = total - own_total
            self.contexts.append(context)
            left_out.append(missing)
            totals.append(total)
            kinds.append(kind)
            own = np.log10(total + kind)
            self.first.append(own.astype(np.float32))
            self.first_escape.append((np.log10(kind + missing) - own).astype(np.float32))
            if k == 0:
                left = np.maximum(SYMBOLS - own_kinds, 1)
                self.below.append(np.log10(left).astype(np.float32))
                self.next_escape.append(np.zeros(len(left), np.float32))
                continue
            # In the next shorter context, without the symbols of this one.
            shorter = nodes[k] & np.uint64((1 << (8 * k)) - 1)
            excluded = np.add.reduceat(counts[k - 1][np.searchsorted(nodes[k - 1], shorter)], start) if len(start) else np.zeros(0)
            at = np.searchsorted(self.contexts[k - 1], context & np.uint64((1 << (8 * (k - 1))) - 1))
            rest, others = totals[k - 1][at] - excluded, kinds[k - 1][at] - own_kinds
            escape = others + left_out[k - 1][at]
            below = np.log10(np.maximum(rest + others, 1))
            self.below.append(below.astype(np.float32))
            # With nothing left the escape is certain.
            self.next_escape.append(np.where(escape > 0, np.log10(np.maximum(escape, 1)) - below, 0).astype(np.float32))

    @staticmethod
    def _find(sorted_values: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(sorted_values):
            return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
        at = np.minimum(np.searchsorted(sorted_values, wanted), len(sorted_values) - 1)
        return at, sorted_values[at] == wanted

    def log10(self, strings: np.ndarray) -> np.ndarray:
        """log10 of the probability of the last byte of each (sorted) string after the bytes before it."""
        out = np.zeros(len(strings))
        todo = np.arange(len(strings))
        before = np.full(len(strings), -1)  # the context one longer, once one was known
        for k in range(self.order, -1, -1):
            mine = strings[todo] & np.uint64((1 << (8 * (k + 1))) - 1)
            longer = before[todo]
            at, known = self._find(self.contexts[k], mine >> np.uint64(8))
            node, seen = self._find(self.nodes[k], mine)
            top = longer < 0
            hit = known & seen
            denominator = np.where(top, self.first[k][at], 0.0) if len(self.first[k]) else np.zeros(len(todo))
            escape = np.where(top & known, self.first_escape[k][at], 0.0) if len(self.first[k]) else np.zeros(len(todo))
            if k < self.order and len(self.below[k + 1]):
                lower = np.maximum(longer, 0)
                denominator = np.where(top, denominator, self.below[k + 1][lower])
                escape = np.where(top, escape, self.next_escape[k + 1][lower])
            value = self.logs[k][node] - denominator if len(self.logs[k]) else -denominator
            out[todo] += np.where(hit, value, escape)
            before[todo] = np.where(known, at, -1)
            todo = todo[~hit]
        if len(todo):
            known = before[todo] >= 0
            out[todo] -= np.where(known, self.below[0][np.maximum(before[todo], 0)], np.log10(SYMBOLS)) if len(self.below[0]) else np.log10(SYMBOLS)
        return out

    def score(self, data: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """log10 of the probability of every text, its end included."""
        strings, begin = packed(data, starts, self.order)
        different, number = np.unique(strings, return_inverse=True)
        sums = np.concatenate([[0.0], np.cumsum(self.log10(different)[number])])
        return sums[begin[1:]] - sums[begin[:-1]]
