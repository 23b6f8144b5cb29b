"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def repeated_words(docs, window=35):
    """(doc_id, n_words, n_removed, sha) of every (doc_id, text)."""
    words = [(i, (t or "").encode().split()) for i, t in docs]
    seen = Counter(tuple(w[s : s + window]) for _, w in words for s in range(len(w) - window + 1))
    out = []
    for i, w in words:
        gone = [False] * len(w)
        for s in range(len(w) - window + 1):
            if seen[tuple(w[s : s + window])] > 1:
                gone[s : s + window] = [True] * window
        out.append((i, len(w), sum(gone), sha(b" ".join(x for x, g in zip(w, gone) if not g))))
    return sorted(out)


def repeated_bytes(docs, length=400):
    texts = [(i, (t or "").encode()) for i, t in docs]
    seen = Counter(t[s : s + length] for _, t in texts for s in range(len(t) - length + 1))
    out = []
    for i, t in texts:
        gone = bytearray(len(t))
        for s in range(len(t) - length + 1):
            if seen[t[s : s + length]] > 1:
                gone[s : s + length] = b"\1" * length
        spans = sum(1 for k in range(len(t)) if gone[k] and (not k or not gone[k - 1]))
        out.append((i, len(t), sum(gone), spans, sha(bytes(x for x, g in zip(t, gone) if not g))))
    return sorted(out)


def simhash(text, shingle=4):
    import xxhash

    lower = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
    words = lower.split()
    if not words:
        return 0
    parts = [b" ".join(words[k : k + shingle]) for k in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_components(prints, most=4):
    """(doc_id, component) of (doc_id, fingerprint) by comparing all pairs."""
    root = {i: i for i, _ in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, (i, x) in enumerate(prints):
        for j, y in prints[:n]:
            if (x ^ y).bit_count() <= most:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: find(i) for i, _ in prints}


def test_words(text):
    out, word = [], bytearray()
    for b in (text or "").encode() + b" ":
        b = b + 32 if 65 <= b <= 90 else b
        if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128:
            word.append(b)
        elif word:
            out.append(bytes(word))
            word = bytearray()
    return out


test_words.__test__ = False


def contaminated(docs, items, window=10):
    """(doc_id, n_words, n_hit, item ids as strings, sorted and joined)."""
    wanted = [(i, w) for i, t in items if (w := test_words(t))]
    out = []
    for d, t in docs:
        words = test_words(t)
        hit, found = set(), set()
        for i, w in wanted:
            n = min(window, len(w))
            for s in range(len(w) - n + 1):
                for k in range(len(words) - n + 1):
                    if words[k : k + n] == w[s : s + n]:
                        hit.update(range(k, k + n))
                        if i is not None:
                            found.add(str(i))
        out.append((d, len(words), len(hit), ",".join(sorted(found))))
    return sorted(out, key=repr)


def smallest_capacity(sizes, shards):
    """The least capacity that cuts the ordered sizes into at most so many runs."""

    def runs(capacity):
        n, room = 0, 0
        for s in sizes:
            if s > room:
                n, room = n + 1, capacity
            room -= s
        return n

    return next(c for c in range(max(sizes), sum(sizes) + 1) if runs(c) <= shards)


def fold(doc_id, of):
    import zlib

    return zlib.crc32(str("" if doc_id is None else doc_id).encode()) % of


def tokens(text):
    return bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode()).split() + [None]


def base_scores(docs):
    """(doc_id, held out, n_tokens, n_known, train_tokens, base_score)."""
    from math import log10

    seen = Counter(w for i, t in docs if fold(i, 5) != 1 for w in tokens(t))
    n, v = sum(seen.values()), len(seen)
    return [
        (i, fold(i, 5) == 1, len(ws), sum(w in seen for w in ws), n, sum(log10((seen[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws))
        for i, t in docs
        for ws in [tokens(t)]
    ]


def ppm_score(train, text, order):
    """log10 probability by escapes of weight "different symbols" and exclusion, one symbol after the other."""
    from math import log10

    counts = defaultdict(Counter)
    for t in train:
        line = b"\0" * order + t + b"\xff"
        for p in range(order, len(line)):
            for k in range(order + 1):
                counts[line[p - k : p]][line[p]] += 1
    total = 0.0
    line = b"\0" * order + text + b"\xff"
    for p in range(order, len(line)):
        excluded = set()
        for k in range(order, -1, -1):
            here = {s: n for s, n in counts.get(line[p - k : p], {}).items() if s not in excluded}
            whole = counts.get(line[p - k : p], {})
            mass, kinds = sum(here.values()), len(here)
            if line[p] in here:
                total += log10(here[line[p]] / (mass + kinds))
                break
            if kinds:
                total += log10(kinds / (mass + kinds))
            excluded |= set(whole)
        else:
            total -= log10(256 - len(excluded))
    return total


def sketch(text, shingle=5, one_in=8):
    import struct
    import xxhash

    words = (text or "").encode().split()

    def chain(hashes):
        h = 42
        for w in hashes:
            h = xxhash.xxh64_intdigest(struct.pack("<Q", w), h)
        return h

    hashes = [xxhash.xxh64_intdigest(w, 42) for w in words]
    if 0 < len(words) < shingle:
        found = [chain(hashes)]
    else:
        found = [chain(hashes[k : k + shingle]) for k in range(len(hashes) - shingle + 1)]
    signed = sorted({h - (1 << 64) if h >> 63 else h for h in found})
    return [h for h in signed if h < -(1 << 63) + (1 << 64) // one_in]
