"""Byte-level BPE as a streaming transducer with bounded lookahead, and its incremental decoder.

A text is read left to right. Special tokens are cut out first (their string is always that
token); the rest is split into pieces by the vocabulary's pre-tokenizer pattern, which needs
one character of lookahead. A piece's tokens are final once the piece ends, so they are emitted
then; a piece longer than ``lookahead`` bytes (long runs of one character, long words) is worked
in windows: tokens that end at least ``lookahead`` bytes before the end of the window are final,
the rest of the window is worked again with the next bytes. ``lookahead`` comes from the merge
list: twice the longest token it can build, in bytes. Memory therefore stays bounded by the window
whatever the length of a text; the tests compare whole outputs with the tokenizers library,
long single pieces included.

Tables go through it in lots of about ``LOT`` characters, long stretches cut where a piece is sure
to end: the starts of a lot's pieces are found from the classes of its characters, every different
piece is looked up or merged once, all new pieces of a lot together.

Decoding maps ids back to bytes and feeds them to an incremental UTF-8 decoder (a state machine
that holds at most three pending bytes); bytes that cannot form a character become U+FFFD,
as the library does.

Nulls: a null text is the empty text (no tokens, empty decoding).
"""

from __future__ import annotations

import codecs
import gc
import heapq
import json
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, functions as F

from ambertill.llm.rows import packed

#: Pieces of at most this many bytes are kept in a bounded cache of their tokens.
CACHED = 64
CACHE_SIZE = 1 << 18
#: Bytes of text (one text at least) whose ids and decoding a Python worker holds before it hands them on.
SLICE = 1 << 20
#: Characters of text split and looked up together; a stretch without a sure end of a piece may be longer.
LOT = 1 << 18
#: Bytes of a long piece worked at once, beside the lookahead.
WINDOW = 4096
NEVER = 1 << 62
#: Ids take at most this many bits; a pair of ids is one integer key, and so is a rank with its new id.
SHIFT = 17
LOW = (1 << SHIFT) - 1
#: Classes of characters in the pre-tokenizer's pattern.
OTHER, LETTER, NUMBER, SPACE, UNSEEN = range(5)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_chars() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for 256 and up, in byte order."""
    # The three printable byte ranges of the byte-level alphabet.
    printable = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    chars, extra = {}, 0
    for b in range(256):
        if b in printable:
            chars[b] = chr(b)
        else:
            chars[b] = chr(256 + extra)
            extra += 1
    return chars


class Vocabulary:
    """Ids, merge ranks, special tokens and the pre-tokenizer of one tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as handle:
            spec = json.load(handle)
        model = spec["model"]
        if model.get("type") != "BPE" or (spec.get("pre_tokenizer") or {}).get("type") != "ByteLevel":
            raise ValueError("only byte-level BPE vocabularies are supported")
        if (spec["pre_tokenizer"] or {}).get("add_prefix_space"):
            raise ValueError("a prefix space is not supported")
        chars = _byte_chars()
        to_byte = {c: b for b, c in chars.items()}
        self.ids: dict[bytes, int] = {}
        self.bytes: dict[int, bytes] = {}
        for token, i in model["vocab"].items():
            raw = bytes(to_byte[c] for c in token)
            self.ids[raw] = i
            self.bytes[i] = raw
        self.single = [self.ids[bytes([b])] for b in range(256)]
        #: ``rank << SHIFT | new id`` of a pair of ids, keyed by ``left << SHIFT | right``.
        self.ranks: dict[int, int] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            a, b = bytes(to_byte[c] for c in left), bytes(to_byte[c] for c in right)
            self.ranks[self.ids[a] << SHIFT | self.ids[b]] = rank << SHIFT | self.ids[a + b]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        for content, i in self.special.items():
            self.bytes[i] = content.encode("utf-8")
        self.split_special = regex.compile("|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True))) if self.special else None
        # Fixed value: the byte-level pre-tokenizer's pattern.
        self.pieces = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
        # Between these neighbours a piece ends, whatever surrounds them.
        self.sure_end = regex.compile(r"\p{L}(?!\p{L})|\p{N}(?!\p{N})|\S(?=\s)")
        # The pattern's classes and its contractions.
        self.class_patterns = {LETTER: regex.compile(r"\p{L}"), NUMBER: regex.compile(r"\p{N}"), SPACE: regex.compile(r"\s")}
        self.contractions = [[ord(c) for c in tail] for tail in ("s", "t", "re", "ve", "m", "ll", "d")]
        #: Class of each code point, filled when it is first met.
        self.classes = np.full(0x110000, UNSEEN, np.uint8)
        if max(self.bytes, default=0) >> SHIFT:
            raise ValueError("ids beyond 2**17 are not supported")
        #: The merge list again, for many pairs at once, and the bytes of every id.
        self.pair_keys = np.array(sorted(self.ranks), np.int64)
        self.pair_ranks = np.array([*map(self.ranks.get, self.pair_keys.tolist()), NEVER], np.int64)
        self.pair_keys = np.append(self.pair_keys, NEVER)
        self.single_ids = np.array(self.single, np.int64)
        self.id_bytes = pa.array([self.bytes.get(i) for i in range(max(self.bytes, default=-1) + 1)], pa.binary())
        self.lookahead = 2 * max(len(self.bytes[v & LOW]) for v in self.ranks.values()) if self.ranks else 1
        self.single_ranks = self.ranked(np.repeat(self.single_ids, 256), np.tile(self.single_ids, 256))

    def ranked(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """``ranks`` of many pairs of ids, ``NEVER`` for those not in the merge list."""
        keys = left << SHIFT | right
        at = np.searchsorted(self.pair_keys, keys)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], NEVER)

    def classed(self, points: np.ndarray) -> np.ndarray:
        """The class of every code point."""
        classes = self.classes[points]
        unseen = classes == UNSEEN
        if unseen.any():
            new = np.unique(points[unseen])
            text = new.astype("<u4").tobytes().decode("utf-32-le")
            self.classes[new] = OTHER
            for kind, pattern in self.class_patterns.items():
                self.classes[[ord(c) for c in pattern.findall(text)]] = kind
            classes = self.classes[points]
        return classes

    def piece_starts(self, points: np.ndarray, stretches: np.ndarray) -> np.ndarray:
        """Where the pieces of ``pieces`` start in the code points of several stretches, given where these start."""
        classes = self.classed(points)
        first = np.zeros(len(points), bool)
        first[stretches[stretches < len(points)]] = True
        start = first.copy()
        start[1:] |= classes[1:] != classes[:-1]
        # The last of some white space before another character stands alone, or goes to that character if it is a blank.
        after = np.flatnonzero(start & ~first & (classes != SPACE))
        after = after[classes[after - 1] == SPACE]
        start[after - 1] = True
        start[after[points[after - 1] == ord(" ")]] = False
        # A contraction only counts where a piece starts at its apostrophe.
        quotes = np.flatnonzero(points == ord("'"))
        quotes = quotes[start[quotes]]
        for tail in self.contractions:
            found = quotes[quotes + len(tail) < len(points)]
            for k, point in enumerate(tail, 1):
                found = found[(points[found + k] == point) & ~first[found + k]]
            start[found + 1] = False
            ends = found + len(tail) + 1
            start[ends[ends < len(points)]] = True
        return np.flatnonzero(start)


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


@lru_cache(maxsize=4)
def encoder(path: str) -> "Encoder":
    """One encoder per vocabulary and Python worker, so that its bounded cache serves all batches of the worker."""
    return Encoder(vocabulary(path))


def _merge(vocab: Vocabulary, data: bytes) -> list[int]:
    """Tokens of one piece by rank order (lowest rank first, leftmost first).

    The ranks of neighbouring pairs are kept in a list; a merge changes at most two of them.
    """
    single = vocab.single
    ids = [single[b] for b in data]
    get = vocab.ranks.get
    pairs = [get(a << SHIFT | b, NEVER) for a, b in zip(ids, ids[1:])]
    while pairs:
        best = min(pairs)
        if best == NEVER:
            break
        k = pairs.index(best)
        ids[k] = new = best & LOW
        del ids[k + 1], pairs[k]
        if k < len(pairs):
            pairs[k] = get(new << SHIFT | ids[k + 1], NEVER)
        if k:
            pairs[k - 1] = get(ids[k - 1] << SHIFT | new, NEVER)
    return ids


def _merge_all(vocab: Vocabulary, pieces: list[bytes]) -> list[tuple[bytes, bytes]]:
    """``_merge`` for many short pieces (packed ids, and the bytes they decode to): one merge in each piece at a time.

    Pieces of similar length share a matrix; a row links its living ids and holds the rank of each with the next one.
    """
    sizes = np.array([len(p) for p in pieces], np.int64)
    order = np.argsort(sizes, kind="stable")
    merged: list[tuple[bytes, bytes]] = [(b"", b"")] * len(pieces)
    cuts = np.searchsorted(sizes[order], [0, 5, 7, 9, 12, 16, 24, 40, sizes.max(initial=0) + 1])
    for chosen in (order[a:b] for a, b in zip(cuts, cuts[1:]) if b > a):
        n, width = len(chosen), int(sizes[chosen[-1]])
        size = sizes[chosen]
        data = np.zeros((n, width + 1), np.int64)
        data[np.arange(width + 1) < size[:, None]] = np.frombuffer(b"".join([pieces[k] for k in chosen.tolist()]), np.uint8)
        ids = vocab.single_ids[data]
        pairs = vocab.single_ranks[data[:, :-1] << 8 | data[:, 1:]]
        pairs[np.arange(1, width + 1) >= size[:, None]] = NEVER
        after = np.tile(np.arange(1, width + 2), (n, 1))
        before = np.tile(np.arange(-1, width), (n, 1))
        alive = np.arange(width + 1) < size[:, None]
        rows = np.arange(n)
        while True:
            k = pairs[rows].argmin(axis=1)
            best = pairs[rows, k]
            some = best < NEVER
            rows, k, best = rows[some], k[some], best[some]
            if not len(rows):
                break
            new = best & LOW
            gone = after[rows, k]
            right = after[rows, gone]
            ids[rows, k], after[rows, k], alive[rows, gone] = new, right, False
            pairs[rows, k] = NEVER
            inside = gone < width
            pairs[rows[inside], gone[inside]] = NEVER
            inside = right < size[rows]
            r, a, b = rows[inside], k[inside], right[inside]
            before[r, b] = a
            pairs[r, a] = vocab.ranked(new[inside], ids[r, b])
            left = before[rows, k]
            inside = left >= 0
            r, a = rows[inside], left[inside]
            pairs[r, a] = vocab.ranked(ids[r, a], new[inside])
        flat = ids[alive].astype(np.int32)
        ends = np.cumsum(alive.sum(axis=1))
        packed_ids, back = flat.tobytes(), vocab.id_bytes.take(pa.array(flat))
        decoded, at = _content(back), _offsets(back)[np.concatenate([[0], ends])].tolist()
        ends = [0, *(4 * ends).tolist()]
        for row, k in enumerate(chosen.tolist()):
            merged[k] = packed_ids[ends[row] : ends[row + 1]], decoded[at[row] : at[row + 1]]
    return merged


def _offsets(strings: pa.Array) -> np.ndarray:
    """Where each of the strings starts in ``_content``, and the end."""
    kind = np.int64 if pa.types.is_large_binary(strings.type) else np.int32
    if not len(strings):
        return np.zeros(1, kind)
    at = np.frombuffer(strings.buffers()[1], kind)[strings.offset : strings.offset + len(strings) + 1]
    return at - at[0]


def _content(strings: pa.Array) -> bytes:
    """All the strings, one after the other."""
    if not len(strings) or strings.buffers()[2] is None:
        return b""
    at = _offsets(strings)
    kind = np.int64 if pa.types.is_large_binary(strings.type) else np.int32
    begin = int(np.frombuffer(strings.buffers()[1], kind)[strings.offset])
    return strings.buffers()[2].slice(begin, int(at[-1])).to_pybytes()


def _merge_long(vocab: Vocabulary, data: bytes) -> tuple[list[int], list[int]]:
    """The same tokens as ``_merge`` for long pieces, with their end offsets: a heap of (rank, place) over a linked list."""
    n = len(data)
    ids = [vocab.single[b] for b in data]
    ends = list(range(1, n + 1))
    after = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    alive = [True] * n
    ranks = vocab.ranks
    heap = []
    for k in range(n - 1):
        found = ranks.get(ids[k] << SHIFT | ids[k + 1])
        if found is not None:
            heap.append((found >> SHIFT, k, ids[k], ids[k + 1], found & LOW))
    heapq.heapify(heap)
    while heap:
        _, k, left, right, new = heapq.heappop(heap)
        nxt = after[k] if alive[k] else n
        if nxt >= n or ids[k] != left or ids[nxt] != right:
            continue
        ids[k], ends[k] = new, ends[nxt]
        alive[nxt] = False
        after[k] = after[nxt]
        if after[k] < n:
            before[after[k]] = k
        prev = before[k]
        if prev >= 0:
            found = ranks.get(ids[prev] << SHIFT | new)
            if found is not None:
                heapq.heappush(heap, (found >> SHIFT, prev, ids[prev], new, found & LOW))
        if after[k] < n:
            found = ranks.get(new << SHIFT | ids[after[k]])
            if found is not None:
                heapq.heappush(heap, (found >> SHIFT, k, new, ids[after[k]], found & LOW))
    kept = [k for k in range(n) if alive[k]]
    return [ids[k] for k in kept], [ends[k] for k in kept]


def _bytes(vocab: Vocabulary, ids: list[int]) -> bytes:
    """What the decoder is fed for these ids: their bytes in the byte-level alphabet, mapped back."""
    return b"".join(map(vocab.bytes.__getitem__, ids))


def _packed_ids(ids: list[int]) -> bytes:
    return array("i", ids).tobytes()


class Encoder:
    """The transducer: ``feed`` one text, get its ids as they become final, each group with the bytes they decode to."""

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        #: Tokens of recent pieces (ids as 32-bit numbers in a string of bytes) in two generations: when the young one is full it becomes the old one.
        self.cache: dict[str, tuple[bytes, bytes]] = {}
        self.old: dict[str, tuple[bytes, bytes]] = {}
        #: No other piece equals a special token, as these are cut out first.
        self.specials = {content: (_packed_ids([i]), vocab.bytes[i]) for content, i in vocab.special.items()}

    def _long(self, data: bytes) -> Iterator[tuple[list[int], bytes]]:
        look = self.vocab.lookahead
        start = 0
        while True:
            stop = start + WINDOW + look
            window = data[start:stop]
            ids, ends = _merge_long(self.vocab, window)
            if stop >= len(data):
                yield ids, _bytes(self.vocab, ids)
                return
            final = len(window) - look
            count = 0
            while count < len(ids) and ends[count] <= final:
                count += 1
            count = max(count, 1)  # one token longer than the lookahead: take it, it cannot grow further left
            taken = ends[count - 1]
            yield ids[:count], _bytes(self.vocab, ids[:count])
            start += taken

    def _new(self, piece: str) -> tuple[bytes, bytes] | None:
        """Tokens of a piece not in the cache (None for a long piece, which goes through ``_long``)."""
        got = self.old.get(piece)
        if got is None:
            data = piece.encode("utf-8")
            if len(data) > CACHED:
                return None
            ids = _merge(self.vocab, data)
            # strings of bytes only: the garbage collector stops tracking them
            got = (_packed_ids(ids), _bytes(self.vocab, ids))
        self._keep(piece, got)
        return got

    def _keep(self, piece: str, got: tuple[bytes, bytes]) -> None:
        if len(self.cache) >= CACHE_SIZE:
            self.old, self.cache = self.cache, {}
        self.cache[piece] = got

    def _segments(self, text: str) -> Iterator[tuple[int, int, int | None]]:
        """Stretches between special tokens: (start, end, special id after it or None)."""
        vocab = self.vocab
        at = 0
        if vocab.split_special:
            for m in vocab.split_special.finditer(text):
                yield at, m.start(), vocab.special[m.group()]
                at = m.end()
        yield at, len(text), None

    def feed(self, text: str | None) -> Iterator[tuple[list[int], bytes]]:
        """Ids piece by piece, each with the bytes they decode to."""
        text = text or ""
        for begin, end, special in self._segments(text):
            for piece in self.vocab.pieces.findall(text, begin, end):
                got = self.cache.get(piece) or self._new(piece)
                if got is None:
                    yield from self._long(piece.encode("utf-8"))
                else:
                    yield array("i", got[0]).tolist(), got[1]
            if special is not None:
                yield [special], self.vocab.bytes[special]

    def encode(self, text: str | None) -> tuple[list[int], str]:
        """``coded`` with the ids as a list."""
        ids, decoded = self.coded(text)
        return ids.tolist(), decoded

    def coded(self, text: str | None) -> tuple[np.ndarray, str]:
        """All ids of ``text`` and their decoding."""
        ids, _, decoded = self.coded_texts([text])
        return ids, decoded[0]

    def coded_texts(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """``feed`` and the decoder for several texts: all ids in one array, how many each text has, and the decodings.

        A text's decoder takes the bytes of each stretch as soon as its ids are final.
        """
        counts = np.zeros(len(texts), np.int64)
        decoders = [Decoder() for _ in texts]
        parts: list[list[str]] = [[] for _ in texts]
        ids = []
        for lot in self._lots(texts):
            owners = [k for k, _, _ in lot]
            got, n_ids, data = self._lot([stretch for _, stretch, _ in lot], [special for _, _, special in lot])
            ids.append(got)
            np.add.at(counts, owners, n_ids)
            for k, part in zip(owners, data):
                parts[k].append(decoders[k].feed(part))
        decoded = ["".join([*part, decoder.close()]) for part, decoder in zip(parts, decoders)]
        return np.concatenate(ids) if ids else np.zeros(0, np.int32), counts, decoded

    def _stretches(self, texts: list[str | None]) -> Iterator[tuple[int, str, bool]]:
        """Number of the text, a stretch of it and whether that is a special token."""
        for k, text in enumerate(texts):
            for begin, end, special in self._segments(text or ""):
                while begin < end:
                    cut = end
                    if end - begin > LOT and (sure := self.vocab.sure_end.search(text, begin + LOT - 1, end)):
                        cut = sure.end()
                    yield k, text[begin:cut], False
                    begin = cut
                if special is not None:
                    yield k, self.vocab.bytes[special].decode("utf-8"), True

    def _lots(self, texts: list[str | None]) -> Iterator[list[tuple[int, str, bool]]]:
        """The stretches in lots of less than ``LOT`` characters beside the last stretch."""
        lot, size = [], 0
        for stretch in self._stretches(texts):
            lot.append(stretch)
            size += len(stretch[1])
            if size >= LOT:
                yield lot
                lot, size = [], 0
        if lot:
            yield lot

    def _lot(self, stretches: list[str], special: list[bool]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """All ids of the stretches, how many each has, and the bytes each decodes to."""
        text = "".join(stretches)
        points = np.frombuffer(text.encode("utf-32-le"), "<u4")
        data = text.encode("utf-8")
        at = np.concatenate([[0], np.cumsum([len(s) for s in stretches])])
        starts = self.vocab.piece_starts(points, at)
        if any(special):
            stretch = np.searchsorted(at, starts, side="right") - 1
            starts = starts[~np.array(special)[stretch] | (starts == at[stretch])]
        pieces_before = np.searchsorted(starts, at)
        if len(data) > len(points):
            starts = np.flatnonzero(np.frombuffer(data, np.uint8) & 0xC0 != 0x80)[starts]
        offsets = np.append(starts, len(data)).astype(np.int32)
        pieces = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(data)).dictionary_encode()
        found = self._found(pieces.dictionary.to_pylist())
        ids = pa.array([f[0] for f in found], pa.large_binary()).take(pieces.indices)
        back = pa.array([f[1] for f in found], pa.large_binary()).take(pieces.indices)
        decoded, cuts = _content(back), _offsets(back)[pieces_before].tolist()
        n_ids = np.diff(_offsets(ids)[pieces_before] // 4)
        return np.frombuffer(_content(ids), np.int32), n_ids, [decoded[a:b] for a, b in zip(cuts, cuts[1:])]

    def _found(self, pieces: list[str]) -> list[tuple[bytes, bytes]]:
        """Packed ids of different pieces and the bytes they decode to; all that are not in the cache are merged together."""
        found = list(map(self.cache.get, pieces))
        missing = [k for k, f in enumerate(found) if f is None]
        new, encoded = [], []
        for k in missing:
            piece = pieces[k]
            found[k] = self.specials.get(piece) or self.old.get(piece)
            if found[k] is None:
                data = piece.encode("utf-8")
                if len(data) > CACHED:
                    more = list(self._long(data))
                    found[k] = b"".join(_packed_ids(m[0]) for m in more), b"".join(m[1] for m in more)
                else:
                    new.append(k)
                    encoded.append(data)
            elif piece not in self.specials:
                self._keep(piece, found[k])
        for k, merged in zip(new, _merge_all(self.vocab, encoded)):
            found[k] = merged
            self._keep(pieces[k], merged)
        return found


class Decoder:
    """Incremental decoding: bytes of ids in, text out, at most three bytes waiting for the rest of a character."""

    def __init__(self):
        self.state = codecs.getincrementaldecoder("utf-8")(errors="replace")

    def feed(self, data: bytes) -> str:
        return self.state.decode(data)

    def close(self) -> str:
        return self.state.decode(b"", final=True)


def decode(vocab: Vocabulary, ids: list[int]) -> str:
    """``decode(ids, skip_special_tokens=False)``, one id at a time."""
    decoder = Decoder()
    return "".join(decoder.feed(vocab.bytes[i]) for i in ids) + decoder.close()


def round_trip(vocab: Vocabulary, encoder: Encoder, text: str | None) -> tuple[list[int], str]:
    """Ids of ``text`` and their decoding."""
    return encoder.encode(text)


def streamed(vocab: Vocabulary, encoder: Encoder, text: str | None) -> tuple[list[int], str]:
    """The same through the piece-by-piece interface, feeding the decoder every piece."""
    decoder = Decoder()
    ids, parts = [], []
    for got, data in encoder.feed(text):
        ids.extend(got)
        parts.append(decoder.feed(data))
    parts.append(decoder.close())
    return ids, "".join(parts)


def _slices(texts: pa.Array) -> Iterator[pa.Array]:
    """Neighbouring texts of less than ``SLICE`` bytes beside the last one."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    at = np.cumsum(sizes) // SLICE
    cuts = [0, *(np.flatnonzero(np.diff(at)) + 1).tolist(), len(texts)]
    for begin, end in zip(cuts, cuts[1:]):
        if end > begin:
            yield texts.slice(begin, end - begin)


def _coded_slice(coder: Encoder, texts: pa.Array) -> pa.StructArray:
    # The encoder makes no reference cycles; cyclic collection only rescans its cache.
    paused = gc.isenabled()
    gc.disable()
    try:
        ids, counts, decoded = coder.coded_texts(texts.to_pylist())
    finally:
        if paused:
            gc.enable()
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))
    return pa.StructArray.from_arrays([lists, pa.array(decoded, pa.string())], ["ids", "decoded"])


def coded_slices(coder: Encoder, batches: Iterator[pa.Array]) -> Iterator[pa.StructArray]:
    """``ids`` and ``decoded`` of every text, handed on slice by slice, so that a worker never holds those of a whole batch."""
    for texts in batches:
        for part in _slices(texts):
            yield _coded_slice(coder, part)


def tokenized(docs: DataFrame, text: str = "text", path: str | None = None) -> DataFrame:
    """``_row`` (all columns of ``docs``), ``ids`` (array of token ids) and ``decoded`` (the ids decoded).

    One row per input row, repeated rows and null ids included; other columns never clash with
    the added ones. Only the text column crosses to Python, in Arrow batches.
    """
    path = path or default_vocabulary()

    @F.arrow_udf("ids array<int>, decoded string")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from coded_slices(encoder(path), batches)

    coded = packed(docs, _bpe=encode(F.col(f"`{text}`").cast("string")))
    return coded.select("_row", F.col("_bpe.ids").alias("ids"), F.col("_bpe.decoded").alias("decoded"))


def digests(ids: Column, decoded: Column) -> list[Column]:
    return [
        F.size(ids).cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.transform(ids, lambda i: i.cast("string")), ","), 256).alias("ids_sha256"),
        F.sha2(decoded, 256).alias("decoded_sha256"),
    ]
