"""SimHash near-dedup over the anchor points of a covering code.

The 64 bits are cut into ``SEGMENTS`` pieces. Fingerprints at most ``d`` bits apart differ in
at most ``d // SEGMENTS`` bits of one piece. In each piece the anchors are the words of a
covering code of radius 1: a perfect Hamming code on the first 15 bits, all words on the rest.
A fingerprint lives at its nearest anchor and visits all anchors within 1 plus the bits that may
differ in the piece, so two near fingerprints meet at the home of either one. Only
distinct fingerprints are compared, and an anchor reports a spanning forest, not pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from ambertill.llm import scan
from ambertill.llm.components import components
from ambertill.llm.rows import content, packed, unpacked
from ambertill.session import stage

SHINGLE = 4
MOST_BITS = 4
SEED = 42
SEGMENTS = 3
#: Homes of one anchor that are compared in one task; more are split, and visitors go to each part.
PART_HOMES = 2048
#: Cells of the distance table that is held at once.
CELLS = 4_000_000
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_HAMMING = 15


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    words = (text or b"").translate(_LOWER).split()
    if not words:
        return 0
    line = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    if n == 1:
        return xxhash.xxh64_intdigest(line, SEED)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[:n].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(line[a:b], SEED) for a, b in zip(starts, ends[shingle - 1 :].tolist())), np.uint64, n)
    counts = np.zeros(64, np.int64)
    for k in range(0, n, 1 << 16):
        counts += np.unpackbits(hashes[k : k + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(counts * 2 > n, bitorder="little")
    return int(bits.view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id``, ``content`` (a hash of the text) and ``fingerprint`` (64 bits in a signed long) of every row."""

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for piece in scan.sliced(batch, "text"):
                data, starts = scan.flat(piece.column("text"))
                raw = data.tobytes()
                prints = np.fromiter((fingerprint(raw[a:b], shingle) for a, b in zip(starts[:-1].tolist(), starts[1:].tolist())), np.uint64, len(starts) - 1)
                columns = [piece.column("doc_id"), piece.column("content"), pa.array(prints.view(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "content", "fingerprint"])

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), content().alias("content"), F.col("text").cast("string").alias("text"))
    return chosen.mapInArrow(work, "doc_id bigint, content bigint, fingerprint bigint")


def _segments(segments: int) -> list[tuple[int, int]]:
    """First bit and width of every piece."""
    edges = [64 * k // segments for k in range(segments + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _syndromes(low: np.ndarray) -> np.ndarray:
    """Which of the 15 bits must be flipped to reach the code word (0: none)."""
    out = np.zeros(len(low), np.uint64)
    for bit in range(_HAMMING):
        out ^= ((low >> np.uint64(bit)) & np.uint64(1)) * np.uint64(bit + 1)
    return out


def home(piece: np.ndarray) -> np.ndarray:
    """The anchor within one bit of each piece."""
    wrong = _syndromes(piece & np.uint64((1 << _HAMMING) - 1))
    return np.where(wrong > 0, piece ^ (np.uint64(1) << (np.maximum(wrong, 1) - np.uint64(1))), piece)


def visits(piece: np.ndarray, width: int, differing: int) -> tuple[np.ndarray, np.ndarray]:
    """All anchors within ``1 + differing`` bits: row numbers and anchors."""
    rows, found = [], []
    reach = 1 + differing
    for flips in range(reach + 1):
        for bits in combinations(range(width), flips):
            # What is flipped must lead to a code word.
            other = piece ^ np.uint64(sum(1 << b for b in bits))
            at = np.flatnonzero(_syndromes(other & np.uint64((1 << _HAMMING) - 1)) == 0)
            rows.append(at)
            found.append(other[at])
    return np.concatenate(rows), np.concatenate(found)


def _placed(prints: DataFrame, most: int, segments: int) -> DataFrame:
    """Every distinct fingerprint at its home (``home``) and as a visitor of each anchor in reach."""

    def work(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for a in range(0, batch.num_rows, 20_000):
                prints = batch.column("fingerprint").slice(a, 20_000).to_numpy().view(np.uint64)
                for number, (first, width) in enumerate(_segments(segments)):
                    piece = (prints >> np.uint64(first)) & np.uint64((1 << width) - 1)
                    own = home(piece)
                    rows, found = visits(piece, width, most // segments)
                    away = found != own[rows]
                    anchor = np.concatenate([own, found[away]]).astype(np.int64) * segments + number
                    values = np.concatenate([prints, prints[rows[away]]]).view(np.int64)
                    lives = np.zeros(len(anchor), bool)
                    lives[: len(own)] = True
                    yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(values), pa.array(lives)], ["anchor", "fingerprint", "home"])

    return prints.mapInArrow(work, "anchor bigint, fingerprint bigint, home boolean")


def _split(placed: DataFrame) -> DataFrame:
    """Cut anchors with more than ``PART_HOMES`` homes; their visitors, and homes as visitors, go to each part."""
    crowded = (
        placed.where("home").groupBy("anchor").agg(F.count("*").alias("homes")).where(F.col("homes") > PART_HOMES)
        .select("anchor", F.ceil(F.col("homes") / F.lit(PART_HOMES)).cast("int").alias("cuts"))
    )
    crowded = stage(crowded, "crowded-anchors")
    own = F.pmod(F.xxhash64("fingerprint"), F.col("cuts")).cast("int")
    with_cuts = placed.join(crowded, "anchor", "left").withColumn("cuts", F.coalesce("cuts", F.lit(1)))
    return with_cuts.select("anchor", "fingerprint", "home", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)).alias("cut")).select(
        "anchor", "cut", "fingerprint", (F.col("home") & (F.col("own") == F.col("cut"))).alias("home")
    )


def _forest(prints: np.ndarray, lives: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join all fingerprints of an anchor that are near one of its homes."""
    homes = np.flatnonzero(lives)
    root = np.arange(len(prints))
    height = max(1, CELLS // max(1, len(prints)))
    for a in range(0, len(homes), height):
        rows = homes[a : a + height]
        near = np.bitwise_count(prints[rows, None] ^ prints[None, :]) <= most
        i, j = np.nonzero(near)
        i = rows[i]
        while True:
            low = np.minimum(root[i], root[j])
            old = root.copy()
            np.minimum.at(root, root[i], low)
            np.minimum.at(root, root[j], low)
            root = root[root]
            if np.array_equal(old, root):
                break
    moved = np.flatnonzero(root != np.arange(len(root)))
    return prints[moved], prints[root[moved]]


def _links(placed: DataFrame, most: int) -> DataFrame:
    """Links within every anchor; many anchors share a task's table."""
    n = int(placed.sparkSession.conf.get("spark.sql.shuffle.partitions")) * 4

    def work(table: pa.Table) -> pa.Table:
        anchor, cut = table.column("anchor").to_numpy(), table.column("cut").to_numpy()
        prints = table.column("fingerprint").to_numpy().view(np.uint64)
        lives = table.column("home").to_numpy(zero_copy_only=False)
        order = np.lexsort((cut, anchor))
        anchor, cut, prints, lives = anchor[order], cut[order], prints[order], lives[order]
        new = np.ones(len(anchor), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (cut[1:] != cut[:-1])
        starts = np.flatnonzero(new)
        homes = np.add.reduceat(lives, starts, dtype=np.int64) if len(starts) else starts
        ends = np.append(starts[1:], len(anchor))
        a, b = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
        # Anchors with one home, by far the most, are compared all at once.
        single = homes == 1
        group = np.cumsum(new) - 1
        of = np.zeros(len(starts), np.uint64)
        of[group[lives]] = prints[lives]
        near = single[group] & ~lives & (np.bitwise_count(prints ^ of[group]) <= most)
        a.append(prints[near])
        b.append(of[group[near]])
        for k in np.flatnonzero((homes > 1) & (ends - starts > 1)):
            x, y = _forest(prints[starts[k] : ends[k]], lives[starts[k] : ends[k]], most)
            a.append(x)
            b.append(y)
        a, b = np.concatenate(a).view(np.int64), np.concatenate(b).view(np.int64)
        pairs = np.unique(np.stack([a, b], 1), axis=0) if len(a) else np.zeros((0, 2), np.int64)
        return pa.table({"a": pa.array(pairs[:, 0]), "b": pa.array(pairs[:, 1])})

    slot = F.pmod(F.xxhash64("anchor", "cut"), F.lit(n)).cast("int")
    return placed.withColumn("slot", slot).groupBy("slot").applyInArrow(work, "a bigint, b bigint")


def _grouped(docs: DataFrame, shingle: int, most: int, segments: int) -> DataFrame:
    """``fingerprints`` with ``root``, the least fingerprint of the component, and ``component_id``."""
    if not 0 <= most // segments <= 3:
        raise ValueError("choose segments so that each may differ in 3 bits at most")
    prints = stage(fingerprints(docs, shingle), "fingerprints")
    distinct = stage(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    links = _links(_split(_placed(distinct.select("fingerprint"), most, segments)), most)
    roots = components(links).withColumnRenamed("node", "fingerprint")
    known = distinct.join(roots, "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    known = stage(known, "rooted-fingerprints")
    least = stage(known.groupBy("root").agg(F.min("least").alias("component_id")), "least-documents")
    named = stage(known.join(least, "root").select("fingerprint", "root", "component_id"), "named-fingerprints")
    return prints.join(named, "fingerprint")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, most: int = MOST_BITS, segments: int = SEGMENTS) -> DataFrame:
    """Fingerprint and component of every row: ``doc_id``, ``fingerprint`` (signed long), ``component_id``.

    Reads ``doc_id`` and ``text``; other columns are ignored. Fingerprints of at most ``most``
    differing bits are linked, and ``component_id`` is the least ``doc_id`` reachable. Texts
    without words (null, empty) have fingerprint zero and are linked like any other; shorter
    texts are one shingle; equal texts always share a component; a null ``doc_id`` is never
    the least; an empty table gives an empty result.
    """
    return _grouped(docs, shingle, most, segments).select("doc_id", "fingerprint", "component_id")


def one_of_each(docs: DataFrame, shingle: int = SHINGLE, most: int = MOST_BITS, segments: int = SEGMENTS) -> DataFrame:
    """One document of every component, with all its columns: the one of the least id (null last).

    Rows with that id and different texts in one component: the one of the least text hash stays; rows equal in id and
    text: any one of them.
    """
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "content")
    chosen = _grouped(docs, shingle, most, segments).groupBy("root").agg(F.min(order).alias("first"))
    chosen = stage(chosen.select(F.col("first.doc_id").alias("_doc"), F.col("first.content").alias("_content")).distinct(), "chosen-documents")
    keyed = packed(docs, _doc=F.col("doc_id").cast("long"), _content=content())
    here = keyed.alias("k").join(
        chosen.alias("c"), F.col("k._doc").eqNullSafe(F.col("c._doc")) & (F.col("k._content") == F.col("c._content")), "left_semi"
    )
    place = Window.partitionBy("_doc", "_content").orderBy("_doc")
    return unpacked(here.withColumn("_place", F.row_number().over(place)).where("_place = 1"))
