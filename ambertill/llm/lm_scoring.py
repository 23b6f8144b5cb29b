"""Scoring of documents by a byte model (prediction by partial matching) and by a word baseline.

Both learn from all training texts. Strings of ``ORDER + 1`` bytes are counted in every task and
summed; the counts of all shorter nodes follow from them by sums. The trie is whole and lies in hash ranges of
the last two bytes of a context, which hold all longer contexts that end alike; only its nodes of one and two
bytes (65,792 at most) go to every range. A range works out the code length of each of its strings, once.
Blocks of documents ask for the code lengths of their strings and for the counts of their words; the most
frequent strings, ``HOT`` at most, are sent along so that no block need ask for them.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ambertill.llm import ppm, scan
from ambertill.llm.blocks import ANSWERS, Block, Distinct, in_blocks, per_block, ranges, with_answers
from ambertill.session import stage

ORDER = 5
#: Strings whose code lengths every task has (12 bytes each); it asks for all others, so results don't depend on it.
HOT = 500_000
#: A text is held out if crc32 of its id as text leaves ``HELD_OUT`` when divided by ``FOLDS``.
FOLDS, HELD_OUT = 5, 1
#: Strings that a task sums up before it passes them on.
HELD = 2_000_000
#: Documents in a block.
ROWS = 512
SMOOTHING = 0.5
_WORD, _SECOND = 52, 54
#: The hash of the token that ends a text; no word has it but by chance.
_END = np.uint64(0x9E3779B97F4A7C15)
_ASKED = np.dtype([("word", "<u8"), ("n", "<u4")])
_ASKS = "part int, block int, items binary"
RESULT = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, log_counts double, score double"


def held_out(ids: list[int | None]) -> np.ndarray:
    return np.array([zlib.crc32(str(i if i is not None else "").encode()) % FOLDS == HELD_OUT for i in ids], bool)


def _is_training():
    key = F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("")).cast("binary")
    return F.crc32(key) % FOLDS != HELD_OUT


def _summed(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(values, kind="stable")
    values, counts = values[order], counts[order]
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    first = np.flatnonzero(new)
    return values[first], np.add.reduceat(counts, first) if len(first) else counts


def count_strings(texts: DataFrame, order: int = ORDER, learnt: Column | None = None) -> DataFrame:
    """``string`` (packed) and ``n`` of all strings of ``order + 1`` bytes, ends of texts included.

    Texts that are not ``learnt`` add their strings, but nothing to the counts.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, counts = [], []
        size = 0

        def out():
            v, n = _summed(np.concatenate(values), np.concatenate(counts))
            for a in range(0, len(v), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(v[a : a + 100_000].view(np.int64)), pa.array(n[a : a + 100_000])], ["string", "n"])

        for batch in batches:
            for piece in scan.sliced(batch, "text"):
                strings, begin = ppm.packed(*scan.flat(piece.column("text")), order)
                learnt = np.repeat(piece.column("learnt").to_numpy(zero_copy_only=False), np.diff(begin))
                for part, weight in ((strings[learnt], 1), (strings[~learnt], 0)):
                    v, n = np.unique(part, return_counts=True)
                    values.append(v)
                    counts.append(n.astype(np.int64) * weight)
                    size += len(v)
                if size > HELD:
                    v, n = _summed(np.concatenate(values), np.concatenate(counts))
                    values, counts, size = [v], [n], len(v)
                    if size > HELD // 2:
                        yield from out()
                        values, counts, size = [], [], 0
        if values:
            yield from out()

    chosen = texts.select(F.col("text").cast("string").alias("text"), (F.lit(True) if learnt is None else learnt).alias("learnt"))
    return chosen.mapInArrow(work, "string bigint, n bigint").groupBy("string").agg(F.sum("n").alias("n"))


def _step(n: Column) -> Column:
    """Small counts one by one, larger ones by the eighth part of a power of two: few different steps."""
    return F.when(n < 16, n).otherwise(F.floor(F.log2(n) * 8) - 16).cast("int")


def _least(rows: DataFrame, most: int) -> int:
    """The least step of ``n`` above which at most ``most`` rows lie."""
    least, seen = 1, 0
    for level, n in sorted(map(tuple, rows.where("n > 0").groupBy(_step(F.col("n")).alias("step")).agg(F.count("*")).collect()), reverse=True):
        if seen + n > most:
            least = level + 1
            break
        seen += n
    return least


def _part(values: np.ndarray, parts: int) -> np.ndarray:
    mixed = (values + np.uint64(1)) * _END
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    return (((mixed >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int32)


def code_lengths(strings: DataFrame, order: int = ORDER) -> DataFrame:
    """``part`` (hash range), ``string``, ``n`` and ``log10``: of its last byte's probability, by the whole trie.

    All strings whose contexts end with the same two bytes are taken together, so a range has every node of two context bytes
    and more; the shorter ones are broadcast.
    """
    spark = strings.sparkSession
    parts = ranges(spark)
    pairs = strings.groupBy(F.col("string").bitwiseAND(F.lit(0xFFFF)).alias("string")).agg(F.sum("n").alias("n")).where("n > 0").toArrow()
    short = _levels(pairs.column("string").to_numpy().astype(np.uint64), pairs.column("n").to_numpy(), min(order, 1), 0)
    sent = spark.sparkContext.broadcast(short)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = (batch.column("string").to_numpy().view(np.uint64) >> np.uint64(8)) & np.uint64(0xFFFF)
            yield pa.RecordBatch.from_arrays([pa.array(_part(ends, parts)), batch.column("string"), batch.column("n")], ["range", "string", "n"])

    def work(table: pa.Table) -> pa.Table:
        table = table.sort_by("string")
        values, n = table.column("string").to_numpy().view(np.uint64), table.column("n").to_numpy()
        model = ppm.Model(*(a + b for a, b in zip(sent.value, _levels(values[n > 0], n[n > 0], order, 2))))
        return pa.table(
            {"part": pa.array(_part(values, parts)), "string": table.column("string"), "n": table.column("n"), "log10": pa.array(model.log10(values).astype(np.float32))}
        )

    found = strings.mapInArrow(dealt, "range int, string bigint, n bigint").groupBy("range").applyInArrow(work, "part int, string bigint, n bigint, log10 float")
    return stage(found, "codes")


def _levels(strings: np.ndarray, n: np.ndarray, order: int, first: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Sorted nodes and counts of the levels from ``first`` to ``order``."""
    found = [_summed(strings & np.uint64((1 << (8 * (k + 1))) - 1), n) for k in range(first, order + 1)]
    return [v for v, _ in found], [c for _, c in found]


def train(texts: DataFrame, order: int, nodes: int) -> ppm.Model:
    """A byte model of all texts (null counts as empty) for one process: nodes under the least threshold that keeps at most ``nodes``.

    ``score`` doesn't use it.
    """
    longest = stage(count_strings(texts, order), "strings")
    levels = longest.select(F.lit(order).alias("k"), "string", "n")
    for k in range(order):
        node = F.col("string").bitwiseAND(F.lit((1 << (8 * (k + 1))) - 1))
        levels = levels.union(longest.groupBy(node.alias("string")).agg(F.sum("n").alias("n")).select(F.lit(k).alias("k"), "string", "n"))
    levels = stage(levels, "nodes")
    least = _least(levels, nodes)
    context = F.shiftright("string", 8).alias("context")
    # Totals and numbers of symbols of a context are taken from all nodes, also from those that are left out.
    sums = levels.groupBy("k", context).agg(F.sum("n").alias("total"), F.count("*").alias("kinds"), F.max(_step(F.col("n"))).alias("step"))
    sums = sums.where(F.col("step") >= least).sort("k", "context").toArrow()
    kept = levels.where(_step(F.col("n")) >= least).select("k", "string", "n").toArrow()
    k, strings, n = (kept.column(c).to_numpy() for c in ("k", "string", "n"))
    level, total, kinds = (sums.column(c).to_numpy() for c in ("k", "total", "kinds"))
    found, counts, whole = [], [], []
    for x in range(order + 1):
        v, c = _summed(strings[k == x].view(np.uint64), n[k == x])
        found.append(v)
        counts.append(c)
        whole.append((total[level == x], kinds[level == x]))
    return ppm.Model(found, counts, whole)


class _Tokens:
    """Hashes of the tokens of a block: words with A-Z lower-cased, then one end per text."""

    def __init__(self, block: Block, parts: int):
        lower = np.arange(256, dtype=np.uint8)
        lower[65:91] += 32
        data = lower[block.data]
        begin, end, firsts = scan.word_spans(data, block.starts, scan.not_blank())
        rows = len(firsts) - 1
        self.firsts = firsts + np.arange(rows + 1)
        total = len(begin) + rows
        word = np.ones(total, bool)
        word[self.firsts[1:] - 1] = False
        low, high = np.full(total, _END), np.full(total, _END)
        low[word] = scan.span_hashes(scan.prefixes(scan.byte_values(_WORD)[data], _WORD), begin, end, _WORD)
        high[word] = scan.span_hashes(scan.prefixes(scan.byte_values(_SECOND)[data], _SECOND), begin, end, _SECOND)
        self.distinct = Distinct(high, low, parts)
        self.training = np.repeat(~held_out(block.ids.to_pylist()), np.diff(self.firsts))


class _Strings:
    """The different strings of a block, those to ask for by hash range, and the code lengths of the others."""

    def __init__(self, block: Block, order: int, parts: int, hot: tuple[np.ndarray, np.ndarray], places: bool = False):
        strings, self.begin = ppm.packed(block.data, block.starts, order)
        different, self.number = np.unique(strings, return_inverse=True) if places else (np.unique(strings), None)
        at, known = ppm.Model._find(hot[0], different)
        self.codes = np.zeros(len(different))
        self.codes[known] = hot[1][at[known]]
        cold = np.flatnonzero(~known)
        part = _part(different[cold], parts)
        order_ = np.argsort(part, kind="stable")
        self.cold = cold[order_]
        self.values = different[self.cold]
        self.edges = np.searchsorted(part[order_], np.arange(parts + 1))


def _answers(asked: pa.Table, codes: pa.Table) -> pa.Table:
    """The code lengths that the blocks ask a range for."""
    order = np.argsort(codes.column("string").to_numpy().view(np.uint64))
    strings, values = codes.column("string").to_numpy().view(np.uint64)[order], codes.column("log10").to_numpy()[order]
    out = []
    for raw in asked.column("items").to_pylist():
        wanted = np.frombuffer(raw, np.uint64)
        at, known = ppm.Model._find(strings, wanted)
        if not known.all():
            raise ValueError("a string of a block was not counted")
        out.append(values[at].tobytes())
    return pa.table({"block": asked.column("block").cast(pa.int32()), "part": asked.column("part").cast(pa.int32()), "bits": pa.array(out, pa.binary())})


def score(docs: DataFrame, order: int = ORDER, hot: int = HOT) -> DataFrame:
    """log10 probabilities of every text by the byte model and by the words alone.

    Reads ``doc_id`` and ``text``; other columns are ignored. Learns from the rows that are not held
    out. Returns per row: ``doc_id``, ``held_out``, ``n_tokens`` (words and one end), ``n_known`` (seen in training),
    ``train_tokens``, ``base_score`` and ``score``. A null text is empty and has its end only; rows
    with one id are held out alike; without training rows every byte is equally likely.
    """
    codes = code_lengths(stage(count_strings(docs, order, _is_training()), "strings"), order)
    often = codes.where((F.col("n") > 0) & (_step(F.col("n")) >= _least(codes, hot))).select("string", "log10").sort("string").toArrow()
    sent = docs.sparkSession.sparkContext.broadcast((often.column("string").to_numpy().view(np.uint64), often.column("log10").to_numpy()))
    parts = ranges(docs.sparkSession)
    blocks = in_blocks(docs, ROWS)

    def ask_codes(block: Block) -> pa.Table:
        strings = _Strings(block, order, parts, sent.value)
        used = np.flatnonzero(np.diff(strings.edges))
        return pa.table(
            {
                "part": pa.array(used, pa.int32()),
                "block": pa.array(np.full(len(used), block.number), pa.int32()),
                "items": pa.array([strings.values[strings.edges[p] : strings.edges[p + 1]].tobytes() for p in used], pa.binary()),
            }
        )

    def ask(block: Block) -> pa.Table:
        tokens = _Tokens(block, parts)
        found = tokens.distinct
        asked = np.zeros(len(found.values), _ASKED)
        asked["word"] = found.values
        asked["n"] = np.add.reduceat(tokens.training[found.order].astype(np.uint32), found.first) if len(found.first) else 0
        used = np.flatnonzero(np.diff(found.edges))
        return pa.table(
            {
                "part": pa.array(used, pa.int32()),
                "block": pa.array(np.full(len(used), block.number), pa.int32()),
                "items": pa.array([asked[found.edges[p] : found.edges[p + 1]].tobytes() for p in used], pa.binary()),
            }
        )

    def tell(table: pa.Table) -> pa.Table:
        raw = table.column("items").to_pylist()
        asked = np.frombuffer(b"".join(raw), _ASKED)
        words, number = np.unique(asked["word"], return_inverse=True)
        counts = np.bincount(number, asked["n"], len(words)).astype(np.uint64)
        ends = np.cumsum([len(x) // _ASKED.itemsize for x in raw])
        told = counts[number]
        rows = [told[a:b].tobytes() for a, b in zip([0, *ends[:-1]], ends)]
        blocks, parts = table.column("block").to_pylist(), table.column("part").to_pylist()
        # One row more for each range: its different known words and all their places.
        return pa.table(
            {
                "block": pa.array([*blocks, -1], pa.int32()),
                "part": pa.array([*parts, parts[0]], pa.int32()),
                "bits": pa.array([*rows, np.array([(counts > 0).sum(), counts.sum()], np.uint64).tobytes()], pa.binary()),
            }
        )

    told = per_block(blocks, ask, _ASKS).groupBy("part").applyInArrow(tell, ANSWERS)
    told_codes = per_block(blocks, ask_codes, _ASKS).groupBy("part").cogroup(codes.select("part", "string", "log10").groupBy("part")).applyInArrow(_answers, ANSWERS)

    def finish(block: Block, bits: pa.Table) -> pa.Table:
        tokens = _Tokens(block, parts)
        strings = _Strings(block, order, parts, sent.value, True)
        found = tokens.distinct
        counts = np.zeros(len(found.values))
        for part, raw in zip(bits.column("part").to_pylist(), bits.column("bits").to_pylist()):
            if part < parts:
                counts[found.edges[part] : found.edges[part + 1]] = np.frombuffer(raw, np.uint64)
            else:
                strings.codes[strings.cold[strings.edges[part - parts] : strings.edges[part - parts + 1]]] = np.frombuffer(raw, np.float32)
        sums = np.concatenate([[0.0], np.cumsum(strings.codes[strings.number])])
        counts = counts[found.number]
        first, last = tokens.firsts[:-1], tokens.firsts[1:]
        known = np.concatenate([[0], np.cumsum(counts > 0)])
        logs = np.log10(counts + SMOOTHING)
        return pa.table(
            {
                "doc_id": block.ids,
                "held_out": pa.array(held_out(block.ids.to_pylist())),
                "n_tokens": pa.array(last - first, pa.int64()),
                "n_known": pa.array(known[last] - known[first], pa.int64()),
                "log_counts": pa.array(np.add.reduceat(logs, first) if len(first) else logs),
                "score": pa.array(sums[strings.begin[1:]] - sums[strings.begin[:-1]]),
            }
        )

    # Ranges of strings are numbered after those of words.
    both = told.where("block >= 0").union(told_codes.select("block", (F.col("part") + parts).alias("part"), "bits"))
    scored = with_answers(blocks, both, finish, RESULT)
    return _with_totals(scored, told.where("block < 0"))


def _with_totals(scored: DataFrame, totals: DataFrame) -> DataFrame:
    """Add the sums over all ranges, one row in all, as a scalar."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = [np.frombuffer(x, np.uint64) for x in batch.column("bits").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([int(p[k]) for p in pairs], pa.int64()) for k in (0, 1)], ["words", "places"])

    sums = totals.mapInArrow(read, "words bigint, places bigint").agg(F.struct(F.sum("words").alias("words"), F.sum("places").alias("places")).alias("sums"))
    all_ = F.col("_all")
    size = F.coalesce(all_["places"], F.lit(0))
    share = F.log10(size + SMOOTHING * (F.coalesce(all_["words"], F.lit(0)) + 1))
    return scored.withColumn("_all", sums.scalar()).select(
        "doc_id", "held_out", "n_tokens", "n_known", size.alias("train_tokens"), (F.col("log_counts") - F.col("n_tokens") * share).alias("base_score"), "score"
    )
