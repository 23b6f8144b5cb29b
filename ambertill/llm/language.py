"""Language ID by words first, shorter and shorter character n-grams for unseen words.

The classifier is fit on whole labelled rows of at most ``TRAIN_BYTES`` bytes of text in all, chosen by hash, and the model holds
the counts of all entries of these; it is bounded with them and is sent to every task whole. A known word adds its log frequency
in each language. For an unseen word the longest n-grams of which some are known decide: their
mean log frequency is added, and only if none is known the next shorter ones are asked.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from ambertill.llm import scan
from ambertill.llm.rows import content, without
from ambertill.session import stage

#: Lengths of n-grams; a mark at both ends of a word counts as a character.
LONGEST, SHORTEST = 5, 1
SMOOTHING = 0.5
UNKNOWN = "und"
#: Words that a task counts before it passes them on, or entries hashed at once.
HELD = 200_000
#: Labelled text the classifier is fit on, at most, in UTF-8 bytes; it bounds the model that the driver builds and every task receives.
TRAIN_BYTES = 32 << 20
#: Hash ranges of one histogram of the sample's search.
BUCKETS = 4096
_RUN = re.compile(r"[^\W\d_]+")
COUNTS = "lang string, entry string, n bigint"
RESULT = "doc_id bigint, content bigint, lang_pred string, score double"


def words(text: str) -> list[str]:
    """Runs of letters, lower-cased."""
    found = _RUN.findall(text.lower())
    if text.isascii():
        return found
    out = []
    for word in found:
        # Digits of other scripts and the like count as letters there.
        out += [word] if word.isalpha() else "".join(c if c.isalpha() else " " for c in word).split()
    return out


def grams(word: str, n: int) -> list[str]:
    marked = f"<{word}>"
    return [f"{n}{marked[k : k + n]}" for k in range(len(marked) - n + 1)]


def remainder(of: int) -> Column:
    """crc32 of the id as text, modulo ``of``; what is held out of training depends on it."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % of


def _counted(batches: Iterator[pa.RecordBatch], read) -> Iterator[pa.RecordBatch]:
    """Sums of ``read(batch, counter)`` by (language, entry), passed on before they grow large."""
    counts: Counter = Counter()

    def out() -> pa.RecordBatch:
        keys = list(counts)
        batch = pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()), pa.array([counts[k] for k in keys], pa.int64())],
            ["lang", "entry", "n"],
        )
        counts.clear()
        return batch

    for batch in batches:
        for _ in read(batch, counts):
            if len(counts) > HELD:
                yield out()
    if counts:
        yield out()


def _read_words(batch: pa.RecordBatch, counts: Counter):
    for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
        for word, n in Counter(words(text)).items():
            counts[lang, " " + word] += n
        yield


def _read_grams(batch: pa.RecordBatch, counts: Counter):
    for lang, entry, count in zip(*(batch.column(c).to_pylist() for c in ("lang", "entry", "n"))):
        for n in range(SHORTEST, LONGEST + 1):
            for gram in grams(entry[1:], n):
                counts[lang, gram] += count
        yield


def count_entries(labelled: DataFrame) -> DataFrame:
    """How often each word (after a blank) and n-gram (after its length) occurs in each language."""
    texts = labelled.where("lang IS NOT NULL AND text IS NOT NULL").select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    total = F.sum("n").alias("n")
    found = stage(texts.mapInArrow(lambda b: _counted(b, _read_words), COUNTS).groupBy("lang", "entry").agg(total), "word-counts")
    parts = found.mapInArrow(lambda b: _counted(b, _read_grams), COUNTS).groupBy("lang", "entry").agg(total)
    return found.unionByName(parts)


def bounded_sample(labelled: DataFrame, most: int = TRAIN_BYTES, buckets: int = BUCKETS) -> DataFrame:
    """Whole rows of ``labelled`` with ``lang`` and ``text``, at most ``most`` bytes of text in all.

    Rows are put in order of a 63-bit hash of id, language and text, and the sample is the longest start of that order
    that fits, so the choice depends neither on partitions nor on the order of rows, and all rows are taken when they fit.
    The cut is found by histograms of ``buckets`` hash ranges: the first range that does not fit is split again, at most
    six times, over a written table of hashes and sizes. Only the histograms reach the driver, whatever the size of the table.
    """
    rows = labelled.where("lang IS NOT NULL AND text IS NOT NULL")
    ident = F.col("doc_id").cast("long") if "doc_id" in labelled.columns else F.lit(None).cast("long")
    order = F.shiftrightunsigned(F.xxhash64(ident, F.col("lang").cast("string"), F.col("text").cast("string")), 1)
    sizes = stage(rows.select(order.alias("h"), F.octet_length(F.col("text").cast("string")).alias("n")), "sample-sizes")
    whole = 1 << 63
    if (sizes.agg(F.sum("n")).first()[0] or 0) <= most:
        return rows
    low, width, left, cut = 0, whole, most, whole
    while cut == whole:
        step = -(-width // buckets)
        inside = F.col("h") >= F.lit(low) if low + width >= whole else F.col("h").between(F.lit(low), F.lit(low + width - 1))
        found = sorted(map(tuple, sizes.where(inside).groupBy(F.expr(f"(h - {low}) div {step}").alias("b")).agg(F.sum("n")).collect()))
        for b, n in found:
            if n <= left:
                left -= n
                continue
            low, width = low + b * step, step
            if step == 1:
                cut = low
            break
        else:
            cut = low + width
    return rows if cut >= whole else rows.where(order < F.lit(cut))


def train(labelled: DataFrame, entries: int | None = None, most: int = TRAIN_BYTES) -> dict:
    """The model of a table with ``lang``, ``text`` and ``doc_id``, fit on at most ``most`` bytes of it (``bounded_sample``).

    It holds every entry of these rows. A caller who needs a smaller one can bound the number of entries: then those above a threshold on their
    largest share of a language stay, in eighths of a power of two, each with its counts in all languages. Totals count everything.
    """
    counts = stage(count_entries(bounded_sample(labelled, most)), "entry-counts")
    kind = F.substring("entry", 1, 1)
    sums = counts.groupBy("lang", kind.alias("kind")).agg(F.sum("n").alias("total"))
    totals = {(r.lang, r.kind): r.total for r in sums.collect()}
    kept = counts
    if entries is not None:
        shares = counts.withColumn("kind", kind).join(sums, ["lang", "kind"]).groupBy("entry").agg(F.floor(F.log2(F.max(F.col("n") / F.col("total"))) * 8).cast("int").alias("step"))
        seen, least = 0, None
        for level, n in sorted(map(tuple, shares.groupBy("step").agg(F.count("*")).collect()), reverse=True):
            if seen + n > entries:
                least = level + 1
                break
            seen += n
        if least is not None:
            kept = counts.join(shares.where(F.col("step") >= least).select("entry"), "entry")
    kept = kept.select("lang", "entry", "n").toArrow().combine_chunks()
    langs = sorted({lang for lang, _ in totals})
    number = {lang: k for k, lang in enumerate(langs)}
    names = pc.unique(kept.column("entry"))
    names = names.take(pc.sort_indices(names))
    table = np.zeros((len(names), len(langs)), np.float32)
    at = pc.index_in(kept.column("entry"), names).to_numpy()
    table[at, [number[x] for x in kept.column("lang").to_pylist()]] = kept.column("n").to_numpy()
    names = names.to_pylist()
    kinds = [name[0] for name in names]
    for k, lang in enumerate(langs):
        of_kind = {c: totals.get((lang, c), 0) for c in set(kinds)}
        whole = np.fromiter((of_kind[c] for c in kinds), float, len(kinds))
        table[:, k] = np.log((table[:, k] + SMOOTHING) / (whole + SMOOTHING * max(1, len(names))))
    return {"langs": langs, "entries": {name: k for k, name in enumerate(names)}, "logs": table}


class Entries:
    """The rows of the entries of a model: their bytes one after another, found by sorted hashes and then compared.

    A dictionary would take several times the memory in every Python worker.
    """

    def __init__(self, names: pa.StringArray):
        self.names = names
        hashes = np.concatenate([_hashes(names[k : k + HELD].to_pylist()) for k in range(0, max(1, len(names)), HELD)])
        order = np.argsort(hashes, kind="stable").astype(np.int32)
        self.hashes, self.order = hashes[order], order
        # Entries behind another one of the same hash.
        later = order[1:][self.hashes[1:] == self.hashes[:-1]].tolist()
        self.later = {names[k].as_py(): k for k in later}

    def find(self, wanted: list[str]) -> list[int]:
        """The row of each entry, -1 if there is none."""
        if not wanted or not len(self.names):
            return [-1] * len(wanted)
        hashes = _hashes(wanted)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        rows = np.where(self.hashes[at] == hashes, self.order[at], -1)
        hit = np.flatnonzero(rows >= 0)
        same = pc.equal(self.names.take(pa.array(rows[hit])), pa.array([wanted[k] for k in hit.tolist()], pa.string()))
        rows[hit[~same.to_numpy(zero_copy_only=False)]] = -1
        found = rows.tolist()
        if self.later:
            found = [self.later.get(name, row) for name, row in zip(wanted, found)]
        return found


def _hashes(names: list[str]) -> np.ndarray:
    return np.fromiter(map(hash, names), np.int64, len(names))


def _packed(model: dict) -> dict:
    """The model with its entries as one Arrow array in the order of their rows."""
    entries = model["entries"]
    return model | {"entries": pa.array(sorted(entries, key=entries.get), pa.string())}


class Predictor:
    def __init__(self, model: dict):
        if isinstance(model["entries"], dict):
            model = _packed(model)
        # Kept as sent (float32): the product with the float64 weights is taken in float64 all the same.
        self.langs, self.entries, self.logs = model["langs"], Entries(model["entries"]), model["logs"]

    def backed_off(self, word: str) -> list[int]:
        """The known ones among the longest n-grams of which some are known."""
        return self._backed_off([word]).get(word, [])

    def _backed_off(self, unseen: list[str]) -> dict[str, list[int]]:
        out: dict[str, list[int]] = {}
        for n in range(LONGEST, SHORTEST - 1, -1):
            parts = [grams(word, n) for word in unseen]
            names = list({g for p in parts for g in p})
            row = {g: k for g, k in zip(names, self.entries.find(names)) if k >= 0}
            for word, p in zip(unseen, parts):
                found = [row[g] for g in p if g in row]
                if found:
                    out[word] = found
            unseen = [word for word in unseen if word not in out]
        return out

    def rows(self, words: list[str]) -> dict[str, list[int]]:
        """The row of each known word, and those of the n-grams of the others."""
        out = {word: [row] for word, row in zip(words, self.entries.find([" " + w for w in words])) if row >= 0}
        return out | self._backed_off([word for word in words if word not in out])

    def predict(self, text: str | None) -> tuple[str, float]:
        return self.predict_all([text])[0]

    def predict_all(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """Predictions of some texts, whose words are looked up together."""
        counted = [Counter(words(text or "")) for text in texts]
        rows = self.rows(list({word: None for found in counted for word in found})) if self.langs else {}
        return [self._judged(found, rows) for found in counted]

    def _judged(self, found: Counter, rows: dict[str, list[int]]) -> tuple[str, float]:
        if not found or not self.langs:
            return UNKNOWN, 0.0
        known: list[int] = []
        weights: list[float] = []
        for word, n in found.items():
            at = rows.get(word)
            if at is not None:
                # The mean over the n-grams counts as one word.
                known += at
                weights += [n / len(at)] * len(at)
        total = np.array(weights) @ self.logs[known] if known else np.zeros(len(self.langs))
        share = np.exp(total - total.max())
        best = int(np.argmax(share))
        return self.langs[best], float(share[best] / share.sum())


def predict(docs: DataFrame, model: dict) -> DataFrame:
    """``doc_id``, ``content`` (hash of the text), ``lang_pred`` and ``score`` of every row of ``docs``.

    Reads ``doc_id`` and ``text``. Without a letter (null, empty, digits only), or without a language in the model, the
    prediction is ``und`` with score 0. The score is the share of the language in the likelihoods of all;
    of equal ones the first by code point wins. An empty table stays empty.
    """
    sent = docs.sparkSession.sparkContext.broadcast(_packed(model))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predictor = Predictor(sent.value)
        for batch in batches:
            for piece in scan.sliced(batch, "text"):
                found = predictor.predict_all(piece.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), piece.column("content"), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                    ["doc_id", "content", "lang_pred", "score"],
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), content().alias("content"), F.col("text").cast("string").alias("text")).mapInArrow(work, RESULT)


def drop_without_language(docs: DataFrame, model: dict, least: float = 0.0) -> DataFrame:
    """The documents that have a language with a score of at least ``least``, with all their columns.

    Few and unseen words give a low score, so by default only documents without any letter go. Without a language in the model
    no document can have a score, and only those without any letter go, whatever ``least`` is.
    """
    if model["langs"]:
        bad = predict(docs, model).where((F.col("lang_pred") == UNKNOWN) | (F.col("score") < least))
    else:
        # Any one language tells texts with a letter from those without.
        bad = predict(docs, {"langs": [""], "entries": {}, "logs": np.zeros((0, 1), np.float32)}).where(F.col("lang_pred") == UNKNOWN)
    return without(docs, stage(bad.select("doc_id", "content").distinct(), "without-language"))
