"""Substring and suffix dedup against plain versions."""

import os
import random

import pytest
from pyspark.sql import functions as F

import brute
from ambertill.llm import substring_dedup, suffix_dedup
from ambertill.llm.run_index import RunIndex

DOCS = "doc_id long, text string, block int, part string"
FOLDER = "/root/testdata/sf0.001"


def corpus(seed, n=60, alphabet=None):
    """Random texts that share passages, with copies, periodic, short, empty and null ones."""
    draw = random.Random(seed)
    vocabulary = alphabet or [f"w{k}" for k in range(40)] + ["é", "日本", "😀"]
    passages = [" ".join(draw.choices(vocabulary, k=draw.randint(5, 90))) for _ in range(6)]
    texts = [None, "", " ", "a", "ab " * 300, "ab " * 301, " ".join("xyz")]
    while len(texts) < n:
        parts = []
        for _ in range(draw.randint(0, 4)):
            parts.append(draw.choice(passages) if draw.random() < 0.5 else " ".join(draw.choices(vocabulary, k=draw.randint(0, 60))))
        texts.append(draw.choice([" ", "\n", " \t "]).join(parts))
    texts += [draw.choice(texts) for _ in range(n // 6)]
    return [(k, t) for k, t in enumerate(texts)]


def frame(spark, docs):
    return spark.createDataFrame([(i, t, 1, "x") for i, t in docs], DOCS).repartition(4)


def words_of(spark, docs, **options):
    out = substring_dedup.remove_repeats(frame(spark, docs), **options)
    return sorted(tuple(r) for r in out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256)).collect())


def bytes_of(spark, docs, **options):
    out = suffix_dedup.remove_repeated_bytes(frame(spark, docs), **options)
    return sorted(tuple(r) for r in out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256)).collect())


@pytest.mark.parametrize("window", [1, 2, 7, 35])
def test_words(spark, window):
    docs = corpus(window)
    assert words_of(spark, docs, window=window) == brute.repeated_words(docs, window)


@pytest.mark.parametrize("length", [3, 40, 400])
def test_bytes(spark, length):
    docs = corpus(length)
    assert bytes_of(spark, docs, length=length) == brute.repeated_bytes(docs, length)


def test_passage_with_many_surroundings(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HOT_REGIONS", 2)
    monkeypatch.setattr(suffix_dedup, "INDEX_BYTES", 300)
    docs = corpus(5, 80)
    assert bytes_of(spark, docs, length=60) == brute.repeated_bytes(docs, 60)


def test_two_letters(spark):
    docs = corpus(9, 30, ["a", "b"])
    assert words_of(spark, docs, window=8) == brute.repeated_words(docs, 8)
    assert bytes_of(spark, docs, length=17) == brute.repeated_bytes(docs, 17)


def test_spans_tell_what_is_kept(spark):
    docs = corpus(3)
    for row, (_, text) in zip(substring_dedup.remove_repeats(frame(spark, docs), window=9).orderBy("doc_id").collect(), docs):
        words = (text or "").split(" ") if not text else text.encode().split()
        words = [w for w in words if w]
        gone = {k for s in row.removed for k in range(s.first, s.first + s.words)}
        assert len(gone) == row.n_removed
        assert row.kept.encode() == b" ".join(w for k, w in enumerate(words) if k not in gone)


def test_repeated_ids_and_rows(spark):
    text = " ".join(f"v{k}" for k in range(50))
    docs = [(1, text), (1, text), (1, "other words"), (None, text), (None, None)]
    key = lambda rows: sorted(rows, key=repr)
    kept = substring_dedup.remove_repeats(frame(spark, docs))
    assert key((r.doc_id, r.n_removed) for r in kept.collect()) == key([(1, 50), (1, 50), (1, 0), (None, 50), (None, 0)])
    longer = suffix_dedup.remove_repeated_bytes(frame(spark, docs), length=100)
    assert key((r.doc_id, r.n_removed) for r in longer.collect()) == key([(1, len(text)), (1, len(text)), (1, 0), (None, len(text)), (None, 0)])


def test_empty_tables(spark):
    assert words_of(spark, []) == [] and bytes_of(spark, []) == []


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="generated tables are not here")
def test_generated_documents(spark):
    from ambertill.llm.queries import QUERIES

    docs = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    got = QUERIES["op1_substring_dedup"](spark, FOLDER).collect()
    assert sorted(tuple(r) for r in got) == brute.repeated_words(docs)
    got = QUERIES["op9_suffix_array_dedup"](spark, FOLDER).collect()
    assert sorted(tuple(r) for r in got) == brute.repeated_bytes(docs)


def test_matching_statistics():
    import numpy as np

    rows = [b"abracadabra", b"cadabracad", b"", b"xyz", b"abra"]
    data = np.frombuffer(b"".join(rows), np.uint8)
    starts = np.cumsum([0, *map(len, rows)])
    for length in (1, 3, 5):
        got = RunIndex(data, starts).repeated(length)
        seen = [r[k : k + length] for r in rows for k in range(len(r) - length + 1)]
        expected = [len(r) - k >= length and seen.count(r[k : k + length]) > 1 for r in rows for k in range(len(r))]
        assert got.tolist() == expected
