"""The byte model and the word baseline against plain versions."""

import os
import random

import numpy as np
import pytest

import brute
from ambertill.llm import lm_scoring, ppm, scan
from ambertill.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def texts(seed, n=60):
    draw = random.Random(seed)
    return [None, "", " ", "A b", "é😀"] + [" ".join(draw.choices(["the", "THEN", "of", "ab\n", "é", "日本", "x" + str(draw.randint(0, 9))], k=draw.randint(0, 30))) for _ in range(n)]


def scored(spark, docs, **options):
    frame = spark.createDataFrame([(i, t, 0, "") for i, t in docs], "doc_id long, text string, block int, held_out string").repartition(3)
    return lm_scoring.score(frame, **options).collect()


def check(rows, docs, order):
    train = [(t or "").encode() for i, t in docs if brute.fold(i, 5) != 1]
    expected = {}
    for base, (i, t) in zip(brute.base_scores(docs), docs):
        expected[i] = (*base, brute.ppm_score(train, (t or "").encode(), order))
    assert len(rows) == len(docs)
    for r in rows:
        e = expected[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == e[1:5]
        assert r.base_score == pytest.approx(e[5]) and r.score == pytest.approx(e[6], rel=1e-4)


@pytest.mark.parametrize("order", [0, 2, 5])
def test_scores(spark, order):
    docs = list(enumerate(texts(order)))
    check(scored(spark, docs, order=order), docs, order)


def test_small_sums(spark, monkeypatch):
    monkeypatch.setattr(lm_scoring, "HELD", 50)
    docs = list(enumerate(texts(8)))
    check(scored(spark, docs, order=3), docs, 3)


def test_pruned_trie_is_a_distribution(spark):
    model = lm_scoring.train(spark.createDataFrame([(t,) for t in texts(4)], "text string"), 3, 150)
    assert 0 < sum(map(len, model.nodes)) <= 150
    for context in (b"the", b"\0\0\0", b"zzz", "é ".encode()):
        strings = np.array([int.from_bytes(context + bytes([s]), "big") for s in range(256)], np.uint64)
        assert (10 ** model.log10(strings)).sum() == pytest.approx(1, rel=1e-4)


@pytest.mark.parametrize("hot", [0, 40])
def test_asks_for_what_is_not_sent_along(spark, hot):
    docs = list(enumerate(texts(11)))
    check(scored(spark, docs, order=4, hot=hot), docs, 4)


def test_whole_trie_above_a_million_nodes(spark):
    draw = np.random.default_rng(3)
    docs = [(k, draw.integers(97, 123, 8000).astype(np.uint8).tobytes().decode()) for k in range(70)]
    train = [t for i, t in docs if brute.fold(i, 5) != 1]
    nodes = {line[p - k : p + 1] for t in train for line in [b"\0" * 5 + t.encode() + b"\xff"] for p in range(5, len(line)) for k in range(6)}
    assert len(nodes) > 1_000_000
    docs.append((1000, train[0][:40]))
    rows = {r.doc_id: r for r in scored(spark, docs)}
    train = [(t or "").encode() for i, t in docs if brute.fold(i, 5) != 1]
    assert rows[1000].score == pytest.approx(brute.ppm_score(train, docs[-1][1].encode(), 5), rel=1e-4)


def pruned_score(train, text, order, nodes):
    """Plain version: counts of all symbols make the totals, and those of symbols left out are escape mass."""
    counts = {}
    for line in [b"\0" * order + t + b"\xff" for t in train]:
        for p in range(order, len(line)):
            for k in range(order + 1):
                here = counts.setdefault(line[p - k : p], {})
                here[line[p]] = here.get(line[p], 0) + 1
    total, line = 0.0, b"\0" * order + text + b"\xff"
    for p in range(order, len(line)):
        excluded = set()
        for k in range(order, -1, -1):
            context = line[p - k : p]
            kept = {s for s in counts.get(context, {}) if int.from_bytes(context + bytes([s]), "big") in nodes[k]}
            if not kept:
                continue
            weight = sum(n for s, n in counts[context].items() if s not in excluded) + len(counts[context]) - len(excluded)
            if line[p] in kept:
                total += np.log10(counts[context][line[p]] / weight)
                break
            left = weight - sum(counts[context][s] for s in kept - excluded)
            total += np.log10(left / weight) if left else 0
            excluded = kept
        else:
            total -= np.log10(256 - len(excluded))
    return total


def test_left_out_nodes_are_escape_mass(spark):
    train = texts(4)
    model = lm_scoring.train(spark.createDataFrame([(t,) for t in train], "text string"), 3, 150)
    nodes = [set(map(int, x)) for x in model.nodes]
    for text in (b"the of", b"THEN x4 zz", "é 日本 ab".encode()):
        expected = pruned_score([(t or "").encode() for t in train], text, 3, nodes)
        assert model.score(np.frombuffer(text, np.uint8), np.array([0, len(text)])) == pytest.approx([expected], rel=1e-4)


def test_nothing_to_learn_from(spark):
    assert scored(spark, []) == []
    held = next(i for i in range(100) if brute.fold(i, 5) == 1)
    (row,) = scored(spark, [(held, "ab c")])
    assert (row.n_tokens, row.n_known, row.train_tokens) == (3, 0, 0)
    assert row.score == pytest.approx(-5 * np.log10(256)) and row.base_score == pytest.approx(0)


def test_repeated_rows(spark):
    docs = [(3, "a b"), (3, "a b"), (None, "c"), (4, None)]
    rows = scored(spark, docs)
    assert sorted((r.doc_id for r in rows), key=repr) == sorted([3, 3, None, 4], key=repr)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="generated tables are not here")
def test_generated_documents(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    rows = {r.doc_id: r for r in QUERIES["op5_lm_scoring"](spark, FOLDER).collect()}
    train = [(t or "").encode() for i, t in docs if brute.fold(i, 5) != 1]
    for e, (i, t) in zip(brute.base_scores(docs), docs):
        assert tuple(rows[i])[:5] == e[:5] and rows[i].base_score == pytest.approx(e[5])
    for i, t in docs[:12]:
        assert rows[i].score == pytest.approx(brute.ppm_score(train, t.encode(), lm_scoring.ORDER), rel=1e-4)
