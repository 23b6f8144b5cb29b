"""SimHash, the covering code and components against plain versions."""

import os
import random

import numpy as np
import pytest

import brute
from ambertill.llm import simhash
from ambertill.llm.components import components

DOCS = "doc_id long, text string, anchor int, home string"
FOLDER = "/root/testdata/sf0.001"


def result(spark, docs, **options):
    frame = spark.createDataFrame([(i, t, 0, "") for i, t in docs], DOCS).repartition(3)
    return [tuple(r) for r in simhash.near_duplicates(frame, **options).collect()]


def check(spark, docs, most=4, **options):
    got = result(spark, docs, most=most, **options)
    prints = [(i, brute.simhash(t)) for i, t in docs]
    expected = brute.near_components(prints, most)
    assert sorted((i, f & (1 << 64) - 1, c) for i, f, c in got) == sorted((i, f, expected[i]) for i, f in prints)


def edited(draw, text, changes):
    words = text.split()
    for _ in range(changes):
        words[draw.randrange(len(words))] = f"new{draw.randint(0, 99)}"
    return " ".join(words)


def corpus(seed):
    draw = random.Random(seed)
    docs = [None, "", "  ", "One", "one", "one two three", "ONE two three four", "é 😀"]
    for _ in range(12):
        base = " ".join(f"w{draw.randint(0, 500)}" for _ in range(draw.randint(30, 300)))
        docs += [base] + [edited(draw, base, draw.randint(0, 6)) for _ in range(draw.randint(0, 8))]
    return list(enumerate(docs, 5))


@pytest.mark.parametrize("most", [0, 3, 4, 8])
def test_near(spark, most):
    check(spark, corpus(most), most)


def test_segments(spark):
    check(spark, corpus(11), 4, segments=2)


def test_crowded_anchor(spark, monkeypatch):
    monkeypatch.setattr(simhash, "PART_HOMES", 3)
    monkeypatch.setattr(simhash, "CELLS", 50)
    check(spark, corpus(2))


def test_code_covers_and_visits_reach():
    draw = np.random.default_rng(1)
    for width in (21, 22, 32):
        x = draw.integers(0, 1 << width, 300, dtype=np.uint64)
        own = simhash.home(x)
        assert np.bitwise_count(own ^ x).max() <= 1
        rows, found = simhash.visits(x, width, 1)
        assert np.bitwise_count(found ^ x[rows]).max() <= 2
        reached = set(zip(rows.tolist(), found.tolist()))
        for bit in range(width):
            assert all((k, int(a)) in reached for k, a in enumerate(simhash.home(x ^ np.uint64(1 << bit))))


def test_empty_and_repeated(spark):
    assert result(spark, []) == []
    got = result(spark, [(2, "a b c d e"), (2, "a b c d e"), (None, "a b c d e"), (9, None)])
    assert sorted(((i, c) for i, _, c in got), key=repr) == sorted([(2, 2), (2, 2), (None, 2), (9, 9)], key=repr)


def test_one_of_each(spark):
    docs = [(3, "same text here now"), (1, "same text here now"), (7, None), (8, ""), (5, "another one altogether different"), (5, "another one altogether different")]
    frame = spark.createDataFrame([(i, t, 0, "h") for i, t in docs], DOCS)
    assert sorted(r.doc_id for r in simhash.one_of_each(frame).collect()) == [1, 5, 7]
    assert simhash.one_of_each(frame).columns == frame.columns


def test_components_of_chains(spark):
    draw = random.Random(4)
    links = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)] + [(-5, -5), (200, 300), (300, 200)]
    draw.shuffle(links)
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(41)}, **{k: 100 for k in range(100, 160)}, 200: 200, 300: 200}


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="generated tables are not here")
def test_generated_documents(spark):
    from ambertill.llm.queries import QUERIES

    docs = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    prints = [(i, brute.simhash(t)) for i, t in docs]
    expected = brute.near_components(prints)
    got = QUERIES["op10_simhash"](spark, FOLDER).collect()
    assert sorted(tuple(r) for r in got) == sorted((i, f"{f:016x}", expected[i]) for i, f in prints)
