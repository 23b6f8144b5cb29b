"""Threshold sketches against a plain version."""

import hashlib
import os
import random

import pytest
from pyspark.sql import functions as F

import brute
from ambertill.llm import fingerprints
from conftest import plan_of

FOLDER = "/root/testdata/sf0.001"


def frame(spark, docs):
    return spark.createDataFrame([(i, t, "x", 0) for i, t in docs], "doc_id long, text string, content string, place int").repartition(3)


def expected(docs):
    docs = sorted(docs, key=lambda d: d[0])
    out = []

    def near(a, b, equal):
        return 1.0 if equal else 0.0 if not a or not b else len(set(a) & set(b)) / min(len(a), len(b))

    for (i, t), (_, following) in zip(docs, docs[1:] + docs[:1]):
        t, following = t or "", following or ""
        half = len(t) // 2
        edited = t[: len(t) - half] + following[:half]
        a, b, c = brute.sketch(t), brute.sketch(edited), brute.sketch(following)
        text = lambda s: "".join(f"{h & (1 << 64) - 1:016x}" for h in s)
        out.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest(), text(a), text(b), near(a, b, t == edited), near(a, c, t == following)))
    return out


def corpus(seed):
    draw = random.Random(seed)
    texts = [None, "", " \t", "one", "four words and more", "é 😀 日本 a b c\vd"]
    for _ in range(30):
        texts.append(draw.choice([" ", "\n", " \r\n"]).join(f"w{draw.randint(0, 300)}" for _ in range(draw.randint(1, 200))))
    texts += [texts[9], texts[9], texts[10] + " tail"]
    return list(enumerate(texts, 10))


def test_sketches(spark):
    docs = corpus(1)
    assert sorted(tuple(r) for r in fingerprints.compared(frame(spark, docs)).collect()) == expected(docs)


def test_few_rows(spark):
    assert fingerprints.compared(frame(spark, [])).count() == 0
    text = "a b c d e f g h"
    (row,) = fingerprints.compared(frame(spark, [(5, text)])).collect()
    assert row.edited_sha256 == hashlib.sha256((text[:8] + text[:7]).encode()).hexdigest()
    rows = fingerprints.compared(frame(spark, [(1, text), (1, text), (None, text), (1, "x"), (2, None)])).collect()
    assert len(rows) == 5


def test_merged(spark):
    docs = corpus(2)
    table = fingerprints.sketches(frame(spark, docs)).withColumn("half", F.col("doc_id") % 2)
    got = {r.half: r.sketch for r in fingerprints.merged(table, "half").collect()}
    for half in (0, 1):
        assert got[half] == sorted({h for i, t in docs if i % 2 == half for h in brute.sketch(t)})


def test_no_python(spark):
    plan = plan_of(fingerprints.compared(frame(spark, corpus(3))))
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="generated tables are not here")
def test_generated_documents(spark):
    from ambertill.llm.queries import QUERIES

    docs = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(tuple(r) for r in QUERIES["op8_fingerprints"](spark, FOLDER).collect()) == expected(docs)
