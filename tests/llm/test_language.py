"""Language ID: accuracy on held-out texts, back-off, odd rows."""

import pickle
import tracemalloc
import os
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import brute
from ambertill.llm import language

FOLDER = "/root/testdata/sf0.01"
SYLLABLES = {"aa": ["ka", "to", "mi", "re"], "bb": ["sch", "ung", "ver", "ich"], "cc": ["eau", "oi", "ç", "ier"]}


def words_of(draw, lang, n):
    return " ".join("".join(draw.choices(SYLLABLES[lang], k=draw.randint(1, 5))) for _ in range(n))


def labelled(spark, n=90):
    draw = random.Random(1)
    rows = [(k, words_of(draw, lang, draw.randint(5, 60)), lang) for k in range(n) for lang in [draw.choice(list(SYLLABLES))]]
    return spark.createDataFrame([*rows, (500, None, "aa"), (501, "x y", None), (502, "", "bb")], "doc_id long, text string, lang string")


def test_held_out_words_by_shorter_parts(spark):
    model = language.train(labelled(spark), 400)
    assert len(model["entries"]) <= 400 and model["langs"] == ["aa", "bb", "cc"]
    draw = random.Random(7)
    docs = [(k, words_of(draw, lang, 12), lang) for k in range(60) for lang in [draw.choice(list(SYLLABLES))]]
    frame = spark.createDataFrame(docs, "doc_id long, text string, score string")
    got = {r.doc_id: r for r in language.predict(frame, model).collect()}
    assert np.mean([got[k].lang_pred == lang for k, _, lang in docs]) > 0.97
    assert all(0 < r.score <= 1 for r in got.values())


def test_counts_of_all_entries(spark):
    got = {(r.lang, r.entry): r.n for r in language.count_entries(spark.createDataFrame([("a", "Ab ab, c1d"), ("b", "ab"), ("a", None), (None, "z")], "lang string, text string")).collect()}
    assert got["a", " ab"] == 2 and got["b", " ab"] == 1 and got["a", " c"] == 1 and got["a", " d"] == 1
    assert got["a", "1b"] == 2 and got["a", "3<ab"] == 2 and got["a", "4<ab>"] == 2 and got["a", "3<c>"] == 1
    assert not any(lang == "z" or "1z" in e for lang, e in got)


def test_back_off_by_hand(spark):
    model = {"langs": ["x", "y"], "entries": {" known": 0, "5<abcd": 1, "2zz": 2, "1z": 3}, "logs": np.array([[-1, -2], [-3, -1], [-5, -4], [-1, -9]], np.float32)}
    p = language.Predictor(model)
    assert p.backed_off("abcde") == [1] and p.backed_off("zz") == [2] and p.backed_off("z") == [3] and p.backed_off("q") == []
    lang, score = p.predict("known abcde, ABCDE")
    total = np.array([-1 - 3 - 3, -2 - 1 - 1.0])
    assert lang == "y" and score == pytest.approx(np.exp(total[1]) / np.exp(total).sum())
    assert p.predict("q")[1] == pytest.approx(0.5)


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "12 34 -- ½"), (3, "kato kami"), (None, "kato"), (4, "😀")], "doc_id long, text string")
    got = language.predict(docs, language.train(labelled(spark)))
    assert sorted(((r.doc_id, r.lang_pred) for r in got.collect()), key=repr) == sorted([(1, "und"), (2, "und"), (3, "und"), (3, "aa"), (None, "aa"), (4, "und")], key=repr)
    kept = language.drop_without_language(docs, language.train(labelled(spark)))
    assert sorted((r.text for r in kept.collect())) == ["kato", "kato kami"] and kept.columns == docs.columns
    assert language.predict(docs.limit(0), {"langs": [], "entries": {}, "logs": np.zeros((0, 0))}).count() == 0
    nothing = language.train(docs.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in language.predict(docs, nothing).collect()} == {"und"}


def test_every_entry_of_a_rare_language_is_kept(spark):
    # Beside a language with many more different words than 120,000 rows hold, each seen twice, the rare one is seen once.
    letters = "abcdefghijklmnopqrstuvwxyz"
    hot = [(k, " ".join(2 * [f"{letters[k % 26]}{a}{b}{c}" for a in letters for b in letters for c in letters]), "aa") for k in range(26)]
    docs = spark.createDataFrame([*hot, (900, "œuvre ßträng", "zz")], "doc_id long, text string, lang string").repartition(3)
    model = language.train(docs)
    assert " œuvre" in model["entries"] and len(model["entries"]) > 26**4
    p = language.Predictor(model)
    assert p.predict("œuvre ßträng")[0] == "zz" and p.predict("abcd efgh")[0] == "aa"


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="generated tables are not here")
def test_held_out_accuracy(spark):
    from ambertill.llm.queries import QUERIES

    docs = {r.doc_id: r for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang", "text").collect()}
    rows = QUERIES["op7_language_id"](spark, FOLDER).collect()
    assert {r.doc_id: r.held_out for r in rows} == {i: brute.fold(i, 3) == 1 for i in docs}
    right = [r.lang_pred == docs[r.doc_id].lang for r in rows if r.held_out]
    assert len(right) > 300 and np.mean(right) > 0.99


def test_bounded_sample(spark):
    table = labelled(spark)
    whole = {r.doc_id for r in table.where("lang IS NOT NULL AND text IS NOT NULL").collect()}
    assert {r.doc_id for r in language.bounded_sample(table).collect()} == whole
    size = lambda df: sum(len(r.text.encode()) for r in df.collect())
    most = size(table.where("lang IS NOT NULL AND text IS NOT NULL")) // 3
    order = F.shiftrightunsigned(F.xxhash64(F.col("doc_id").cast("long"), "lang", "text"), 1)
    ranked = sorted((r.h, r.doc_id, len(r.text.encode())) for r in table.where("lang IS NOT NULL AND text IS NOT NULL").select(order.alias("h"), "doc_id", "text").collect())
    used, prefix = 0, set()
    for _, doc, n in ranked:
        if used + n > most:
            break
        used, prefix = used + n, prefix | {doc}
    # Two ranges a histogram: the search splits ranges many times over and still ends at the longest start that fits.
    for buckets in (4096, 2, 3):
        got = language.bounded_sample(table, most, buckets)
        again = language.bounded_sample(table.repartition(5).orderBy(F.rand(3)), most, buckets)
        rows = {(r.doc_id, r.text, r.lang) for r in got.collect()}
        assert 0 < size(got) <= most and rows == {(r.doc_id, r.text, r.lang) for r in again.collect()}
        assert {d for d, _, _ in rows} == prefix
    assert language.bounded_sample(table, 0).count() == 0
    assert language.train(table, most=most)["langs"] and language.bounded_sample(table.limit(0)).count() == 0


def test_predictor_holds_arrays_and_remembers_no_words():
    names = [f" w{k}" for k in range(50_000)] + ["1<", "1>"]
    model = {"langs": ["x", "y"], "entries": {n: k for k, n in enumerate(names)}, "logs": np.zeros((len(names), 2), np.float32)}
    sent = pickle.dumps(language._packed(model))
    tracemalloc.start()
    p = language.Predictor(pickle.loads(sent))
    for k in range(200):
        p.predict(" ".join(f"{chr(97 + k % 26)}{chr(97 + k // 26)}{chr(97 + j % 26)}{chr(97 + j // 26)}" for j in range(100)))
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert held < 50 * len(names)


def test_entries_of_equal_hash(monkeypatch):
    names = [" a", " b", "1<", "2<c", " d"]
    asked = [*names, " c", "", "2<d", " a"]
    plain = language.Entries(pa.array(names)).find(asked)
    monkeypatch.setattr(language, "_hashes", lambda found: np.array([len(n) % 2 for n in found], np.int64))
    equal = language.Entries(pa.array(names))
    assert plain == equal.find(asked) == [0, 1, 2, 3, 4, -1, -1, -1, 0]
    assert language.Entries(pa.array([], pa.string())).find(["x"]) == [-1] and equal.find([]) == []
