"""Decontamination, mixing and sharding."""

import hashlib
import os
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

import brute
from ambertill.llm import decontamination, mixing, sharding

FOLDER = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, source string, item_id int, terms string"


def frame(spark, docs):
    return spark.createDataFrame([(d, t, s, 0, "") for d, t, s in docs], DOCS).repartition(3)


def passages(seed, n):
    draw = random.Random(seed)
    words = ["a", "B", "c1", "é", "Ünd", "日本", "of", "the"]
    texts = [None, "", "...", "a", "the of-the A"] + [" ".join(draw.choices(words, k=draw.randint(1, 25))) for _ in range(n)]
    return texts


def marks(spark, docs, items, **options):
    table = spark.createDataFrame(items, "item_id long, text string")
    got = decontamination.contaminated(frame(spark, [(d, t, "s") for d, t in docs]), table, **options)
    names = F.concat_ws(",", F.array_sort(F.transform("items", lambda i: i.cast("string"))))
    return sorted((tuple(r) for r in got.select("doc_id", "n_words", "n_hit", names).collect()), key=repr)


@pytest.mark.parametrize("window", [1, 3, 10])
def test_contaminated(spark, window):
    docs, items = list(enumerate(passages(1, 60))), list(enumerate(passages(2, 12), 7))
    docs += [(900, docs[20][1]), (900, docs[20][1]), (None, docs[21][1]), (901, " x ".join(t or "" for t in passages(2, 12)))]
    items += [(7, items[-1][1]), (None, items[-2][1])]
    assert marks(spark, docs, items, window=window) == brute.contaminated(docs, items, window)


def test_many_lots_and_candidates(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "LOT_WORDS", 15)
    monkeypatch.setattr(decontamination, "CANDIDATES", 20)
    docs, items = list(enumerate(passages(3, 25))), list(enumerate(passages(4, 6)))
    assert marks(spark, docs, items, window=2) == brute.contaminated(docs, items, 2)


def test_empty_tables(spark):
    docs, items = [(1, "a b c")], [(1, "a b c")]
    assert marks(spark, [], items) == [] and marks(spark, docs, []) == [(1, 3, 0, "")]
    empty = frame(spark, [])
    assert mixing.repetitions(empty).count() == 0 and sharding.sharded(empty).count() == 0


def test_proximity(spark):
    docs = [(1, "a b x c"), (2, "c x x x a b"), (3, "b c a"), (4, None), (5, "a b"), (6, "c")]
    items = [(1, "a b c"), (2, ""), (3, "zz a"), (4, "c")]
    got = decontamination.proximity_matches(frame(spark, [(d, t, "s") for d, t in docs]), spark.createDataFrame(items, "item_id long, text string"), 4)
    assert sorted(map(tuple, got.collect())) == [(1, 1), (1, 3), (4, 1), (4, 2), (4, 3), (4, 6)]


def test_dropping(spark):
    docs = frame(spark, [(1, "one two three", "s"), (1, "clean", "s"), (None, "one two three", "s"), (2, None, None)])
    kept = decontamination.drop_contaminated(docs, spark.createDataFrame([(5, "two THREE")], "item_id long, text string"))
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted([(1, "clean"), (2, None)], key=repr)


def test_targets(spark):
    draw = random.Random(6)
    docs = [(k, " ".join(["w"] * draw.randint(0, 40)), draw.choice(["b", "a", "é", None, "c"])) for k in range(300)]
    docs += [(1000 + k, "x\ty z", "tiny") for k in range(3)] + [(2000, None, "none"), (2001, " ", "none")]
    got = mixing.repetitions(frame(spark, docs)).collect()
    sizes = defaultdict(int)
    for _, t, s in docs:
        sizes[s] += len((t or "").encode().split())
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: 1 + k % 3 for k, s in enumerate(order)}
    total, free, target = sum(sizes.values()), set(sizes), {}
    left = total
    while True:
        share = left / sum(weight[s] for s in free)
        above = [s for s in free if share * weight[s] > 3 * sizes[s]]
        if not above:
            break
        for s in above:
            target[s] = 3 * sizes[s]
            left -= target[s]
            free.discard(s)
    target |= {s: share * weight[s] for s in free}
    assert len(got) == len(docs)
    taken = defaultdict(int)
    for r in got:
        assert r["_size"] == len((r.text or "").encode().split())
        assert r["_target"] == pytest.approx(target[r.source]) and r["_source_size"] == sizes[r.source]
        rate = target[r.source] / sizes[r.source] if sizes[r.source] else 0
        assert r["_copies"] in (int(rate), int(rate) + 1) and r["_copies"] <= 3
        taken[r.source] += r["_size"] * r["_copies"]
    assert sum(target.values()) == pytest.approx(total)
    for s in ("a", "b", "c"):
        assert taken[s] == pytest.approx(target[s], rel=0.35)
    again = mixing.repetitions(frame(spark, docs)).select("doc_id", "_copies").collect()
    assert sorted(map(tuple, again)) == sorted((r.doc_id, r["_copies"]) for r in got)
    assert mixing.mixed(frame(spark, docs)).count() == sum(r["_copies"] for r in got)


def test_columns_that_clash(spark, tmp_path):
    from ambertill.llm import language, simhash

    docs = frame(spark, [(1, "a b c d", "s"), (2, "x y z", "t"), (3, None, None)])
    own = ["_doc", "_content", "_row", "_size", "_name", "_copies", "_source", "_target", "_id", "_sum", "shard", "content", "component_id", "a.b", "block"]
    docs = docs.withColumns({c: F.lit(c) for c in own})
    items = spark.createDataFrame([(5, "a b c d")], "item_id long, text string")
    model = {"langs": ["x"], "entries": {}, "logs": __import__("numpy").zeros((0, 1))}
    ids = lambda df: sorted(r.doc_id for r in df.collect())
    for result, expected in (
        (decontamination.drop_contaminated(docs, items), [2, 3]),
        (language.drop_without_language(docs, model), [1, 2]),
        (simhash.one_of_each(docs), [1, 2, 3]),
    ):
        assert result.columns == docs.columns and ids(result) == expected
    assert mixing.mixed(docs).columns == docs.columns
    sharding.write_shards(docs, f"{tmp_path}/s", 2)
    assert spark.read.parquet(f"{tmp_path}/s").count() == 3


def test_no_python_in_the_mix(spark):
    from conftest import plan_of

    plan = plan_of(mixing.mixed(frame(spark, [(1, "a b", "s")])))
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


@pytest.mark.parametrize("shards, seed", [(8, 1), (3, 2), (1, 3), (8, 4)])
def test_shards(spark, shards, seed, monkeypatch):
    monkeypatch.setattr(sharding, "PROBES", 2 + seed)
    draw = random.Random(seed)
    docs = [(k, "x" * draw.choice([0, 3, 50, 400]) + str(draw.randint(0, 60)), "s") for k in range(5 if seed == 4 else 150)]
    docs += [(9, docs[3][1], "s"), (3, docs[3][1], "s"), (None, None, None), (8, "", "s"), (7, "é😀", "s")]
    got = sharding.sharded(frame(spark, docs), shards).collect()
    assert len(got) == len(docs)
    by_text, slots, loads = defaultdict(set), defaultdict(list), defaultdict(int)
    texts = defaultdict(list)
    for d, t, _ in docs:
        raw = (t or "").encode()
        texts[d, len(raw) + 1, zlib.crc32(raw)].append(raw)
    groups = defaultdict(int)
    for r in got:
        raw = texts[r.doc_id, r["size"], r.text_crc32].pop()
        by_text[raw].add(r.shard)
        slots[r.shard].append(r.slot)
        loads[r.shard] += r["size"]
        groups[hashlib.md5(raw).hexdigest()] += r["size"]
    assert all(len(s) == 1 for s in by_text.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(loads.values()) <= brute.smallest_capacity([groups[g] for g in sorted(groups)], shards)


def test_written_shards(spark, tmp_path):
    docs = frame(spark, [(k, f"text {k % 20}", "s") for k in range(60)])
    sharding.write_shards(docs, f"{tmp_path}/shards", 4)
    back = spark.read.parquet(f"{tmp_path}/shards")
    assert back.count() == 60 and set(docs.columns) < set(back.columns)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="generated tables are not here")
def test_generated_documents(spark):
    from ambertill.llm.queries import QUERIES
    from oracle_check import canonical, connection
    from ambertill.llm.queries import ORACLES

    con = connection(FOLDER)
    for name in ("op1_substring_dedup", "op2_decontamination", "op3_mixing"):
        expected = con.execute(ORACLES[name])
        columns = [c[0] for c in expected.description]
        got = QUERIES[name](spark, FOLDER)
        assert canonical([tuple(r) for r in got.collect()], got.columns) == canonical(expected.fetchall(), columns)
    got = QUERIES["op6_sharding"](spark, FOLDER)
    loads = got.groupBy("shard").agg(F.sum("size").alias("n")).collect()
    n = [r.n for r in loads]
    assert len(n) == 8 and max(n) - min(n) < 0.5 * max(n)
