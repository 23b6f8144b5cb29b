"""The stages one after the other against plain versions."""

import hashlib
import os
from collections import Counter, defaultdict

import pytest

import brute
import corpus_pipeline
from ambertill.llm import language

FOLDER = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="generated tables are not here")


def mixed(docs):
    """Copies of each (doc_id, text, source)."""
    sizes = defaultdict(int)
    for _, t, s in docs:
        sizes[s] += len((t or "").encode().split())
    weight = {s: 1 + k % 3 for k, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    target, free, left = {}, set(sizes), sum(sizes.values())
    while free:
        share = left / sum(weight[s] for s in free)
        above = [s for s in free if share * weight[s] > 3 * sizes[s]]
        if not above:
            break
        for s in above:
            target[s] = 3 * sizes[s]
            left -= target[s]
            free.discard(s)
    target |= {s: share * weight[s] for s in free}
    out = Counter()
    for i, _, s in docs:
        rate = target[s] / sizes[s] if sizes[s] else 0
        chance = int(hashlib.md5(f"20:{i}".encode()).hexdigest()[:13], 16) / 2**52
        out[i] = int(rate) + (chance < rate - int(rate))
    return +out


def test_pipeline(spark, tmp_path):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select(COLUMNS).collect()]
    n = len(rows)
    rows += [(n, None, None, "src1", 0), (n + 1, "12 34", "en", None, 5), (n + 2, rows[5][1], "en", "src2", 1), (n + 3, "", "en", "src2", 0)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{FOLDER}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]

    docs, got = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        assert docs.columns == COLUMNS
        docs.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        got[name] = [tuple(r) for r in docs.collect()]

    by_id = {r[0]: r for r in rows}
    left = {i for i, r in by_id.items() if language.words(r[1] or "")}
    assert {r[0] for r in got["language"]} ^ left == set() and not {n, n + 1, n + 3} & left
    root = brute.near_components([(i, brute.simhash(by_id[i][1])) for i in sorted(left)])
    left = set(root.values())
    assert {r[0] for r in got["near_copies"]} == left and len(got["near_copies"]) == len(left)
    left -= {r[0] for r in brute.contaminated([(i, by_id[i][1]) for i in left], items) if r[2]}
    assert {r[0] for r in got["decontamination"]} == left
    copies = mixed([(i, by_id[i][1], by_id[i][3]) for i in left])
    assert Counter(r[0] for r in got["mixing"]) == copies
    assert all(by_id[r[0]] == r for stage in got.values() for r in stage)

    final = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter(r.doc_id for r in final) == copies
    groups, loads, slots, of_text = defaultdict(int), defaultdict(int), defaultdict(list), defaultdict(set)
    for r in final:
        raw = by_id[r.doc_id][1].encode()
        groups[hashlib.md5(raw).hexdigest()] += len(raw) + 1
        loads[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
        of_text[raw].add(r.shard)
    assert max(loads.values()) <= brute.smallest_capacity([groups[g] for g in sorted(groups)], 8)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and all(len(s) == 1 for s in of_text.values())


def test_unlabelled_table(spark):
    rows = [(1, "some words here", None, "a", 15), (2, "12 34", None, "a", 5), (3, None, None, "a", 0), (4, "é", None, "b", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(tuple(r) for r in corpus_pipeline.STAGES[0][1](spark, docs, "").collect()) == [rows[0], rows[3]]


def test_registered():
    import __spark_entry__ as contract

    assert contract.queries()["pipeline"] is corpus_pipeline.run
    assert len([q for q in contract.queries() if q.startswith("op")]) == 13
