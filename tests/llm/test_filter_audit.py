"""Filter audit: packed counters against a plain count of every order and step, and against its SQL."""

import random
import re
from itertools import permutations

import pytest

from ambertill.llm import filter_audit

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(docs, labels):
    good = {d for d, q, _ in labels if d is not None and q == 1}
    toxic = {d for d, _, t in labels if d is not None and t == 1}
    firsts = {}
    for d, text, _ in docs:
        t = text or ""
        if d is not None:
            firsts[t] = min(firsts.get(t, d), d)
    fails = []
    for d, text, lang in docs:
        t = text or ""
        ws = WORD.findall(t)
        upper = sum("A" <= c <= "Z" for c in t)
        first = firsts.get(t)
        f = {
            "A": len(ws) < 100,
            "B": 100 * len(set(ws)) < 80 * len(ws),
            "C": 100 * upper > 10 * len(t),
            "D": any(c in "#$%&*|" for c in t),
            "E": first is not None and (d is None or d > first),
        }
        fails.append((lang or "", d, f))
    out = []
    for part in sorted({p for p, _, _ in fails}):
        rows = [(d, f) for p, d, f in fails if p == part]
        shapley = {l: 0 for l in "ABCDE"}
        table = []
        for order in map("".join, permutations("ABCDE")):
            gone = set()
            for s, letter in enumerate(order):
                removed = [i for i, (d, f) in enumerate(rows) if f[letter] and i not in gone]
                redundant = sum(1 for i, (d, f) in enumerate(rows) if f[letter] and i in gone)
                gone |= set(removed)
                unique = sum(1 for d, f in rows if f[letter] and sum(f.values()) == 1)
                shapley[letter] += len(removed)
                table.append([part, order, s + 1, letter, len(rows) - len(gone), len(removed), redundant, unique,
                              sum(1 for i in removed if rows[i][0] in good), sum(1 for i in removed if rows[i][0] in toxic)])
        out += [tuple(r + [shapley[r[3]]]) for r in table]
    return sorted(out)


def texts(seed, n):
    draw = random.Random(seed)
    vocab = ["w%d" % i for i in range(150)] + ["ABC", "x#", "Déjà", "日本"]
    out = [None, "", "a|b", "A" * 50]
    for _ in range(n):
        k = draw.choice([5, 99, 100, 120, 300])
        out.append(" ".join(draw.choice(vocab[: draw.choice([20, 154])]) for _ in range(k)))
    return out


def test_pack_round_trip():
    fields = [random.Random(1).randint(0, 1) for _ in range(filter_audit.FIELDS)]
    assert filter_audit.unpack(filter_audit.pack(fields, 5) * 31, 5) == [31 * f for f in fields]


@pytest.mark.parametrize("seed", [1, 2])
def test_same_as_brute_force(spark, seed):
    draw = random.Random(seed)
    ts = texts(seed, 60)
    docs = [(i, t, draw.choice(["en", "de", None, ""])) for i, t in enumerate(ts)]
    docs += [(3, ts[5], "en"), (3, ts[5], "en"), (None, ts[6], "de"), (None, "lonely", None), (70, ts[7], "en")]
    labels = [(draw.choice([d for d, _, _ in docs]), draw.randint(0, 1), draw.randint(0, 1)) for _ in range(40)] + [(None, 1, 1)]
    frame = spark.createDataFrame([(d, t, l, "clash", 1) for d, t, l in docs], "doc_id long, text string, lang string, part string, mask int").repartition(4)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = sorted(tuple(r) for r in filter_audit.audit(frame, lab).collect())
    assert got == brute(docs, labels)
    assert len(got) == 600 * len({l or "" for _, _, l in docs})


def test_empty(spark):
    frame = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert filter_audit.audit(frame, spark.createDataFrame([], "doc_id long, quality int, toxic int")).count() == 0


def test_query_matches_sql(spark):
    from oracle_check import canonical, connection
    from ambertill.llm.queries import ORACLES, QUERIES

    folder = "/root/testdata/sf0.01"
    got = QUERIES["op13_filter_audit"](spark, folder)
    expected = connection(folder).execute(ORACLES["op13_filter_audit"])
    names = [c[0] for c in expected.description]
    assert canonical(got.collect(), got.columns) == canonical(expected.fetchall(), names)


def test_a_third_of_rows_with_one_text(spark, monkeypatch):
    monkeypatch.setattr(filter_audit, "HOT_SHARE", 8)
    ts = texts(5, 30)
    docs = [(i, t, "en" if i % 2 else None) for i, t in enumerate(ts)] + [(100 + i, ts[9], "en") for i in range(20)]
    labels = [(100, 1, 0), (105, 0, 1), (9, 1, 1)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string").repartition(5)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert sorted(tuple(r) for r in filter_audit.audit(frame, lab).collect()) == brute(docs, labels)
