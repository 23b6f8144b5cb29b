"""Centroid clustering with Orchard's search against plain Lloyd rounds with a full scan."""

import hashlib
import math
import random

import numpy as np
import pytest

from ambertill.llm import orchard


def brute(rows, k=orchard.K, rounds=orchard.ROUNDS, dim=orchard.DIM):
    kept = [(i, [math.floor(1024 * float(x)) for x in v]) for i, v in rows
            if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    key = lambda r: (hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1])
    cents = [list(v) for _, v in sorted(kept, key=key)[:k]]

    def near(v):
        ds = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in cents]
        m = min(ds)
        return ds.index(m), m

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[0], []).append(v)
        for c, vs in groups.items():
            cents[c] = [sum(col) // len(vs) for col in zip(*vs)]
    out = []
    for i, v in kept:
        c, d = near(v)
        out.append((i, c, d))
    inertia = {}
    for _, c, d in out:
        inertia[c] = inertia.get(c, 0) + d
    total = sum(inertia.values())
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cents]
    return sorted(((i, c, d, inertia[c], total, digest[c]) for i, c, d in out), key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x") for i, v in rows], "vec_id long, embedding array<float>, label int, cluster string").repartition(3)


def vectors(seed, n, dim=orchard.DIM):
    draw = random.Random(seed)
    centres = [[draw.uniform(-1, 1) for _ in range(dim)] for _ in range(5)]
    rows = [(i, [float(np.float32(c + draw.gauss(0, 0.05))) for c in draw.choice(centres)]) for i in range(n)]
    rows += [(n, None), (n + 1, [0.1] * (dim - 1)), (n + 2, [float("nan")] + [0.0] * (dim - 1)), (n + 3, [None] + [0.0] * (dim - 1))]
    rows += [(7, rows[7][1]), (None, rows[3][1]), (n + 4, [0.0] * dim), (n + 5, [0.0] * dim)]
    return rows


def test_nearest_is_exact():
    draw = np.random.default_rng(1)
    cents = draw.integers(-50, 50, (8, 6))
    cents[5] = cents[2]
    points = draw.integers(-60, 60, (3000, 6))
    got, dist = orchard.nearest(points, cents)
    full = ((points[:, None, :] - cents[None]) ** 2).sum(axis=2)
    assert (dist == full.min(axis=1)).all()
    assert (got == full.argmin(axis=1)).all()


@pytest.mark.parametrize("seed,n", [(1, 300), (2, 5)])
def test_same_as_brute_force(spark, seed, n):
    rows = vectors(seed, n)
    got = orchard.clustered(frame(spark, rows))
    out = sorted((tuple(r) for r in got.select("_row.vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect()), key=repr)
    assert out == brute(rows)
    assert got.select("_row.cluster").first()[0] == "x"


def test_empty(spark):
    assert orchard.clustered(frame(spark, [(1, None)])).count() == 0


def test_registered_query(spark):
    from ambertill.llm.queries import QUERIES

    got = QUERIES["op12_orchard_kmeans"](spark, "/root/testdata/sf0.001")
    assert got.columns[:6] == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    rows = [(r.vec_id, list(r.embedding) if r.embedding is not None else None) for r in spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").collect()]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows)
