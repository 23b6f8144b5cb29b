"""Centroid clustering (Lloyd rounds on integer vectors) with Orchard's nearest-centroid search.

Every round the centroids (``k`` vectors, a parameter, so their size is bounded) travel to the
tasks with the code; each task assigns its vectors and sends back one row of sums per centroid,
so what is shuffled is ``k`` rows per task whatever the number of vectors. The driver only sees
these ``k`` sums per round.

Orchard's search: every centroid keeps the list of all centroids sorted by their distance to it.
A vector starts at centroid 0 and walks the list of its current centroid; a centroid already
measured is skipped; a closer one (or an equally close one with a smaller number) becomes
current and its list is walked from the start; the walk stops at the first centroid of the list
that lies strictly beyond twice the current distance (squared: more than four times), since by
the triangle inequality it and all after it are strictly farther. All arithmetic is on integers,
so the result is the exact nearest centroid, ties to the smaller number.

Defined cases: vectors with a null, NaN or infinite component, or with another number of
components, are left out (not kept); null ``vec_id`` hashes as the empty string and sorts with
the others; repeated rows are separate vectors; ties of the first hashes are broken by the
vector; fewer kept vectors than ``k`` give as many centroids as vectors; an empty table gives no
rows. Scaled components must lie within +-2**27 so that a squared distance fits a long, else
the job stops with an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ambertill.llm.rows import packed
from ambertill.session import stage

DIM = 64
K = 8
ROUNDS = 10
SCALE = 1024
SEED = 3
LIMIT = 1 << 27


def kept(vectors: DataFrame, column: str = "embedding", dim: int = DIM, scale: int = SCALE) -> DataFrame:
    """``_row`` of every vector with ``dim`` finite components, and ``_vec``: floor(scale * x) as longs."""
    values = F.col(f"`{column}`")
    finite = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != F.lit(float("inf"))))
    good = (F.size(values) == dim) & finite
    scaled = F.transform(values, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("long"))
    return packed(vectors.where(F.coalesce(good, F.lit(False))), _vec=scaled)


def first_centroids(vectors: DataFrame, k: int = K, seed: int = SEED) -> list[np.ndarray]:
    """The ``k`` vectors with the smallest sha256 of ``seed:vec_id``, in that order (a top-k, not a collect of all)."""
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("_row.vec_id").cast("string"), F.lit(""))), 256)
    rows = vectors.select(key.alias("_key"), "_vec").orderBy("_key", "_vec").limit(k).collect()
    return [np.array(r["_vec"], dtype=np.int64) for r in rows]


def _lists(centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    between = ((centroids[:, None, :] - centroids[None, :, :]) ** 2).sum(axis=2)
    order = np.lexsort((np.broadcast_to(np.arange(len(centroids)), between.shape), between), axis=1)
    return between, order


def nearest(points: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centroid (ties: smaller number) and squared distance of every point, by Orchard's walk."""
    n, k = len(points), len(centroids)
    if np.abs(points).max(initial=0) >= LIMIT or np.abs(centroids).max(initial=0) >= LIMIT:
        raise ValueError("scaled components must lie within +-2**27")
    between, lists = _lists(centroids)
    current = np.zeros(n, np.int64)
    best = ((points - centroids[0]) ** 2).sum(axis=1)
    seen = np.zeros((n, k), bool)
    seen[:, 0] = True
    place = np.zeros(n, np.int64)
    active = np.arange(n) if k > 1 else np.zeros(0, np.int64)
    while len(active):
        cur, at = current[active], place[active]
        ended = at >= k
        cand = lists[cur, np.minimum(at, k - 1)]
        ended |= between[cur, cand] > 4 * best[active]
        active, cur, cand = active[~ended], cur[~ended], cand[~ended]
        fresh = ~seen[active, cand]
        skipped = active[~fresh]
        place[skipped] += 1
        active, cur, cand = active[fresh], cur[fresh], cand[fresh]
        seen[active, cand] = True
        d = ((points[active] - centroids[cand]) ** 2).sum(axis=1)
        closer = (d < best[active]) | ((d == best[active]) & (cand < cur))
        jump, stay = active[closer], active[~closer]
        current[jump], best[jump], place[jump] = cand[closer], d[closer], 0
        place[stay] += 1
        active = np.concatenate([jump, stay, skipped])
    return current, best


def _points(frame: pd.DataFrame) -> np.ndarray:
    return np.stack(frame["_vec"].to_numpy()).astype(np.int64) if len(frame) else np.zeros((0, 0), np.int64)


def _sums(vectors: DataFrame, centroids: np.ndarray) -> list:
    k, dim = centroids.shape

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums, counts = np.zeros((k, dim), np.int64), np.zeros(k, np.int64)
        for frame in batches:
            if len(frame):
                points = _points(frame)
                near, _ = nearest(points, centroids)
                np.add.at(sums, near, points)
                counts += np.bincount(near, minlength=k)
        yield pd.DataFrame({"cluster": np.arange(k, dtype=np.int32), "n": counts, "sums": list(sums)})

    parts = vectors.select("_vec").mapInPandas(partial, "cluster int, n long, sums array<long>")
    total = [F.sum(F.col("sums")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(dim)]
    return parts.groupBy("cluster").agg(F.sum("n").alias("n"), *total).collect()


def fitted(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, seed: int = SEED) -> np.ndarray:
    """Centroids after ``rounds`` rounds; ``vectors`` as given by ``kept`` (and best staged)."""
    start = first_centroids(vectors, k, seed)
    if not start:
        return np.zeros((0, DIM), np.int64)
    centroids = np.stack(start)
    for _ in range(rounds):
        new = centroids.copy()
        for row in _sums(vectors, centroids):
            if row["n"]:
                new[row["cluster"]] = [int(row[f"s{i}"]) // int(row["n"]) for i in range(centroids.shape[1])]
        centroids = new
    return centroids


def assigned(vectors: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``_row``, ``cluster`` and ``distance`` (squared) of every vector; only ``_vec`` crosses to Python."""

    @F.pandas_udf("cluster int, distance long")
    def assign(vecs: pd.Series) -> pd.DataFrame:
        points = np.stack(vecs.to_numpy()).astype(np.int64) if len(vecs) else np.zeros((0, centroids.shape[1]), np.int64)
        near, dist = nearest(points, centroids)
        return pd.DataFrame({"cluster": near.astype(np.int32), "distance": dist})

    return vectors.select("_row", assign("_vec").alias("_near")).select("_row", "_near.cluster", "_near.distance")


def centroid_digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(str(int(v)) for v in centroid).encode()).hexdigest()


def clustered(embeddings: DataFrame, column: str = "embedding", k: int = K, rounds: int = ROUNDS) -> DataFrame:
    """``_row``, ``cluster``, ``distance``, ``cluster_inertia``, ``inertia`` and ``centroid_sha256`` of every kept vector."""
    spark = embeddings.sparkSession
    vectors = stage(kept(embeddings, column), "vectors")
    centroids = fitted(vectors, k, rounds)
    if not len(centroids):
        empty = "cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
        return spark.createDataFrame([], f"_row {vectors.schema['_row'].dataType.simpleString()}, {empty}")
    near = stage(assigned(vectors, centroids), "assigned")
    per = near.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    digests = spark.createDataFrame([(i, centroid_digest(c)) for i, c in enumerate(centroids)], "cluster int, centroid_sha256 string")
    # k rows at most: the whole sum over clusters is taken in one small window
    per = per.join(digests, "cluster").withColumn("inertia", F.sum("cluster_inertia").over(_all()))
    return near.join(F.broadcast(per), "cluster").select("_row", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _all():
    from pyspark.sql import Window

    return Window.partitionBy()
