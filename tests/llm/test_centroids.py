"""Clustering by Hamerly bounds against plain whole-number k-means."""

import hashlib
import math
import random

import numpy as np
import pytest
from tessera.llm import centroids

SCHEMA = "vec_id long, embedding array<float>, label int, cluster string, upper int, v string"


def brute(rows, clusters=40, rounds=5):
    """rows: (vec_id, vector) -> sorted (vec_id, cluster, distance), inertias and centroids."""
    kept = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    key = lambda r: (hashlib.sha256(f"2:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1])
    c = [v for _, v in sorted(kept, key=key)[:clusters]]
    for r in range(rounds + 1):
        to = [min((sum((a - b) ** 2 for a, b in zip(v, m)), k) for k, m in enumerate(c)) for _, v in kept]
        if r < rounds:
            for k in range(len(c)):
                own = [v for (_, v), (_, x) in zip(kept, to) if x == k]
                if own:
                    c[k] = [sum(col) // len(own) for col in zip(*own)]
    inertia = {k: sum(d for d, x in to if x == k) for k in range(len(c))}
    sha = [hashlib.sha256(",".join(map(str, m)).encode()).hexdigest() for m in c]
    most = 2**63 - 1
    return sorted((str(i), k, min(d, most), min(inertia[k], most), min(sum(min(d, most) for d, _ in to), most), sha[k]) for (i, _), (d, k) in zip(kept, to))


def result(df):
    return sorted((str(r.vec_id), r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in df.collect())


def vectors(rnd, n, scale=1.0):
    middles = [[rnd.gauss(0, scale) for _ in range(64)] for _ in range(7)]
    return [[float(np.float32(m + rnd.gauss(0, 0.3 * scale))) for m in middles[i % 7]] for i in range(n)]


@pytest.fixture(scope="module")
def awkward_vectors():
    rnd = random.Random(3)
    rows = list(enumerate(vectors(rnd, 260)))
    rows += [(900, None), (901, []), (902, [0.5] * 63), (903, [None] + [0.1] * 63), (904, [math.nan] * 64), (905, [math.inf] + [0.0] * 63)]
    rows += [(5, rows[5][1]), (5, rows[6][1]), (None, rows[7][1]), (None, rows[8][1])]
    rows += [(1000 + i, [0.25] * 64) for i in range(90)]  # one very common vector
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", 2, "y") for i, v in rows], SCHEMA).repartition(3)


def test_matches_plain_k_means(spark, awkward_vectors):
    got = centroids.clustered(frame(spark, awkward_vectors))
    assert result(got) == brute(awkward_vectors)
    scans = [r.scans for r in got.collect()]
    assert min(scans) == 1 and sum(scans) < 0.7 * 6 * len(scans)  # bounds spare scans


def test_ties_few_and_no_vectors(spark):
    ones = [(i, [float(i % 2)] * 64) for i in range(10)]  # every centroid is one of two points
    assert result(centroids.clustered(frame(spark, ones))) == brute(ones)
    assert centroids.clustered(frame(spark, [(1, None)])).collect() == []
    assert centroids.clustered(frame(spark, [])).columns == ["vec_id", "cluster", "distance", "scans", "cluster_inertia", "inertia", "centroid_sha256"]


@pytest.mark.parametrize("scale", [2.0**14, 2.0**21])
def test_components_that_doubles_or_longs_would_round(spark, scale):
    rows = list(enumerate(vectors(random.Random(8), 60, scale)))
    assert centroids.exact_kind(int(scale * 256), 64) in (np.int64, object)
    assert result(centroids.clustered(frame(spark, rows), clusters=5)) == brute(rows, 5)


def test_bounds_stay_on_the_safe_side(spark):
    rnd = np.random.default_rng(1)
    x = rnd.integers(-50, 50, (500, 64)).astype(float)
    before, at = None, x[:9].astype(int).tolist()
    cluster, upper, lower = np.full(500, -1), np.zeros(500), np.zeros(500)
    for _ in range(6):
        c = centroids.Centroids.of(at, before, np.float64)
        centroids.assigned(x, c, cluster, upper, lower)
        d = np.sqrt(((x[:, None] - c.at[None]) ** 2).sum(2))
        own = d[np.arange(500), cluster]
        assert (own == d.min(1)).all() and (upper >= own).all()
        d[np.arange(500), cluster] = np.inf
        assert (lower <= d.min(1)).all()
        before, at = at, [np.floor(x[cluster == k].mean(0)).astype(int).tolist() if (cluster == k).any() else at[k] for k in range(9)]
