"""Centroid clustering by Hamerly bounds, in exact whole numbers.

Every vector keeps its cluster, one upper bound on the distance to its centroid
and one lower bound on the distance to the second nearest, as a written table
of the shared folder. When centroids move, the bounds are loosened by their
drift; only where they no longer tell which centroid is nearest is the distance
to the own centroid computed, and if that doesn't tell either, those to all.

Bounds are doubles rounded to the safe side; distances are whole numbers and
exact. Sums of a cluster combine before the shuffle, and the driver sees a row a
cluster.

Defined results: rows whose vector is null, has another number of components, or
a null or non-finite one are left out; rows that repeat return repeated rows;
vec_ids that tie are ordered by their vector, and a null one hashes as the empty
string; fewer vectors than centroids make as many centroids as vectors; no
vectors return no rows. Other columns aren't read. A distance or sum beyond the
range of a long is given as its largest number.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.llm.common import discard, scratch_path

DIMENSIONS, SCALE, CLUSTERS, ROUNDS = 64, 256, 40, 5
LONGEST = (1 << 63) - 1
#: Bounds are widened by so much of themselves, far more than doubles round.
SLACK = 1e-9
STATE = "vec_id long, v array<long>, cluster int, upper double, lower double, scans int"


def quantised(vectors: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, v): the vectors that count, with components floor(scale * x)."""
    x = F.col(vector_col).cast("array<double>")
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), x.alias("x")).filter((F.size(x) == dimensions) & finite)
    return rows.select("vec_id", F.transform("x", lambda c: F.floor(c * scale)).alias("v"))


def first_centroids(rows: DataFrame, clusters: int = CLUSTERS) -> list[list[int]]:
    """The vectors whose ids hash least. At most ``clusters`` rows come back."""
    key = F.sha2(F.encode(F.concat(F.lit("2:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), "UTF-8"), 256)
    return [list(r.v) for r in rows.select(key.alias("key"), "v").orderBy("key", "v").limit(clusters).collect()]


@dataclass
class Centroids:
    """Centroids with what the bounds need: how far each has moved (rounded up),
    and how far its nearest neighbour is (rounded down)."""

    at: np.ndarray
    drift: np.ndarray
    apart: np.ndarray

    @classmethod
    def of(cls, at: list[list[int]], before: list[list[int]] | None, kind: type) -> Centroids:
        now = np.array(at, kind)
        k = len(at)
        root = lambda d: np.sqrt(d.astype(np.float64))
        drift = root(((now - np.array(before, kind)) ** 2).sum(1)) * (1 + SLACK) if before is not None else np.zeros(k)
        between = root(((now[:, None] - now[None]) ** 2).sum(2))
        np.fill_diagonal(between, np.inf)
        return cls(now, drift, between.min(1, initial=np.inf) * (1 - SLACK))


def _distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances of each row to each centroid, exact: the kind of number
    is chosen so that every product and sum is."""
    return (x * x).sum(1)[:, None] - 2 * (x @ centroids.T) + (centroids * centroids).sum(1)[None]


def assigned(x: np.ndarray, c: Centroids, cluster: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> np.ndarray:
    """Assigns rows of x in place by their bounds; returns which took a full
    scan. A cluster of -1 has none yet."""
    far = c.drift.argmax()
    second = np.delete(c.drift, far).max(initial=0.0)
    upper += c.drift[cluster]
    lower -= np.where(cluster == far, second, c.drift[far])
    limit = np.maximum(lower, c.apart[cluster] / 2)
    doubtful = np.flatnonzero((cluster < 0) | (upper >= limit))
    known = doubtful[cluster[doubtful] >= 0]
    upper[known] = np.sqrt(((x[known] - c.at[cluster[known]]) ** 2).sum(1).astype(np.float64)) * (1 + SLACK)
    doubtful = doubtful[(cluster[doubtful] < 0) | (upper[doubtful] >= limit[doubtful])]
    d = _distances(x[doubtful], c.at)
    cluster[doubtful] = nearest = d.argmin(1) if len(doubtful) else np.zeros(0, int)  # the first of equal ones
    rows = np.arange(len(doubtful))
    upper[doubtful] = np.sqrt(d[rows, nearest].astype(np.float64)) * (1 + SLACK)
    others = np.sqrt(d.astype(np.float64))
    others[rows, nearest] = np.inf
    lower[doubtful] = others.min(1, initial=np.inf) * (1 - SLACK)
    scanned = np.zeros(len(x), bool)
    scanned[doubtful] = True
    return scanned


def exact_kind(largest: int, dimensions: int) -> type:
    """The kind of number in which distances of components up to largest are exact."""
    most = dimensions * (4 * max(1, largest)) ** 2
    return np.float64 if most < 1 << 53 else np.int64 if most < 1 << 63 else object


def _vectors(column: pa.Array, dimensions: int, kind: type) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), dimensions)
    return flat.astype(kind)


def clustered(vectors: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS, scale: int = SCALE, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, cluster, distance, scans, cluster_inertia, inertia,
    centroid_sha256) of every vector that counts: ``rounds`` times assigned and
    centroids moved, then assigned once more. scans: how often it was held
    against all centroids."""
    spark = vectors.sparkSession
    rows = quantised(vectors, dimensions, scale, id_col, vector_col)
    start = rows.withColumns({"cluster": F.lit(-1), "upper": F.lit(0.0), "lower": F.lit(0.0), "scans": F.lit(0)})
    path = _written(start, spark)
    state = spark.read.schema(STATE).parquet(path)
    largest = state.agg(F.max(F.array_max(F.transform("v", lambda c: F.greatest(F.abs(F.greatest(c, F.lit(-LONGEST))), F.lit(0)))))).first()[0] or 0
    kind = exact_kind(largest, dimensions)
    before, at = None, first_centroids(state, clusters)
    for _ in range(rounds if at else 0):
        old, path = path, _written(_assign(state, Centroids.of(at, before, kind), dimensions, kind), spark)
        discard(spark, old)
        state = spark.read.schema(STATE).parquet(path)
        before, at = at, _moved(state, at, dimensions, largest)
    if not at:
        return state.select("vec_id", "cluster", *[F.lit(None).cast(t).alias(n) for n, t in (("distance", "long"), ("scans", "int"), ("cluster_inertia", "long"), ("inertia", "long"), ("centroid_sha256", "string"))])
    last = _measured(_assign(state, Centroids.of(at, before, kind), dimensions, kind), at, dimensions, kind)
    states, path = path, scratch_path(spark, "clusters")
    last.write.parquet(path)
    discard(spark, states)
    last = spark.read.schema("vec_id long, cluster int, distance long, scans int").parquet(path)
    total = lambda c: F.sum(F.col(c).cast("decimal(38,0)"))
    sums = last.groupBy("cluster").agg(total("distance").alias("own")).withColumn("whole", total("own").over(Window.partitionBy(F.lit(0))))  # a row a cluster
    sums = sums.select("cluster", *[F.least(F.col(c), F.lit(LONGEST)).cast("long").alias(n) for c, n in (("own", "cluster_inertia"), ("whole", "inertia"))])
    shas = spark.createDataFrame([(i, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()) for i, c in enumerate(at)], "cluster int, centroid_sha256 string")
    # a row a cluster: ``clusters`` at most
    return last.join(F.broadcast(sums.join(F.broadcast(shas), "cluster")), "cluster").select("vec_id", "cluster", "distance", "scans", "cluster_inertia", "inertia", "centroid_sha256")


def _written(rows: DataFrame, spark: SparkSession) -> str:
    path = scratch_path(spark, "bounds")
    rows.write.parquet(path)
    return path


def _assign(state: DataFrame, c: Centroids, dimensions: int, kind: type) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _vectors(b.column(1), dimensions, kind)
            cluster, upper, lower, scans = (b.column(i).to_numpy(zero_copy_only=False).copy() for i in (2, 3, 4, 5))
            scans += assigned(x, c, cluster, upper, lower)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(cluster), pa.array(upper), pa.array(lower), pa.array(scans)], b.schema.names)

    return state.mapInArrow(run, STATE)


def _measured(state: DataFrame, at: list[list[int]], dimensions: int, kind: type) -> DataFrame:
    """state with the exact squared distance to its centroid."""
    centroids = np.array(at, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, cluster = _vectors(b.column(1), dimensions, kind), b.column(2).to_numpy()
            d = ((x - centroids[cluster]) ** 2).sum(1)
            d = np.array([min(int(v), LONGEST) for v in d], np.int64) if kind is object else d.astype(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(d), b.column(5)], ["vec_id", "cluster", "distance", "scans"])

    return state.mapInArrow(run, "vec_id long, cluster int, distance long, scans int")


def _moved(state: DataFrame, at: list[list[int]], dimensions: int, largest: int) -> list[list[int]]:
    """The floored means of the clusters; one without vectors stays. Large
    components are summed in halves, so that no sum overflows."""
    bits = 31 if largest >= 1 << 31 else 0
    sums = {f"l{i}": F.sum(F.col("v")[i].bitwiseAND((1 << bits) - 1) if bits else F.col("v")[i]) for i in range(dimensions)}
    if bits:
        sums |= {f"h{i}": F.sum(F.shiftright(F.col("v")[i], bits)) for i in range(dimensions)}
    out = list(at)
    for r in state.groupBy("cluster").agg(F.count("*").alias("n"), *[v.alias(k) for k, v in sums.items()]).collect():  # a row a cluster
        out[r.cluster] = [(((r[f"h{i}"] << bits) if bits else 0) + r[f"l{i}"]) // r.n for i in range(dimensions)]
    return out
