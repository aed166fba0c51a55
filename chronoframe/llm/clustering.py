"""Operator 13: plain Lloyd iterations in integers.

Components are floor(scale * x). The centroids, a few kilobytes, are broadcast; tasks take the squared differences to each
of them in NumPy integers, the first of the nearest wins, and each partition returns one row of integer sums a centroid,
which a groupBy merges. So results do not depend on how vectors are dealt out.

Defined results: a vector is kept if it has exactly ``dim`` components, none null or not finite; others have no row.
Components beyond +-2^27 after scaling count as that bound, so that squared distances fit 64 bits; sums of distances
beyond 64 bits are the largest long. Repeated rows count as often as they appear, each returned. A vector with a null id
is assigned but starts no centroid. Vectors whose ids have the same hash start in order of their components. With fewer
than ``k`` vectors to start from there are as many centroids; with none, no rows. Extra columns are dropped.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Scratch

#: Components are held within +-LIMIT: 64 squares of twice as much stay below 2^63.
LIMIT = 1 << 27
#: Vectors compared at once; bounds a task's memory.
ROWS = 4096


def quantised(vectors: DataFrame, key: str, vector: str, dim: int, scale: int) -> DataFrame:
    """(key, x array<int>) of the vectors with ``dim`` finite components."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    held = F.transform(vector, lambda x: F.floor(F.greatest(F.lit(float(-LIMIT)), F.least(F.lit(float(LIMIT)), x.cast("double") * scale))).cast("int"))
    return vectors.where((F.size(vector) == dim) & ~F.coalesce(bad, F.lit(True))).select(F.col(key).alias("__id"), held.alias("__x"))


def first_centroids(vectors: DataFrame, k: int, seed: int) -> np.ndarray:
    """The components of the k vectors whose ids have the smallest hashes: k rows reach the driver."""
    rank = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("__id").cast("string")), 256)
    rows = vectors.where(F.col("__id").isNotNull()).select(rank.alias("r"), "__x").orderBy("r", "__x").limit(k).collect()
    return np.array([r["__x"] for r in rows], np.int64)


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of the nearest centroid, squared distance); the smaller number on ties."""
    far = np.empty((len(centroids), len(x)), np.int64)
    for k, c in enumerate(centroids):
        d = x - c
        far[k] = np.einsum("ij,ij->i", d, d)
    best = far.argmin(axis=0)
    return best, far[best, np.arange(len(x))]


def _blocks(column: pd.Series, dim: int):
    for i in range(0, len(column), ROWS):
        yield np.concatenate(column.iloc[i : i + ROWS].to_numpy()).astype(np.int64).reshape(-1, dim)


def _round(vectors: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one assignment: floor of the mean of each one's vectors; an empty one stays."""
    held = vectors.sparkSession.sparkContext.broadcast(centroids)
    dim = centroids.shape[1]
    names = [f"s{i}" for i in range(dim)]

    def add(frames):
        c = held.value
        sums, counts = np.zeros_like(c), np.zeros(len(c), np.int64)
        for frame in frames:
            for x in _blocks(frame["__x"], dim):
                k, _ = nearest(x, c)
                for i in np.unique(k):
                    sums[i] += x[k == i].sum(axis=0)
                counts += np.bincount(k, minlength=len(c))
        some = np.flatnonzero(counts)
        yield pd.DataFrame({"cluster": some.astype(np.int32), "n": counts[some]} | {s: sums[some, i] for i, s in enumerate(names)})

    parts = vectors.select("__x").mapInPandas(add, "cluster int, n long, " + ", ".join(f"{s} long" for s in names))
    out = centroids.copy()
    for r in parts.groupBy("cluster").agg(F.sum("n").alias("n"), *(F.sum(s).alias(s) for s in names)).collect():
        out[r["cluster"]] = np.array([r[s] for s in names], np.int64) // r["n"]
    held.destroy()
    return out


def digest(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def cluster(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = 40, rounds: int = 5, dim: int = 64, scale: int = 256, seed: int = 2) -> DataFrame:
    """Per kept vector: key, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    ``vectors`` is read once a round, so it should be a stored table. A round moves k rows a partition; k rows reach the driver.
    """
    spark = vectors.sparkSession
    kind = dict(vectors.dtypes)[key]
    kept = quantised(vectors, key, vector, dim, scale)
    schema = f"{key} {kind}, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    centroids = first_centroids(kept, k, seed)
    if not len(centroids):
        return spark.createDataFrame([], schema)
    for _ in range(rounds):
        centroids = _round(kept, centroids)
    held = spark.sparkContext.broadcast(centroids)

    def assign(frames):
        for frame in frames:
            told = [nearest(x, held.value) for x in _blocks(frame["__x"], dim)]
            yield pd.DataFrame({"__id": frame["__id"], "cluster": np.concatenate([t[0] for t in told] or [np.zeros(0)]).astype(np.int32), "distance": np.concatenate([t[1] for t in told] or [np.zeros(0)]).astype(np.int64)})

    assigned = Scratch(spark, "clustering").write(kept.mapInPandas(assign, f"__id {kind}, cluster int, distance long"), "assigned")
    sums = {r["cluster"]: int(r["s"]) for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    most = (1 << 63) - 1
    whole = min(most, sum(sums.values()))
    told = spark.createDataFrame([(c, min(most, s), whole, digest(centroids[c])) for c, s in sums.items()], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    # as many rows as centroids at most
    return assigned.join(F.broadcast(told), "cluster").select(F.col("__id").alias(key), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
