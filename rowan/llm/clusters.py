"""Centroid clustering of integer vectors: Lloyd's rounds with equal-average equal-variance search.

Components become whole numbers, floor(scale * x), and stay so: distances and sums are exact, whatever the
order of rows and tasks. A task sorts the centroids by the mean of their components and scans outward from
each vector's own mean. With d components, sums S and deviations V = sqrt(sum (x - S/d)^2) every centroid is
at least (Sx - Sc)^2 / d + (Vx - Vc)^2 away, squared: the first term alone ends the scan on both sides, both
together pass a centroid over, and what is left is measured in whole numbers. Bounds are taken in double
precision with a margin above their rounding errors, so that no centroid as near as the best is passed over.

Vectors are written once as whole numbers; a round reads them and returns the count and the sums of each
cluster from each task, added up in Spark. The driver holds the centroids and nothing else.

Defined cases: vectors null, of another length than `dim` or with null or non-finite components take no part;
rows without an id are assigned but start no centroid; repeated rows count each; starts of one id come in the
order of their components; with fewer vectors than centroids there are as many centroids as vectors, with none
an empty result; equal distances go to the smaller number; a cluster without vectors keeps its centroid; a
component whose squared distances would not fit 64 bits raises; further columns are ignored, whatever their
names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowan.sources.scratch import written

DIM = 64
SCALE = 1024
CENTROIDS = 8
ROUNDS = 10
SALT = 3
#: Vectors searched at a time.
_BLOCK = 4096
_MARGIN = 1e-9


def whole_vectors(
    vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", dim: int = DIM, scale: int = SCALE
) -> DataFrame:
    """vec_id and the whole-numbered vector of every row that takes part."""

    def odd(x: Column) -> Column:
        return x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))

    numbers = F.transform(F.col(vector), lambda x: x.cast("double"))
    sound = (F.size(F.col(vector)) == dim) & ~F.exists(numbers, odd)
    whole = F.transform(F.col(vector), lambda x: F.floor(F.lit(scale) * x.cast("double")))
    rows = vectors.where(F.coalesce(sound, F.lit(False)))
    return rows.select(F.col(vec_id).cast("long").alias("vec_id"), whole.alias("vector"))


def _first_centroids(rows: DataFrame, count: int, salt: int) -> np.ndarray:
    """The vectors whose ids hash lowest."""
    place = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string")), 256).alias("place")
    first = rows.where("vec_id IS NOT NULL").select(place, "vector").orderBy("place", "vector").limit(count)
    return np.array([r["vector"] for r in first.collect()], np.int64)


def _spread(points: np.ndarray) -> np.ndarray:
    return np.sqrt(((points - points.mean(1, keepdims=True)) ** 2).sum(1))


def nearest_centroid(points: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Number and squared distance of each point's nearest centroid, and how many distances were taken."""
    k, dim = centroids.shape
    order = np.argsort(centroids.sum(1), kind="stable")
    sums, spreads = centroids.sum(1)[order].astype(float), _spread(centroids)[order]
    own_sum, own_spread = points.sum(1).astype(float), _spread(points)
    best = np.full(len(points), np.iinfo(np.int64).max)
    number = np.full(len(points), k)
    above = np.searchsorted(sums, own_sum)
    below = above - 1
    live, taken = np.arange(len(points)), 0
    edges = np.concatenate([sums, [np.inf]])  # past either end (-1 and k) lies infinity
    while len(live):
        down = (own_sum[live] - edges[below[live]]) ** 2 / dim
        up = (own_sum[live] - edges[above[live]]) ** 2 / dim
        lower = down <= up
        gap = np.where(lower, down, up)
        limit = best[live].astype(float)
        on = np.isfinite(gap) & (gap * (1 - _MARGIN) - 1 <= limit)
        live, lower, gap, limit = live[on], lower[on], gap[on], limit[on]
        place = np.where(lower, below[live], above[live])
        bound = gap + (own_spread[live] - spreads[place]) ** 2
        close = bound * (1 - _MARGIN) - 1 <= limit
        at, chosen = live[close], order[place[close]]
        apart = points[at] - centroids[chosen]
        far = np.einsum("bd,bd->b", apart, apart)
        better = (far < best[at]) | ((far == best[at]) & (chosen < number[at]))
        best[at[better]], number[at[better]] = far[better], chosen[better]
        taken += len(at)
        below[live[lower]] -= 1
        above[live[~lower]] += 1
    return number, best, taken


def _points(batch: pa.RecordBatch, dim: int) -> np.ndarray:
    points = batch.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
    limit = int((2**62 // dim) ** 0.5) // 2
    if len(points) and (points.max() > limit or points.min() < -limit):
        raise ValueError(f"A component beyond {limit}: squared distances would not fit 64 bits.")
    return points


def _blocks(batches: Iterator[pa.RecordBatch], centroids: np.ndarray) -> Iterator[tuple]:
    for batch in batches:
        for at in range(0, batch.num_rows, _BLOCK):
            part = batch.slice(at, _BLOCK)
            points = _points(part, centroids.shape[1])
            yield part, points, *nearest_centroid(points, centroids)[:2]


def _moments(centroids: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(centroids), np.int64)
        sums = np.zeros_like(centroids)
        for _, points, number, _ in _blocks(batches, centroids):
            counts += np.bincount(number, minlength=len(centroids))
            order = np.argsort(number, kind="stable")
            held, first = np.unique(number[order], return_index=True)
            sums[held] += np.add.reduceat(points[order], first, axis=0)
        held = np.flatnonzero(counts)
        columns = {"cluster": held.astype(np.int32), "n": counts[held], "sums": list(sums[held])}
        types = {"cluster": pa.int32(), "n": pa.int64(), "sums": pa.list_(pa.int64())}
        yield pa.RecordBatch.from_pydict({c: pa.array(v, types[c]) for c, v in columns.items()})

    return task


def _moved(rows: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round."""
    parts = rows.select("vector").mapInArrow(_moments(centroids), "cluster int, n long, sums array<long>")
    cells = parts.select("cluster", "n", F.posexplode("sums").alias("place", "part"))
    total = F.sum(F.col("part").cast("decimal(38,0)")).alias("total")
    moved = centroids.copy()
    # As many rows as the centroids have components.
    for r in cells.groupBy("cluster", "place").agg(F.sum("n").alias("n"), total).collect():
        moved[r["cluster"], r["place"]] = int(r["total"]) // r["n"]
    return moved


def fit_centroids(rows: DataFrame, count: int = CENTROIDS, rounds: int = ROUNDS, salt: int = SALT) -> np.ndarray:
    """Centroids over whole_vectors after so many rounds; a row each."""
    centroids = _first_centroids(rows, count, salt)
    for _ in range(rounds if len(centroids) else 0):
        moved = _moved(rows, centroids)
        if (moved == centroids).all():
            break  # further rounds would change nothing
        centroids = moved
    return centroids


def assign(rows: DataFrame, centroids: np.ndarray) -> DataFrame:
    """vec_id, cluster and squared distance of every one of the whole_vectors."""
    schema = "vec_id long, cluster int, distance long"
    if not len(centroids):
        return rows.sparkSession.createDataFrame([], schema)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, _, number, best in _blocks(batches, centroids):
            columns = [part.column("vec_id"), pa.array(number, pa.int32()), pa.array(best, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "cluster", "distance"])

    return rows.mapInArrow(task, schema)


def clustered(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of every vector."""
    rows = written(whole_vectors(vectors, vec_id, vector))
    centroids = fit_centroids(rows)
    found = written(assign(rows, centroids))
    # A row for each centroid.
    sums = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()
    inertia = {r["cluster"]: int(r["s"]) for r in sums}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    told = [(k, inertia.get(k, 0), sum(inertia.values()), d) for k, d in enumerate(digest)]
    schema = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    return found.join(F.broadcast(vectors.sparkSession.createDataFrame(told, schema)), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )
