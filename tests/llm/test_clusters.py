from __future__ import annotations

import hashlib

import numpy as np
import pytest

from rowan.llm.clusters import clustered, nearest_centroid

SCHEMA = "vec_id long, embedding array<float>, label int, cluster int, distance int, vector int, place int"
COLUMNS = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def frame(spark, rows, kind="float"):
    clean = [(i, None if v is None else [None if x is None else float(x) for x in v], 0, 1, 2, 3, 4) for i, v in rows]
    return spark.createDataFrame(clean, SCHEMA.replace("float", kind)).repartition(3)


def plain(rows, count=8, rounds=10):
    """Every distance of every round, in Python's whole numbers."""
    rows = [(i, [int(x) for x in np.floor(1024 * np.array(v, np.float32).astype(float))]) for i, v in rows]
    named = [(hashlib.sha256(f"3:{i}".encode()).hexdigest(), v) for i, v in rows if i is not None]
    centroids = [v for _, v in sorted(named)[:count]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), k) for k, c in enumerate(centroids))

    for _ in range(rounds):
        held = {}
        for _, v in rows:
            held.setdefault(near(v)[1], []).append(v)
        for k, vs in held.items():
            centroids[k] = [sum(x) // len(vs) for x in zip(*vs, strict=True)]
    found = [(i, *near(v)[::-1]) for i, v in rows]
    inertia = [sum(d for _, c, d in found if c == k) for k in range(len(centroids))]
    prints = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted([(i, k, d, inertia[k], sum(inertia), prints[k]) for i, k, d in found], key=repr)


def told(result):
    assert result.columns == COLUMNS
    return sorted(map(tuple, result.collect()), key=repr)


def test_same_as_every_distance(spark):
    draw = np.random.default_rng(5)
    points = draw.normal(size=(400, 64)) + draw.integers(0, 4, (400, 1))
    rows = [(i, list(p)) for i, p in enumerate(points)] + [(i, list(points[i])) for i in range(0, 400, 3)]
    assert told(clustered(frame(spark, rows))) == plain(rows)


def test_equal_vectors_ties_and_empty_clusters(spark):
    # Six of the eight starts are copies: equal distances go to the smaller number and four stay empty.
    rows = [(i, [float(i % 2)] * 64) for i in range(60)] + [(100, [0.5] * 64)]
    assert told(clustered(frame(spark, rows))) == plain(rows)


def test_fewer_vectors_than_centroids_and_rows_without_id(spark):
    rows = [(1, [1.0] * 64), (2, [-1.0] * 64), (None, [0.25] * 64), (None, [0.25] * 64)]
    assert told(clustered(frame(spark, rows))) == plain(rows)


def test_awkward_vectors_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    sound = [(k, [k / 7.0] * 63 + [-k]) for k in range(12)]
    odd = [None, [], [1.0] * 63, [1.0] * 65, [1.0] * 63 + [None], [nan] + [1.0] * 63, [-inf] + [1.0] * 63]
    assert told(clustered(frame(spark, sound + [(50 + k, v) for k, v in enumerate(odd)]))) == plain(sound)


def test_empty_tables(spark):
    empty = frame(spark, [(1, [1.0] * 64)]).limit(0)
    assert told(clustered(empty)) == []
    assert told(clustered(frame(spark, [(None, [1.0] * 64)]))) == []


def test_too_large_numbers_raise(spark):
    with pytest.raises(Exception, match="would not fit"):
        clustered(frame(spark, [(1, [1e30] * 64)], "double")).collect()


@pytest.mark.parametrize("k", [1, 2, 50, 300])
def test_search_measures_few_centroids_and_misses_none(k):
    draw = np.random.default_rng(k)
    spread = draw.uniform(1, 3000, (2000, 1))
    points = (draw.normal(size=(2000, 24)) * spread + draw.integers(-9000, 9000, (2000, 1))).astype(np.int64)
    centroids = points[draw.integers(0, 2000, k)]
    number, far, taken = nearest_centroid(points, centroids)
    every = ((points[:, None] - centroids[None]) ** 2).sum(2)
    assert (number == every.argmin(1)).all() and (far == every.min(1)).all()
    assert k < 50 or taken < 0.3 * every.size


def test_search_at_the_largest_numbers():
    limit = int((2**62 // 64) ** 0.5) // 2
    points = np.full((4, 64), limit) * np.array([[1], [-1], [1], [-1]])
    points[2:, 0] -= 1
    number, far, _ = nearest_centroid(points, points[[1, 2, 0]])
    assert number.tolist() == [2, 0, 1, 0] and far.tolist() == [0, 0, 0, 1]
