from __future__ import annotations

import numpy as np
import pytest

from rowan.llm.ann import DEGREE, build_graph, build_index, nearest

SCHEMA = "vec_id long, embedding array<float>, label int, dim int, shard int, node int, members int"


def frame(spark, rows):
    clean = [(i, None if v is None else [None if x is None else float(x) for x in v], 0, 1, 2, 3, 4) for i, v in rows]
    return spark.createDataFrame(clean, SCHEMA).repartition(3)


def plain(rows, queries, most):
    out = {}
    for q, v in queries:
        scores = sorted(
            (-float(np.dot(np.array(v, np.float32).astype(float), np.array(x, np.float32).astype(float))), i)
            for i, x in rows
            if i != q and len(x) == len(v)
        )
        out[q] = [(i, -s) for s, i in scores[:most]]
    return out


def asked(found):
    out: dict[int, list] = {}
    for r in sorted(found.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append(r)
        assert r["rank"] == len(out[r["query_id"]])
    return out


@pytest.mark.parametrize("scale", [False, True])
def test_recall_against_brute_force(spark, scale):
    draw = np.random.default_rng(1)
    points = draw.normal(size=(3000, 16))
    points /= np.linalg.norm(points, axis=1)[:, None]
    if scale:  # inner products, not angles
        points *= draw.uniform(0.2, 3, (3000, 1))
    rows = [(i, p) for i, p in enumerate(points)]
    table = frame(spark, rows)
    got = asked(nearest(build_index(table, 20), table.where("vec_id % 50 = 0"), 20))
    want = plain(rows, [r for r in rows if r[0] % 50 == 0], 20)
    hits = sum(len({i for i, _ in want[q]} & {r["vec_id"] for r in got[q]}) for q in want)
    assert set(got) == set(want) and all(len(x) == 20 for x in got.values())
    assert hits >= 0.95 * 20 * len(want)
    score = {(q, i): s for q, x in want.items() for i, s in x}
    for q, x in got.items():
        for r in x:
            if (q, r["vec_id"]) in score:
                assert abs(score[q, r["vec_id"]] - r["score"]) < 1e-12


def test_copies_tie_to_smaller_ids(spark):
    rows = [(i, [1.0, 0.0]) for i in range(200)] + [(500 + i, [0.5, 0.1 * i]) for i in range(5)]
    table = frame(spark, rows)
    got = asked(nearest(build_index(table, 20), table.where("vec_id IN (0, 3, 500)"), 20))
    for q, x in got.items():
        assert [r["vec_id"] for r in x] == [i for i in range(22) if i != q][:20]


def test_distinct_vectors_that_tie_come_by_id(spark):
    ids = np.random.default_rng(2).permutation(100)
    rows = [(int(i), [1.0, 0.01 * k]) for k, i in enumerate(ids)] + [(100, [1.0, 0.0])]
    table = spark.createDataFrame([(i, v) for i, v in rows], "vec_id long, embedding array<double>")
    got = asked(nearest(build_index(table, 20), spark.createDataFrame([(1000, [1.0, 0.0])], table.schema), 20))
    assert [(r["vec_id"], r["score"]) for r in got[1000]] == [(i, 1.0) for i in range(20)]


@pytest.mark.parametrize("unit", [1.0, 1e200, 1e-200])
def test_double_vectors_are_scored_as_given(spark, unit):
    rows = [(i, [unit * (1 + i * 1e-10), unit * 0.5]) for i in range(100)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = asked(nearest(build_index(table, 20), spark.createDataFrame([(1000, [1.0, 0.0])], table.schema), 20))
    assert [(r["vec_id"], r["score"]) for r in got[1000]] == [(i, rows[i][1][0]) for i in range(99, 79, -1)]


def test_awkward_vectors_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    odd = [None, [0.0, 0.0], [nan, 1], [inf, 1], [None, 1], []]
    rows = [(100 + k, v) for k, v in enumerate(odd)] + [(None, [1.0, 1.0])]
    sound = [(0, [1.0, 2.0]), (1, [2.0, 1.0]), (1, [2.0, 1.0]), (2, [-1.0, 0.0]), (3, [1.0, 2.0, 3.0])]
    table = frame(spark, rows + sound)
    got = asked(nearest(build_index(table, 5), table, 5))
    want = plain(list({(i, tuple(v)) for i, v in sound}), sound, 5)
    assert {q: [(r["vec_id"], r["score"]) for r in x] for q, x in got.items()} == {q: x for q, x in want.items() if x}


def test_empty_tables(spark):
    table = frame(spark, [(0, [1.0, 2.0]), (1, [2.0, 1.0])])
    empty = table.limit(0)
    assert nearest(build_index(empty, 5), table, 5).count() == 0
    assert nearest(build_index(table, 5), empty, 5).count() == 0


@pytest.mark.parametrize("n", [1, 2, 5, 400])
def test_graphs_of_any_size_are_searchable(n):
    points = np.random.default_rng(n).normal(size=(n, 4)).astype(np.float32)
    graph = build_graph(points)
    assert graph.edges.shape == (n, DEGREE)
    assert not (graph.edges == np.arange(n)[:, None]).any()
    found, _ = graph.search(graph.points, 16)
    assert (found[:, 0] == np.arange(n)).mean() > 0.99
