"""Approximate nearest neighbours by largest inner product, on robust-pruned directed graphs.

Equal vectors become one node with the least ids that share it, so that copies cost nothing and tie
exactly. Nodes are dealt to shards by hash. A task builds a shard's graph: greedy searches propose
neighbours, relaxed distance pruning keeps diverse ones, edges are returned and pruned again. The index
is a table, one row for each node. Every block of queries meets every shard, beam search answers, and
the best of all shards are ranked on the original vectors in double precision.

Inner products become distances by one more component, the root of what a vector's squared length lacks
to the longest of its shard; distances order neighbours as inner products do.

A shard holds up to SHARD_ROWS nodes and a task one shard and one block of queries, however small or large
the table; shards are equal to a few nodes. The queries of one block are not collected but dealt out like
all rows. Every query asks every shard: work grows with queries times shards.

Graphs are built on single-precision copies, scaled to their shard; scores come from the vectors as given,
and vectors that are one in single precision share a node and are all scored.

Defined cases: vectors null, zero or with null or non-finite components take no part, nor do rows
without an id; only vectors of a query's own length are candidates; rows that repeat id and vector count
once; a query never finds rows of its own id; of nodes found that tie, those with smaller ids come first;
with fewer candidates than asked for all found are given; an empty table or query set gives an empty
result; further columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from rowan.sources.scratch import written

SHARD_ROWS = 20_000
BLOCK_QUERIES = 10_000
DEGREE = 32
BUILD_BEAM = 64
SEARCH_BEAM = 128
RELAX = 1.2
#: Nodes expanded in a round of a search, and entries of the visited table at a time.
WIDTH = 4
_VISITED = 16_000_000
_NODES = "dim int, shard int, node int, vector array<{}>, members array<long>, neighbours array<int>"
_FOUND = "query_id long, query long, vec_id long, score double"


@dataclass
class _Graph:
    """points: vectors with the component that makes inner products distances. edges: -1 where none."""

    points: np.ndarray
    edges: np.ndarray
    entries: np.ndarray

    def search(self, wanted: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """The beam's nodes for each wanted point, nearest first, and their distances; -1 where none."""
        step = max(1, _VISITED // max(1, len(self.points)))
        parts = [self._search(wanted[a : a + step], beam) for a in range(0, len(wanted), step)]
        return tuple(np.concatenate(x) for x in zip(*parts, strict=True))

    def _search(self, wanted: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        rows = np.arange(len(wanted))[:, None]
        seen = np.zeros((len(wanted), len(self.points) + 1), bool)
        seen[:, -1] = True
        nodes = np.full((len(wanted), beam), -1, np.int32)
        far = np.full((len(wanted), beam), np.inf, np.float32)
        closed = np.ones((len(wanted), beam), bool)
        fresh = np.broadcast_to(self.entries, (len(wanted), len(self.entries)))
        norms = (wanted**2).sum(1)[:, None]
        while True:
            fresh = np.where(seen[rows, fresh], -1, fresh)
            ordered = np.sort(fresh, axis=1)  # a node proposed twice counts once
            fresh = np.where(np.pad(ordered[:, 1:] == ordered[:, :-1], ((0, 0), (1, 0))), -1, ordered)
            seen[rows, fresh] = True
            near = self._square[fresh] - 2 * np.einsum("bd,brd->br", wanted, self.points[fresh]) + norms
            near[fresh < 0] = np.inf
            nodes = np.concatenate([nodes, fresh], axis=1)
            far = np.concatenate([far, near], axis=1)
            closed = np.concatenate([closed, fresh < 0], axis=1)
            best = np.argpartition(far, beam - 1, axis=1)[:, :beam]
            nodes, far, closed = nodes[rows, best], far[rows, best], closed[rows, best]
            open_far = np.where(closed, np.inf, far)
            if np.isinf(open_far).all():
                order = np.argsort(far, axis=1, kind="stable")
                return nodes[rows, order], far[rows, order]
            chosen = np.argpartition(open_far, min(WIDTH, beam) - 1, axis=1)[:, :WIDTH]
            dead = np.isinf(open_far[rows, chosen])
            closed[rows, chosen] = True
            fresh = self.edges[nodes[rows, chosen]]
            fresh[dead] = -1
            fresh = fresh.reshape(len(wanted), -1)

    def __post_init__(self) -> None:
        self._square = (self.points**2).sum(1)

    def pruned(self, at: np.ndarray, candidates: np.ndarray) -> np.ndarray:
        """For each node `at`, up to DEGREE of its candidates (-1: none): the nearest, unless one already
        kept is RELAX times nearer to it."""
        points = self.points[candidates]
        own = self.points[at]
        far = self._square[candidates] - 2 * np.einsum("bd,bcd->bc", own, points) + self._square[at][:, None]
        far[(candidates < 0) | (candidates == at[:, None])] = np.inf
        order = np.argsort(far, axis=1, kind="stable")
        rows = np.arange(len(at))[:, None]
        candidates, far, points = candidates[rows, order], far[rows, order], points[rows, order]
        square = self._square[candidates]
        between = square[:, :, None] + square[:, None, :] - 2 * points @ points.transpose(0, 2, 1)
        kept = np.full((len(at), DEGREE), -1, np.int32)
        alive, line = np.isfinite(far), np.arange(len(at))
        for k in range(DEGREE):
            first = alive.argmax(1)
            live = alive[line, first]
            if not live.any():
                break
            kept[live, k] = candidates[live, first[live]]
            covered = RELAX * RELAX * between[line, first] <= far
            alive &= ~(covered & live[:, None])
            alive[line, first] = False
        return kept


def _scaled(vectors: np.ndarray, axis: int | None = None) -> np.ndarray:
    """In single precision, over a power of two near the largest component (of each row, or of all): order
    stays as it was, and what single precision tells apart stays apart."""
    _, power = np.frexp(np.abs(vectors).max(axis=axis, keepdims=True))
    return np.ldexp(vectors, -power).astype(np.float32)


def _points(vectors: np.ndarray) -> np.ndarray:
    """With the component that makes inner products distances."""
    single = _scaled(vectors)
    square = (single.astype(np.float64) ** 2).sum(1)
    lack = np.sqrt(np.maximum(square.max() - square, 0)).astype(np.float32)
    return np.concatenate([single, lack[:, None]], axis=1)


def build_graph(vectors: np.ndarray, seed: int = 7) -> _Graph:
    """A graph over distinct vectors."""
    n = len(vectors)
    points = _points(vectors)
    draw = np.random.default_rng(seed)
    edges = draw.integers(0, n, (n, DEGREE), dtype=np.int32)
    edges[edges == np.arange(n)[:, None]] = -1
    middle = int(((points - points.mean(0)) ** 2).sum(1).argmin())
    entries = np.unique(np.append(draw.integers(0, n, 7), middle)).astype(np.int32)
    graph = _Graph(points, edges, entries)
    for at in np.array_split(draw.permutation(n), max(1, n // 256)):
        found, _ = graph.search(points[at], BUILD_BEAM)
        edges[at] = graph.pruned(at, np.concatenate([found, edges[at]], axis=1))
        _return_edges(graph, at)
    return graph


def _return_edges(graph: _Graph, at: np.ndarray) -> None:
    """Each new edge's end points back to its start; where there is no room, pruning decides."""
    ends = graph.edges[at].ravel()
    starts = np.repeat(at, DEGREE)[ends >= 0].astype(np.int32)
    ends = ends[ends >= 0]
    if not len(ends):
        return
    order = np.argsort(ends, kind="stable")
    ends, starts = ends[order], starts[order]
    nodes, first, counts = np.unique(ends, return_index=True, return_counts=True)
    place = np.arange(len(ends)) - np.repeat(first, counts)
    offered = np.full((len(nodes), counts.max()), -1, np.int32)
    offered[np.repeat(np.arange(len(nodes)), counts), place] = starts
    both = np.concatenate([graph.edges[nodes], offered], axis=1)
    both.sort(axis=1)
    both[:, 1:][both[:, 1:] == both[:, :-1]] = -1
    for part in np.array_split(np.arange(len(nodes)), max(1, both.size // 200_000)):
        graph.edges[nodes[part]] = graph.pruned(nodes[part], both[part])


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    lists = column.combine_chunks()
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


def _indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One shard's nodes with their neighbours, a graph for each length of vectors."""
    held = [b for b in batches if b.num_rows]
    if not held:
        return
    shard = pa.Table.from_batches(held)
    for dim in shard.column("dim").unique():
        table = shard.filter(pc.equal(shard.column("dim"), dim))
        table = table.sort_by([("least", "ascending"), ("print", "ascending")])
        vectors = _matrix(table.column("vector"))
        _, first, point = np.unique(_scaled(vectors), axis=0, return_index=True, return_inverse=True)
        edges = [row[row >= 0] for row in build_graph(vectors[first]).edges]
        columns = {
            "dim": table.column("dim"),
            "shard": table.column("shard"),
            "node": pa.array(point.ravel(), pa.int32()),
            "vector": table.column("vector"),
            "members": table.column("members"),
            "neighbours": pa.array([edges[k] for k in point.ravel()], pa.list_(pa.int32())),
        }
        yield from pa.table(columns).to_batches(max_chunksize=4096)


def _kind(vectors: DataFrame, vector: str) -> str:
    kind = vectors.schema[vector].dataType
    return "float" if isinstance(kind, ArrayType) and isinstance(kind.elementType, FloatType) else "double"


def usable(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """vec_id, vector and dim of the rows that take part, each once. Components are floats or doubles."""
    numbers = F.transform(F.col(vector), lambda x: x.cast(_kind(vectors, vector)))
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), numbers.alias("vector"))

    def odd(x: Column) -> Column:
        return x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))

    sound = ~F.exists("vector", odd) & F.exists("vector", lambda x: x != 0)
    return rows.where(F.col("vec_id").isNotNull() & F.coalesce(sound, F.lit(False))).distinct().withColumn(
        "dim", F.size("vector")
    )


def build_index(vectors: DataFrame, most: int, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """The graph table: dim, shard, node, vector, members (the most + 1 least ids), neighbours."""
    rows = usable(vectors, vec_id, vector)
    # Only the first few of a group of copies pass the shuffle.
    same = Window.partitionBy("vector").orderBy("vec_id")
    few = rows.withColumn("n", F.row_number().over(same)).where(F.col("n") <= most + 1)
    nodes = written(few.groupBy("vector", "dim").agg(F.sort_array(F.collect_list("vec_id")).alias("members")))
    shards = max(1, math.ceil(nodes.count() / SHARD_ROWS))
    dealt = nodes.select(
        "dim",
        F.pmod(F.xxhash64("vector"), F.lit(shards)).cast("int").alias("shard"),
        "vector",
        "members",
        F.element_at("members", 1).alias("least"),
        F.xxhash64("vector").alias("print"),
    )
    # A task for each shard: graphs are slow to build, however few bytes they have.
    return dealt.repartitionById(shards, F.col("shard")).mapInArrow(
        _indexed, _NODES.format(_kind(vectors, vector))
    )


def _answered(most: int):
    def answer(key: tuple, nodes: pa.Table, asked: pa.Table) -> pa.Table:
        empty = {"query_id": [], "query": [], "vec_id": [], "score": []}
        if not len(nodes) or not len(asked):
            return pa.table(empty, schema=_FOUND_SCHEMA)
        nodes = nodes.sort_by("node")
        vectors, queries = _matrix(nodes.column("vector")), _matrix(asked.column("vector"))
        # Vectors that are one in single precision are one node of the graph.
        starts = np.unique(nodes.column("node").to_numpy(), return_index=True)[1]
        ends = np.append(starts[1:], len(vectors))
        graph = _graph_of(vectors[starts], nodes.column("neighbours").take(pa.array(starts)))
        wanted = np.concatenate([_scaled(queries, 1), np.zeros((len(queries), 1), np.float32)], axis=1)
        found, _ = graph.search(wanted, max(SEARCH_BEAM, 2 * most))
        members = nodes.column("members").to_pylist()
        least = np.array([m[0] for m in members])
        query_id, query = asked.column("query_id").to_pylist(), asked.column("query").to_pylist()
        out = []
        for k in range(len(queries)):
            at = found[k][found[k] >= 0]
            at = np.concatenate([np.arange(starts[j], ends[j]) for j in at])
            # Added up in order, in double precision.
            score = np.cumsum(queries[k].astype(np.float64) * vectors[at], axis=1)[:, -1] + 0.0
            # One node more than asked for: the query's own may hold nobody else.
            best = np.lexsort((least[at], -score))[: most + 1]
            own = [(-float(score[j]), m) for j in best for m in members[at[j]] if m != query_id[k]]
            out += [(query_id[k], query[k], m, -s) for s, m in sorted(own)[:most]]
        columns = zip(*out, strict=True) if out else empty.values()
        return pa.table(dict(zip(empty, map(list, columns), strict=True)), schema=_FOUND_SCHEMA)

    return answer


_FOUND_SCHEMA = pa.schema(
    [("query_id", pa.int64()), ("query", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())]
)


def _graph_of(vectors: np.ndarray, neighbours: pa.ChunkedArray) -> _Graph:
    lists = neighbours.combine_chunks()
    counts = np.diff(lists.offsets.to_numpy())
    edges = np.full((len(vectors), DEGREE), -1, np.int32)
    place = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    edges[np.repeat(np.arange(len(vectors)), counts), place] = lists.flatten().to_numpy()
    draw = np.random.default_rng(11).integers(0, len(vectors), 16)
    return _Graph(_points(vectors), edges, np.unique(draw).astype(np.int32))


def nearest(
    index: DataFrame, queries: DataFrame, most: int, vec_id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """query_id, rank, vec_id and score: the `most` nearest found of each query, ties to smaller ids."""
    asked = usable(queries, vec_id, vector).select(
        F.col("vec_id").alias("query_id"), F.xxhash64("vector").alias("query"), "vector", "dim"
    )
    asked = written(asked)
    blocks = max(1, math.ceil(asked.count() / BLOCK_QUERIES))
    last = index.agg(F.max("shard")).first()[0] or 0
    block = F.pmod(F.xxhash64("query_id", "query"), F.lit(blocks)).cast("int").alias("block")
    shard = F.explode(F.sequence(F.lit(0), F.lit(last))).alias("shard")
    sent = asked.select("query_id", "query", "vector", "dim", block, shard)
    nodes = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    key = ["dim", "shard", "block"]
    # As many tasks as meetings: these too take long for their bytes.
    tasks = (last + 1) * blocks
    met = nodes.repartition(tasks, *key).groupBy(*key).cogroup(sent.repartition(tasks, *key).groupBy(*key))
    found = met.applyInArrow(_answered(most), _FOUND)
    order = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
