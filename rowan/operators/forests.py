"""Scores of many forests from the trees of one.

A forest's first trees are a forest of fewer trees, and trees cut at a depth are the trees grown to that depth:
a split does not hang on what is grown below it. So one forest, grown to the largest depth and number of trees
asked for, answers every smaller depth and number: a row is sent down its trees once, the node it passes at
each depth tells its vote there, and running sums over the trees tell the vote of every number of them.

Driver and closures hold the trees of the forests in flight only: a forest's trials are counted as soon as it is
grown, and it is dropped then.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowan.operators.features import FEATURES
from rowan.operators.learners import DEEPEST, LABEL
from rowan.operators.sparse import SparseRows
from rowan.operators.stacked import counts_batch, counts_of
from rowan.sources.scratch import remove, shared_folder

# Rows sent down the trees at a time.
_BLOCK = 512


@dataclass
class Trees:
    """Binary classification trees as arrays over their nodes; -1 stands for no child.

    Held in the driver while its trials are counted and sent to every task, so kept narrow: under 40 bytes a node.
    """

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    # Shares of the classes, and the class of each node.
    votes: np.ndarray
    call: np.ndarray

    @classmethod
    def of(cls, spark: SparkSession, model: RandomForestClassificationModel) -> Trees:
        """Read back from the model as Spark ML writes it: as large as the model itself. Only numbers come
        over, in the types they are kept in, a list's cells as columns of their own."""
        path = f"{shared_folder(spark)}/rowan-forest-{uuid.uuid4().hex}"
        model.write().save(path)
        try:
            nodes = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*")
            told = nodes.select(
                F.col("treeID").cast("int"), F.col("id").cast("int"), F.col("prediction").cast("tinyint"),
                F.col("leftChild").cast("int"), F.col("rightChild").cast("int"),
                *[F.get("impurityStats", F.lit(c)).alias(f"class{c}") for c in (0, 1)],
                F.col("split.featureIndex").cast("int").alias("featureIndex"),
                F.get("split.leftCategoriesOrThreshold", F.lit(0)).alias("first"),
                F.col("split.numCategories").cast("int").alias("numCategories"),
            ).toArrow()
        finally:
            remove(spark, path)
        columns = {c: told[c].to_numpy() for c in told.column_names}
        del told
        order = np.lexsort([columns["id"], columns["treeID"]])
        columns = {c: columns[c][order] for c in list(columns)}
        tree = columns.pop("treeID")
        roots = np.unique(tree, return_index=True)[1].astype(np.int32)
        start = roots[tree]
        left, right = (columns.pop(c) for c in ("leftChild", "rightChild"))
        left, right = (np.where(c >= 0, c + start, np.int32(-1)) for c in (left, right))
        inner = left >= 0
        kinds = columns.pop("numCategories")
        if (kinds[inner] > 2).any():
            raise ValueError("Only numbers and two-valued categories can be split on.")
        threshold = np.where(inner, columns.pop("first"), 0.0)
        # A category that goes left: zeros go left of one half, or right.
        named = inner & (kinds == 2)
        swap = named & (threshold == 1)
        threshold[named] = 0.5
        left, right = np.where(swap, right, left), np.where(swap, left, right)
        stats = np.stack([columns.pop("class0"), columns.pop("class1")], axis=1)
        total = stats.sum(axis=1, keepdims=True)
        votes = np.divide(stats, total, out=np.zeros_like(stats), where=total != 0)
        return cls(roots, columns["featureIndex"], threshold, left, right, votes, columns["prediction"])

    def first(self, trees: int) -> Trees:
        return Trees(
            self.roots[:trees], self.feature, self.threshold, self.left, self.right, self.votes, self.call
        )

    def cut(self, depth: int) -> np.ndarray:
        """For every node down to ``depth`` the leaf it belongs to, or itself, in trees grown no deeper.

        As in growing, two leaves of one class under a node become one.
        """
        levels = [self.roots]
        while len(levels) <= depth and len(levels[-1]):
            inner = levels[-1][self.left[levels[-1]] >= 0]
            levels.append(np.concatenate([self.left[inner], self.right[inner]]))
        leaf, call = self.left < 0, self.call.copy()
        leaf[levels[-1]] = True
        for level in levels[-2::-1]:
            inner = level[~leaf[level]]
            a, b = self.left[inner], self.right[inner]
            same = inner[leaf[a] & leaf[b] & (call[a] == call[b])]
            leaf[same], call[same] = True, call[self.left[same]]
        home = np.arange(len(leaf), dtype=np.int32)
        for level in levels[:-1]:
            inner = level[self.left[level] >= 0]
            for child in (self.left[inner], self.right[inner]):
                home[child] = np.where(leaf[home[inner]], home[inner], child)
        return home

    def cuts(self, wanted: Sequence[tuple[int, int]]) -> dict[int, np.ndarray]:
        """``cut`` at every depth wanted: a pass over all nodes for each, whatever the rows."""
        return {d: self.cut(d) for d in {d for d, _ in wanted}}

    def calls(
        self,
        x: np.ndarray,
        wanted: Sequence[tuple[int, int]],
        homes: Mapping[int, np.ndarray] | None = None,
    ) -> np.ndarray:
        """Class 1 or not for every row, by every (depth, number of trees) wanted; ``homes`` are the
        ``cuts`` of these, for whoever calls more than once."""
        out = np.zeros((len(x), len(wanted)), bool)
        homes = self.cuts(wanted) if homes is None else homes
        for at in range(0, len(x), _BLOCK):
            block = x[at : at + _BLOCK]
            node = np.tile(self.roots, (len(block), 1))
            # Rows and trees, numbered on, that are not in a leaf yet: only these go down.
            seen = node.ravel()
            going = np.flatnonzero(self.left[seen] >= 0)
            for depth in range(max(homes) + 1):
                if depth in homes:
                    running = self.votes[homes[depth][node]].cumsum(axis=1)
                    for k, (d, trees) in enumerate(wanted):
                        if d == depth:
                            out[at : at + _BLOCK, k] = running[:, trees - 1, 1] > running[:, trees - 1, 0]
                if len(going):
                    here = seen[going]
                    down = block[going // len(self.roots), self.feature[here]] <= self.threshold[here]
                    seen[going] = here = np.where(down, self.left[here], self.right[here])
                    going = going[self.left[here] >= 0]
        return out


def shape_of(settings: Mapping[str, Any]) -> tuple[int, int]:
    """Depth and number of trees."""
    depth = settings["max_depth"]
    return DEEPEST if depth is None else int(depth), int(settings["n_estimators"])


def largest(trials: Sequence[Mapping[str, Any]]) -> dict[int, dict[str, Any]]:
    """By leaf size the settings of one forest that answers all trials with it."""
    out: dict[int, dict[str, Any]] = {}
    for t in trials:
        depth, trees = shape_of(t)
        held = out.setdefault(t["min_samples_leaf"], {"max_depth": 0, "n_estimators": 0})
        held["max_depth"] = max(held["max_depth"], depth)
        held["n_estimators"] = max(held["n_estimators"], trees)
    return {leaf: {**held, "min_samples_leaf": leaf} for leaf, held in out.items()}


def _counts(grown: Mapping[int, Trees], trials: Sequence[Mapping[str, Any]], width: int) -> Callable:
    """Confusion counts of every trial's forest, summed over a task's rows."""
    asked = {
        leaf: [k for k, t in enumerate(trials) if t["min_samples_leaf"] == leaf] for leaf in grown
    }
    wanted = {leaf: [shape_of(trials[k]) for k in places] for leaf, places in asked.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros((len(trials), 4), np.int64)
        # Once for the task: trees grow with the table, as the number of blocks does.
        homes = {leaf: grown[leaf].cuts(wanted[leaf]) for leaf in asked}
        for batch in batches:
            y = batch.column("y").to_numpy(zero_copy_only=False)
            rows = SparseRows.of(batch.column("x"), width, np.float64)
            for at in range(0, len(y), _BLOCK):
                x = rows[at : at + _BLOCK].dense()
                part = y[at : at + _BLOCK]
                for leaf, places in asked.items():
                    said = grown[leaf].calls(x, wanted[leaf], homes[leaf])
                    out[places] += counts_of(said, part, np.ones(len(part), bool))
        yield counts_batch(np.arange(len(trials)), out)

    return run


def forest_confusion(
    held_out: DataFrame, grown: Mapping[int, Trees], trials: Sequence[Mapping[str, Any]], width: int
) -> DataFrame:
    """Every trial's forest against all rows: (fit, tp, fp, fn, tn), ``fit`` being the trial's place."""
    rows = held_out.select(F.col(LABEL).cast("double").alias("y"), F.col(FEATURES).alias("x"))
    counted = rows.mapInArrow(_counts(grown, trials, width), "fit int, tp bigint, fp bigint, fn bigint, tn bigint")
    return counted.groupBy("fit").agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn", "tn")])
