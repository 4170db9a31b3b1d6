"""Many L2-penalised logistic regressions over one table, solved side by side.

Every row belongs to the fits of its fold. A pass over the table returns loss and gradient of all fits that
are still on their way, each at its own point; the driver holds the points and takes every fit one step
further, with a line search of its own. The number of passes is that of the slowest fit, however many there
are, and a fit takes the same steps alone or among others. Steps are Newton's where the second derivatives
of all fits, which tasks add up as well, take no more than HESSIAN_CELLS numbers; they are limited-memory
quasi-Newton steps, with more passes, where features are wider.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowan.operators.features import FEATURES
from rowan.operators.learners import LABEL, WEIGHT
from rowan.operators.sparse import SparseRows
from rowan.operators.sums import SCHEMA, summed, vector_row

MEMORY = 10
HESSIAN_CELLS = 2_000_000
TOLERANCE = 1e-7
# The line search: decrease and curvature that a step must bring, and how often it is tried.
DECREASE, CURVATURE, TRIES = 1e-4, 0.9, 40


@dataclass(frozen=True)
class StackedFit:
    """One regression: the fold whose rows it is fitted on, and its strength as ``logistic_regression``'s."""

    fold: int
    strength: float
    max_iter: int = 2000


class Descent:
    """Minimises a smooth function that somebody else evaluates at ``point``."""

    def __init__(self, curvature: np.ndarray, max_iter: int, tolerance: float = TOLERANCE) -> None:
        """``curvature`` guesses the second derivatives, for the first steps' scale."""
        self.point = np.zeros(len(curvature))
        self.best = self.point
        self.done = False
        self._curvature, self._tolerance, self._left = curvature, tolerance, max_iter
        self._value, self._slopes = np.inf, None
        self._pairs: deque[tuple[np.ndarray, np.ndarray, float]] = deque(maxlen=MEMORY)

    def _direction(self, hessian: np.ndarray | None) -> np.ndarray:
        if hessian is not None:
            return -np.linalg.solve(hessian, self._slopes)
        q, taken = self._slopes.copy(), []
        for s, y, inverse in reversed(self._pairs):
            a = inverse * (s @ q)
            q -= a * y
            taken.append(a)
        scale = 1.0
        if self._pairs:
            s, y, _ = self._pairs[-1]
            scale = (s @ y) / (y @ (y / self._curvature))
        q *= scale / self._curvature
        for (s, y, inverse), a in zip(self._pairs, reversed(taken), strict=True):
            q += s * (a - inverse * (y @ q))
        return -q

    def tell(self, value: float, slopes: np.ndarray, hessian: np.ndarray | None = None) -> None:
        """Value, gradient and perhaps second derivatives at ``point``; moves it, unless it ends there."""
        if self._slopes is not None:
            fell = self._slopes @ self._way
            if not value <= self._value + DECREASE * self._step * fell:
                self._high = self._step
            elif slopes @ self._way < CURVATURE * fell:
                self._low = self._step
            else:
                self._tries = TRIES
            if self._tries < TRIES:
                self._tries += 1
                if self._tries == TRIES:
                    # No step helps any more: rounding errors decide.
                    self.done = True
                    return
                middle = (self._low + self._high) / 2
                self._step = middle if np.isfinite(middle) else 2 * self._low
                self.point = self.best + self._step * self._way
                return
            s, y = self.point - self.best, slopes - self._slopes
            if s @ y > 0:
                self._pairs.append((s, y, 1.0 / (s @ y)))
        self.best, self._value, self._slopes = self.point, value, slopes
        if self._left == 0 or np.abs(slopes).max() <= self._tolerance:
            self.done = True
            return
        self._left -= 1
        self._way = self._direction(hessian)
        self._step, self._low, self._high, self._tries = 1.0, 0.0, np.inf, 0
        self.point = self.best + self._way


def _rows(batch: pa.RecordBatch, width: int):
    columns = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("fold", "y", "w"))
    return SparseRows.of(batch.column("x"), width, np.float64), *columns


def _curvatures(width: int, folds: Sequence[int]) -> Callable:
    """For every fold the weight of its rows, and weighted squares of each slot (the last for the constant)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros((len(folds), width + 2))
        for batch in batches:
            x, fold, _, w = _rows(batch, width)
            for k, f in enumerate(folds):
                own = np.where(fold == f, w, 0.0)
                if own.any():
                    out[k, 0] += own.sum()
                    out[k, 1:-1] += (x.squared().T @ own[:, None])[:, 0] / 4
                    out[k, -1] += own.sum() / 4
        yield vector_row(TaskContext.get().partitionId(), out.ravel())

    return run


def _slopes(points: np.ndarray, folds: np.ndarray, second: bool) -> Callable:
    """Loss and gradient of every fit, and second derivatives if wanted, summed over a task's rows."""
    width = points.shape[1] - 1
    bent = width + 1 if second else 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros((len(points), width + 2))
        curves = np.zeros((len(points), bent, bent))
        for batch in batches:
            x, fold, y, w = _rows(batch, width)
            for f in np.intersect1d(folds, fold):
                fits = np.flatnonzero(folds == f)
                own = np.where(fold == f, w, 0.0)[:, None]
                z = x @ points[fits, :-1].T + points[fits, -1]
                out[fits, 0] += (own * (np.logaddexp(0.0, z) - y[:, None] * z)).sum(0)
                # The probability, written so that it cannot overflow.
                p = np.exp(-np.logaddexp(0.0, -z))
                lack = own * (p - y[:, None])
                out[fits, 1:-1] += (x.T @ lack).T
                out[fits, -1] += lack.sum(0)
                if second:
                    wide = np.column_stack([x.dense(), np.ones(len(x))])
                    for k, spread in zip(fits, (own * p * (1 - p)).T, strict=True):
                        curves[k] += wide.T @ (wide * spread[:, None])
        whole = np.concatenate([out, curves.reshape(len(points), -1)], axis=1)
        yield vector_row(TaskContext.get().partitionId(), whole.ravel())

    return run


def _input(frame: DataFrame, fold: Column) -> DataFrame:
    return frame.select(
        fold.cast("int").alias("fold"),
        F.col(LABEL).cast("double").alias("y"),
        F.col(WEIGHT).cast("double").alias("w"),
        F.col(FEATURES).alias("x"),
    )


def fit_stacked(
    frame: DataFrame,
    fold: Column,
    fits: Sequence[StackedFit],
    width: int,
    tasks: int,
    tolerance: float = TOLERANCE,
) -> np.ndarray:
    """Coefficients of every fit, a row each, the constant last.

    ``frame`` is read once for every pass; ``tasks`` is not below its number of partitions. The penalty is
    on the given features and spares the constant; each fit's weights should add up to its rows.
    """
    rows = _input(frame, fold)
    folds = sorted({f.fold for f in fits})
    first = summed(rows.mapInArrow(_curvatures(width, folds), SCHEMA), tasks)
    sizes = np.zeros((len(folds), width + 2)) if first is None else first.reshape(len(folds), -1)
    weight = {f: size[0] for f, size in zip(folds, sizes, strict=True)}
    if not all(weight.values()):
        raise ValueError(f"No rows in folds {[f for f in folds if not weight[f]]}.")
    penalty = [np.append(np.full(width, 1.0 / (f.strength * weight[f.fold])), 0.0) for f in fits]
    ways = [
        Descent(sizes[folds.index(f.fold), 1:] / weight[f.fold] + p + 1e-12, f.max_iter, tolerance)
        for f, p in zip(fits, penalty, strict=True)
    ]
    second = len(fits) * (width + 1) ** 2 <= HESSIAN_CELLS
    while active := [k for k, way in enumerate(ways) if not way.done]:
        points = np.stack([ways[k].point for k in active])
        at = np.array([fits[k].fold for k in active])
        told = summed(rows.mapInArrow(_slopes(points, at, second), SCHEMA), tasks).reshape(len(active), -1)
        for k, sums in zip(active, told, strict=True):
            mean, point = sums / weight[fits[k].fold], ways[k].point
            slopes = mean[1 : width + 2] + penalty[k] * point
            hessian = None
            if second:
                hessian = mean[width + 2 :].reshape(width + 1, -1) + np.diag(penalty[k] + 1e-12)
            ways[k].tell(mean[0] + penalty[k] @ point**2 / 2, slopes, hessian)
    return np.stack([way.best for way in ways])


def stacked_confusion(frame: DataFrame, fold: Column, fits: Sequence[StackedFit], points: np.ndarray) -> DataFrame:
    """Every fit against the rows of its fold: (fit, tp, fp, fn, tn). Class 1 is the larger probability."""
    folds = np.array([f.fold for f in fits])
    width = points.shape[1] - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros((len(fits), 4), np.int64)
        for batch in batches:
            x, fold, y, _ = _rows(batch, width)
            for f in np.intersect1d(folds, fold):
                at = np.flatnonzero(folds == f)
                said = x @ points[at, :-1].T + points[at, -1] > 0
                out[at] += counts_of(said, y, fold == f)
        yield counts_batch(np.arange(len(fits)), out)

    schema = "fit int, tp bigint, fp bigint, fn bigint, tn bigint"
    return _input(frame, fold).mapInArrow(run, schema).groupBy("fit").agg(
        *[F.sum(c).alias(c) for c in ("tp", "fp", "fn", "tn")]
    )


def counts_of(said: np.ndarray, y: np.ndarray, own: np.ndarray) -> np.ndarray:
    """tp, fp, fn, tn for every column of ``said``, over the rows that are its ``own``."""
    true, own = (y == 1)[:, None], own[:, None]
    return np.stack([(own & (said == a) & (true == b)).sum(0) for a, b in ((1, 1), (1, 0), (0, 1), (0, 0))], axis=1)


def counts_batch(fits: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    columns = {"fit": pa.array(fits, pa.int32())}
    columns |= {c: pa.array(counts[:, k], pa.int64()) for k, c in enumerate(("tp", "fp", "fn", "tn"))}
    return pa.RecordBatch.from_pydict(columns)
