"""Stratified cross-validation with fold-local fitting."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager
from multiprocessing.pool import ThreadPool
from typing import Any

from pyspark import StorageLevel
from pyspark.ml import Model, PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowan.operators.features import FEATURES, fit_folds
from rowan.operators.learners import (
    LABEL,
    WEIGHT,
    build_estimator,
    weight_column,
)
from rowan.operators.metrics import METRICS, classification_metrics
from rowan.operators.scoring import with_scores
from rowan.operators.split import Folds
from rowan.sources.scratch import written_for_now
from rowan.spec import DatasetSpec

FOLD = "__fold"
# Jobs a driver keeps in flight at once; the executors share the persisted fold.
PARALLELISM = 8
FOLDS_AT_ONCE = 5
# Rows a learner's task should at least have: its passes are many and short.
ROWS_PER_TASK = 20_000


def labelled(df: DataFrame) -> DataFrame:
    return df.select(FEATURES, LABEL, WEIGHT)


def packed(df: DataFrame, rows: int) -> DataFrame:
    """Neighbouring partitions together, until tasks are worth starting; never split or shuffled."""
    return df.coalesce(tasks_for(rows))


def tasks_for(rows: int) -> int:
    return max(1, -(-rows // ROWS_PER_TASK))


def fold_preprocessors(
    train: DataFrame,
    spec: DatasetSpec,
    folds: Folds,
    columns: list[str],
    max_categories: int | None = None,
) -> list[PipelineModel]:
    """Every fold's transformation, by statistics of its fitting rows only, from passes that all folds share."""
    marked = train.withColumn(FOLD, folds.fold)
    return fit_folds(marked, FOLD, folds.k, spec, columns, max_categories=max_categories)


@contextmanager
def fold_frame(
    train: DataFrame, folds: Folds, fold: int, preprocessor: PipelineModel
) -> Iterator[tuple[DataFrame, DataFrame, int]]:
    """The fold's fitting and held-out rows, transformed, and the number of the former.

    Both come from one table, written so that the many passes of the learners plan a scan and not the
    transformation, and held in memory for as long as there is room.
    """
    sizes = folds.training_sizes(fold)
    assembled = preprocessor.transform(train.withColumn(FOLD, folds.fold)).select(
        FEATURES, LABEL, FOLD, weight_column(sizes).alias(WEIGHT)
    )
    rows = sum(folds.sizes.values())
    with written_for_now(packed(assembled, rows)) as table:
        frame = packed(table, rows).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            held_out = F.col(FOLD) == fold
            yield frame.filter(~held_out), frame.filter(held_out), sum(sizes.values())
        finally:
            frame.unpersist()


def in_parallel(work: Callable[[Any], Any], items: list[Any], parallelism: int) -> list[Any]:
    """Run driver calls that start Spark jobs side by side."""
    if len(items) < 2 or parallelism < 2:
        return [work(item) for item in items]
    with ThreadPool(min(parallelism, len(items))) as pool:
        return pool.map(work, items, chunksize=1)


def over_folds(
    work: Callable[[int, int], list[Any]], folds: Folds, parallelism: int, at_once: int
) -> list[Any]:
    """Rows of every fold's work, in fold order; the jobs in flight are shared out to the folds.

    ``work`` takes the fold and the number of jobs it may keep in flight. ``at_once`` folds are
    held side by side: each takes the storage of a transformed table.
    """
    at_once = max(1, min(folds.k, parallelism, at_once))
    each = max(1, -(-parallelism // at_once))
    parts = in_parallel(lambda fold: work(fold, each), list(range(folds.k)), at_once)
    return [row for part in parts for row in part]


def fit_families(
    fitting: DataFrame,
    families: Mapping[str, Mapping[str, Any]],
    rows: int,
    seed: int,
    parallelism: int = PARALLELISM,
) -> dict[str, Model]:
    data = labelled(fitting)
    names = list(families)
    models = in_parallel(
        lambda f: build_estimator(f, families[f], rows, seed).fit(data), names, parallelism
    )
    return dict(zip(names, models, strict=True))


def cross_validate(
    train: DataFrame,
    spec: DatasetSpec,
    families: Mapping[str, Mapping[str, Any]],
    folds: Folds,
    columns: list[str],
    seed: int,
    parallelism: int = PARALLELISM,
    folds_at_once: int = FOLDS_AT_ONCE,
    max_categories: int | None = None,
) -> DataFrame:
    """Held-out scores as rows (model, fold, metric, value), unrounded."""
    preprocessors = fold_preprocessors(train, spec, folds, columns, max_categories)

    def scores(fold: int, jobs: int) -> list[tuple[str, int, str, float]]:
        with fold_frame(train, folds, fold, preprocessors[fold]) as (fitting, held_out, n):
            models = fit_families(fitting, families, n, seed, jobs)
            scored = with_scores(models, held_out, [LABEL])
            measured = classification_metrics(scored, ["model"], label=LABEL)
            # One row per family.
            return [(r["model"], fold, m, r[m]) for r in measured.collect() for m in METRICS]

    rows = over_folds(scores, folds, parallelism, folds_at_once)
    return train.sparkSession.createDataFrame(
        rows, "model string, fold int, metric string, value double"
    )

