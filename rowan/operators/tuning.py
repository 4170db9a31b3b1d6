"""Random search over the families' settings, scored by cross-validated F1."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from contextlib import ExitStack
from functools import reduce
from typing import Any

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowan.operators.cv import (
    FOLD,
    FOLDS_AT_ONCE,
    PARALLELISM,
    fold_frame,
    fold_preprocessors,
    in_parallel,
    labelled,
    tasks_for,
)
from rowan.operators.features import FEATURES
from rowan.operators.forests import Trees, forest_confusion, largest
from rowan.operators.learners import LABEL, WEIGHT, build_estimator
from rowan.operators.metrics import rates
from rowan.operators.split import Folds
from rowan.operators.stacked import StackedFit, fit_stacked, stacked_confusion
from rowan.spec import DatasetSpec

# The search space.
C_RANGE = (0.01, 10.0)
FOREST_SPACE: dict[str, tuple[Any, ...]] = {
    "n_estimators": (50, 100, 200, 300),
    "max_depth": (4, 6, 8, 10, None),
    "min_samples_leaf": (1, 2, 4, 8),
}
TRIAL_ITERATIONS = 2000


def sample_trials(family: str, num_samples: int, seed: int) -> list[dict[str, Any]]:
    """Seeded draws: ``C`` log-uniform, the forest's settings uniform over their lists."""
    if family == "logistic_regression":
        rng = np.random.default_rng([seed, 0])
        low, high = (math.log(bound) for bound in C_RANGE)
        return [{"C": math.exp(c)} for c in rng.uniform(low, high, num_samples)]
    if family == "random_forest":
        rng = np.random.default_rng([seed, 1])
        return [
            {name: options[rng.integers(len(options))] for name, options in FOREST_SPACE.items()}
            for _ in range(num_samples)
        ]
    raise ValueError(f"Unknown model: {family}")


def _stacked_scores(
    frames: Mapping[int, tuple[DataFrame, DataFrame, int]],
    trials: Sequence[Mapping[str, Any]],
    width: int,
    tasks: int,
) -> list[tuple[int, int, float]]:
    """All logistic trials of all given folds in one solver: confusion counts by fold and trial."""
    asked = [(fold, i) for fold in frames for i in range(len(trials))]
    fits = [StackedFit(fold, trials[i]["C"], TRIAL_ITERATIONS) for fold, i in asked]

    def side(k: int) -> DataFrame:
        # Folds have slots of their own; only labels, weights and vectors are read.
        parts = [
            frame[k].select(F.lit(fold).alias(FOLD), LABEL, WEIGHT, FEATURES)
            for fold, frame in frames.items()
        ]
        return reduce(DataFrame.unionByName, parts)

    points = fit_stacked(side(0), F.col(FOLD), fits, width, tasks)
    return _scored(stacked_confusion(side(1), F.col(FOLD), fits, points), asked)


def _forest_scores(
    fold: int,
    frame: tuple[DataFrame, DataFrame, int],
    settings: Mapping[str, Any],
    trials: Sequence[Mapping[str, Any]],
    width: int,
    seed: int,
) -> list[tuple[int, int, float]]:
    """All trials of a fold and leaf size from one forest, which is dropped afterwards."""
    fitting, held_out, n = frame
    leaf = settings["min_samples_leaf"]
    own = [i for i, t in enumerate(trials) if t["min_samples_leaf"] == leaf]
    data = labelled(fitting)
    trees = Trees.of(data.sparkSession, build_estimator("random_forest", settings, n, seed).fit(data))
    counted = forest_confusion(held_out, {leaf: trees}, [trials[i] for i in own], width)
    return _scored(counted, [(fold, i) for i in own])


def forests_at_once(tasks: int, slots: int, parallelism: int) -> int:
    """Forests in flight: one has its rows, with a node and a weight for each tree, in the executors and its
    trees in the driver, so no more than keep all slots busy while others wait for the driver."""
    return max(1, min(parallelism, max(2, -(-3 * slots // tasks))))


def _scored(counts: DataFrame, asked: Sequence[tuple[int, int]]) -> list[tuple[int, int, float]]:
    """(fold, trial, f1) for every fit counted."""
    f1 = rates(*[F.col(c) for c in ("tp", "fp", "fn", "tn")])["f1"]
    return [(*asked[r["fit"]], r["f1"]) for r in counts.select("fit", f1.alias("f1")).collect()]


def run_trials(
    train: DataFrame,
    spec: DatasetSpec,
    families: Mapping[str, Mapping[str, Any]],
    folds: Folds,
    columns: list[str],
    num_samples: int,
    seed: int,
    parallelism: int = PARALLELISM,
    folds_at_once: int = FOLDS_AT_ONCE,
    max_categories: int | None = None,
) -> tuple[DataFrame, dict[str, list[dict[str, Any]]]]:
    """Mean and population deviation of F1 per trial: (model, trial, f1_mean, f1_std), and the
    sampled settings.

    Trials share their work: statistics of all folds come from common passes, all logistic trials of
    the folds held side by side from one solver, and a fold's forests of one leaf size from one forest.
    """
    trials = {f: sample_trials(f, num_samples, seed) for f in families}
    preprocessors = fold_preprocessors(train, spec, folds, columns, max_categories)
    scores: list[tuple[str, int, int, float]] = []
    for first in range(0, folds.k, max(1, folds_at_once)):
        group = list(range(first, min(folds.k, first + max(1, folds_at_once))))
        with ExitStack() as held:
            frames = {
                j: held.enter_context(fold_frame(train, folds, j, preprocessors[j])) for j in group
            }
            # Fill the caches once, before the trials start side by side.
            sizes = in_parallel(lambda j: frames[j][0].first()[FEATURES].size, group, parallelism)
            in_parallel(lambda j: frames[j][0].count(), group, parallelism)
            width, rows = max(sizes), sum(folds.sizes.values())
            # The solver's many short passes go first, and the small leaves' forests: they run longest.
            work: list[tuple[str, Any]] = []
            if "logistic_regression" in trials:
                work.append(("logistic_regression", None))
            solvers = len(work)
            if "random_forest" in trials:
                grown = sorted(largest(trials["random_forest"]).items())
                work += [("random_forest", (j, settings)) for _, settings in grown for j in group]

            def score(item: tuple[str, Any]) -> list[tuple[str, int, int, float]]:
                family, asked = item
                if family == "logistic_regression":
                    tasks = len(group) * tasks_for(rows)
                    found = _stacked_scores(frames, trials[family], width, tasks)
                else:
                    j, settings = asked
                    found = _forest_scores(j, frames[j], settings, trials[family], width, seed)
                return [(family, trial, fold, f1) for fold, trial, f1 in found]

            slots = train.sparkSession.sparkContext.defaultParallelism
            at_once = solvers + forests_at_once(tasks_for(rows), slots, parallelism)
            scores += [row for part in in_parallel(score, work, min(parallelism, at_once)) for row in part]
    spark = train.sparkSession
    per_fold = spark.createDataFrame(scores, "model string, trial int, fold int, f1 double")
    per_trial = per_fold.groupBy("model", "trial").agg(
        F.avg("f1").alias("f1_mean"), F.stddev_pop("f1").alias("f1_std")
    )
    return per_trial, trials


def apply_tuned(
    models: Mapping[str, Mapping[str, Any]], tuned: Mapping[str, Mapping[str, Any]]
) -> dict[str, dict[str, Any]]:
    """A copy of the settings with the named families' winners filled in."""
    return {f: {**params, **tuned.get(f, {})} for f, params in models.items()}
