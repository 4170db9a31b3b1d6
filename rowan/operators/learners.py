"""Class-weighted logistic regression and random forest on assembled features."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.ml import Estimator
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from rowan.functions.scores import first_match
from rowan.operators.features import FEATURES

LABEL = "__label"
WEIGHT = "__weight"
RAW, PROBABILITY, PREDICTION = "__raw", "__probability", "__prediction"

# Family names in reporting order and their default settings.
FAMILIES = ("logistic_regression", "random_forest")
NETWORK = "torch_mlp"
DEFAULTS: dict[str, dict[str, Any]] = {
    "logistic_regression": {"enabled": True, "C": 1.0, "max_iter": 2000},
    "random_forest": {
        "enabled": True, "n_estimators": 200, "max_depth": 8, "min_samples_leaf": 2,
    },
}
# MLlib grows no deeper trees; it stands for "unlimited".
DEEPEST = 30


def class_counts(df: DataFrame, label: str = LABEL) -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def class_weights(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Balanced weight per class: (label, n, weight); one row per class."""
    classes = W.partitionBy(F.lit(0))
    counts = class_counts(df, label)
    total, present = F.sum("n").over(classes), F.count(F.lit(1)).over(classes)
    return counts.withColumn("weight", total / (present * F.col("n")))


def balanced_weights(sizes: Mapping[str, int]) -> dict[str, float]:
    """``n / (classes * n_class)`` from the rows being fitted."""
    n = sum(sizes.values())
    return {c: n / (len(sizes) * size) for c, size in sizes.items() if size}


def weight_column(sizes: Mapping[str, int], label: str = LABEL) -> Column:
    text = F.col(label).cast("string")
    weights = balanced_weights(sizes).items()
    return first_match([(text == c, F.lit(w)) for c, w in weights], None)


def positive_weight(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Negatives per positive, 1 when there are no positives: one row."""
    y = F.col(label)
    return df.agg(
        F.coalesce(F.try_divide(F.sum(1 - y), F.sum(y)), F.lit(1.0)).alias("pos_weight")
    )


def _columns() -> dict[str, str]:
    return {
        "featuresCol": FEATURES,
        "labelCol": LABEL,
        "weightCol": WEIGHT,
        "rawPredictionCol": RAW,
        "probabilityCol": PROBABILITY,
        "predictionCol": PREDICTION,
    }


def logistic_regression(params: Mapping[str, Any], rows: int, tol: float = 1e-6) -> Estimator:
    """L2 with a free intercept. Balanced weights add up to the row count, so the strength ``C``
    against the summed loss becomes ``1 / (C * rows)`` against the mean loss; the penalty is on
    the given features, hence no second standardisation."""
    return LogisticRegression(
        **_columns(),
        regParam=1.0 / (params.get("C", 1.0) * max(rows, 1)),
        elasticNetParam=0.0,
        standardization=False,
        maxIter=int(params.get("max_iter", 2000)),
        tol=tol,
    )


def random_forest(params: Mapping[str, Any], seed: int) -> Estimator:
    depth = params.get("max_depth", 8)
    if depth is not None and int(depth) > DEEPEST:
        raise ValueError(f"max_depth {depth}: trees grow no deeper than {DEEPEST}.")
    return RandomForestClassifier(
        **_columns(),
        numTrees=int(params.get("n_estimators", 200)),
        maxDepth=DEEPEST if depth is None else int(depth),
        minInstancesPerNode=int(params.get("min_samples_leaf", 2)),
        impurity="gini",
        featureSubsetStrategy="sqrt",
        bootstrap=True,
        maxBins=128,
        # Room for the statistics of many tree nodes per pass: fewer passes over the data.
        maxMemoryInMB=1024,
        # Rows keep the node they reached in each tree and do not go down from its root at every level;
        # the trees are the same.
        cacheNodeIds=True,
        seed=seed,
    )


def build_estimator(
    family: str, params: Mapping[str, Any], rows: int, seed: int
) -> Estimator:
    if family == "logistic_regression":
        return logistic_regression(params, rows)
    if family == "random_forest":
        return random_forest(params, seed)
    raise ValueError(f"Unknown model: {family}")


def candidates(models: Mapping[str, Mapping[str, Any]] | None = None) -> dict[str, dict[str, Any]]:
    """Enabled families with their full settings, in reporting order."""
    given = models or {}
    merged = {f: {**DEFAULTS[f], **given.get(f, {})} for f in FAMILIES}
    return {f: p for f, p in merged.items() if p["enabled"]}
