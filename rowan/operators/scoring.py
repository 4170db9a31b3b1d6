"""Scoring with fitted models: map-only, no shuffle."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml import Model, PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowan.functions.scores import at_least, positive_probability
from rowan.functions.text import column
from rowan.operators.learners import PREDICTION, PROBABILITY, RAW
from rowan.operators.mlp import MLPModel
from rowan.spec import DatasetSpec

Scorer = PipelineModel | MLPModel

_SCORE, _CLASS = "__score", "__class"


def _scored(
    model: Model | MLPModel, features: DataFrame, threshold: float | None = None
) -> DataFrame:
    """Add ``__score`` and ``__class`` to a table the model can read.

    Without a threshold a pipeline model predicts its larger class (a tie is class 0) and a
    network uses an inclusive 0.5.
    """
    if isinstance(model, MLPModel):
        scored = model.probability(features, _SCORE)
        predicted: Column = at_least(F.col(_SCORE), 0.5 if threshold is None else threshold)
        return scored.withColumn(_CLASS, predicted)
    probability = positive_probability(F.col(PROBABILITY))
    predicted = (
        F.col(PREDICTION).cast("int") if threshold is None else at_least(probability, threshold)
    )
    scored = model.transform(features).withColumns({_SCORE: probability, _CLASS: predicted})
    return scored.drop(RAW, PROBABILITY, PREDICTION)


def with_scores(
    models: Mapping[str, Model | MLPModel], features: DataFrame, keep: list[str]
) -> DataFrame:
    """Score assembled rows with several models in one scan.

    Gives rows (keep..., model, probability, prediction).
    """
    scored = features
    cells = []
    for i, (name, model) in enumerate(models.items()):
        scored = _scored(model, scored).withColumnsRenamed(
            {_SCORE: f"__p{i}", _CLASS: f"__c{i}"}
        )
        cells.append(
            F.struct(
                F.lit(name).alias("model"),
                F.col(f"__p{i}").alias("probability"),
                F.col(f"__c{i}").alias("prediction"),
            )
        )
    return scored.select(*keep, F.explode(F.array(*cells)).alias("s")).select(*keep, "s.*")


def score(
    model: Scorer, df: DataFrame, spec: DatasetSpec, threshold: float | None = None
) -> DataFrame:
    """Append the positive-class probability and the predicted class to every raw row.

    Nothing is rejected: unknown categories and unreadable numbers take the fitted defaults.
    Key and target are not read, so they may be absent.
    """
    features = model.preprocessor.transform(df) if isinstance(model, MLPModel) else df
    scored = _scored(model, features, threshold)
    added = {spec.probability_name: _SCORE, spec.prediction_name: _CLASS}
    return scored.select(
        *[column(c) for c in df.columns if c not in added],
        *[F.col(private).alias(name) for name, private in added.items()],
    )
