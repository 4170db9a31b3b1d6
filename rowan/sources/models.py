"""Model persistence: Spark ML format for pipelines, a parameter table for networks."""

from __future__ import annotations

import json

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from rowan.operators.mlp import MLPModel, TrainingSummary
from rowan.operators.scoring import Scorer

PIPELINE_SUFFIX = ".pipeline"
NETWORK_SUFFIX = ".network"
_NETWORK_SCHEMA = "dims array<int>, parameters array<float>, dropout double, summary string"


def save_model(spark: SparkSession, model: Scorer, stem: str) -> str:
    """Write the model next to ``stem``; the suffix tells the kind."""
    if isinstance(model, MLPModel):
        path = stem + NETWORK_SUFFIX
        model.preprocessor.write().overwrite().save(f"{path}/preprocessor")
        summary = json.dumps(model.summary.as_dict()) if model.summary else None
        row = (list(model.dims), model.flat.tolist(), float(model.dropout), summary)
        network = spark.createDataFrame([row], _NETWORK_SCHEMA)
        network.write.mode("overwrite").parquet(f"{path}/network")
        return path
    path = stem + PIPELINE_SUFFIX
    model.write().overwrite().save(path)
    return path


def load_model(spark: SparkSession, path: str) -> Scorer:
    kind = path.rstrip("/")
    if kind.endswith(PIPELINE_SUFFIX):
        return PipelineModel.load(path)
    if kind.endswith(NETWORK_SUFFIX):
        row = spark.read.schema(_NETWORK_SCHEMA).parquet(f"{path}/network").first()
        return MLPModel(
            PipelineModel.load(f"{path}/preprocessor"),
            list(row["dims"]),
            np.array(row["parameters"], dtype=np.float32),
            row["dropout"],
            TrainingSummary(**json.loads(row["summary"])) if row["summary"] else None,
        )
    raise ValueError(f"Unsupported model artifact: {path}")
