"""Batch scoring flow: load a model, read rows, append scores, write."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import SparkSession

from rowan.operators.scoring import score
from rowan.sources.models import load_model
from rowan.sources.tables import read_raw, write_predictions
from rowan.spec import DatasetSpec


def run_scoring(
    spark: SparkSession,
    model_path: str,
    source: str,
    target: str,
    spec: DatasetSpec,
    source_fmt: str | None = None,
    target_fmt: str = "parquet",
    threshold: float | None = None,
    reader: Mapping[str, str] | None = None,
) -> str:
    """Score the table at ``source`` into ``target``; one map stage between the two."""
    model = load_model(spark, model_path)
    rows = read_raw(spark, source, source_fmt, reader)
    return write_predictions(score(model, rows, spec, threshold), target, target_fmt)
