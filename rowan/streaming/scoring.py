"""Batch scoring of whatever has arrived since the last call.

Scoring is map-only and keeps no state, so the batch operator runs unchanged on a file stream:
each call scores the new files once and stops, with progress kept in the checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from rowan.functions.text import normalise_na
from rowan.operators.scoring import Scorer, score
from rowan.sources.tables import csv_options
from rowan.spec import DatasetSpec


def score_new_files(
    spark: SparkSession,
    model: Scorer,
    source: str,
    schema: StructType,
    target: str,
    checkpoint: str,
    spec: DatasetSpec,
    fmt: str = "parquet",
) -> None:
    """Append scores for files of ``source`` that no earlier call has scored."""
    options = {"multiLine": "true", **csv_options()} if fmt == "csv" else {}
    reader = spark.readStream.schema(schema).format(fmt).options(**options)
    scored = score(model, normalise_na(reader.load(source)), spec)
    query = (
        scored.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(target)
    )
    query.awaitTermination()
