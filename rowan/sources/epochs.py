"""Log of a training's epochs, from which a stopped training goes on.

The log is a Parquet table with one row and one file for each epoch: loss figures, the state of parameters
and moments, and what the training hangs on. Spark renames a finished file into place, so that a row is there
whole or not at all, and a training that ends in the middle of an epoch leaves the epochs before it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SCHEMA = "training string, epoch int, steps bigint, train_loss double, val_loss double, state binary"


@dataclass(frozen=True)
class EpochRecord:
    epoch: int
    steps: int
    train_loss: float
    val_loss: float | None


class EpochLog:
    """``path`` lies where all executors write, as any output."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.path = path
        self.training = ""

    def open(self, training: str) -> None:
        """Name the training; its log holds no other."""
        self.training = training
        others = self._rows().filter(F.col("training") != training)
        if not others.isEmpty():
            raise ValueError(f"{self.path} is the log of another training.")

    def _rows(self) -> DataFrame:
        try:
            return self.spark.read.schema(_SCHEMA).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() == "PATH_NOT_FOUND":
                return self.spark.createDataFrame([], _SCHEMA)
            raise

    def records(self) -> list[EpochRecord]:
        """The epochs kept, in order, up to the first that is missing; the states stay in their files."""
        rows = self._rows().select("epoch", "steps", "train_loss", "val_loss").distinct()
        found = {r["epoch"]: EpochRecord(*r) for r in rows.collect()}
        kept = []
        while len(kept) + 1 in found:
            kept.append(found[len(kept) + 1])
        return kept

    def state(self, epoch: int) -> np.ndarray:
        """Parameters, first and second moments after an epoch, a row each."""
        row = self._rows().filter(F.col("epoch") == epoch).select("state").first()
        return np.frombuffer(row["state"], dtype=np.float32).reshape(3, -1).copy()

    def append(self, record: EpochRecord, state: np.ndarray) -> None:
        row = (
            self.training, record.epoch, record.steps, record.train_loss, record.val_loss,
            bytearray(state.astype(np.float32).tobytes()),
        )
        frame = self.spark.createDataFrame([row], _SCHEMA).coalesce(1)
        frame.write.mode("append").parquet(self.path)
