"""Long vectors of numbers that tasks make, added up in a tree and in one order.

A row is a numbered vector. Neighbouring numbers are added up FAN_IN at a time, in their order, until few enough
are left for the driver, so that the sum is the same whatever tasks the vectors come from.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCHEMA = "unit int, state binary"
# So many vectors meet in one sum.
FAN_IN = 64


def vector_row(unit: int, state: np.ndarray) -> pa.RecordBatch:
    packed = np.ascontiguousarray(state, dtype=np.float64).tobytes()
    return pa.RecordBatch.from_pydict(
        {"unit": pa.array([unit], pa.int32()), "state": pa.array([packed], pa.binary())}
    )


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the vectors of one group after another; they come in the order of their numbers."""
    group, total = 0, None
    for batch in batches:
        for unit, state in zip(batch.column("unit"), batch.column("state"), strict=True):
            part = np.frombuffer(state.as_py(), dtype=np.float64)
            if total is not None and unit.as_py() // FAN_IN != group:
                yield vector_row(group, total)
                total = None
            group = unit.as_py() // FAN_IN
            total = part.copy() if total is None else total + part
    if total is not None:
        yield vector_row(group, total)


def summed(rows: DataFrame, units: int) -> np.ndarray | None:
    """The sum of vectors numbered from 0 to ``units`` - 1, some of which may be missing; None of none."""
    while units > FAN_IN:
        units = math.ceil(units / FAN_IN)
        group = F.floor(F.col("unit") / FAN_IN).cast("int")
        dealt = rows.repartitionById(units, group).sortWithinPartitions("unit")
        rows = dealt.mapInArrow(_merged, SCHEMA)
    # At most FAN_IN vectors.
    parts = sorted(rows.collect(), key=lambda r: r["unit"])
    total = None
    for r in parts:
        part = np.frombuffer(r["state"], dtype=np.float64)
        total = part.copy() if total is None else total + part
    return total
