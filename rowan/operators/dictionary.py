"""One-hot features of columns with more categories than a driver holds.

The categories are a table: column, value and slot, the slot being the rank of column and value among all. It is
made by a distributed sort, kept as Parquet and joined to the rows that are encoded, so that no list of values
meets the driver or a task; Spark broadcasts it below its own threshold and shuffles, splitting hot values,
above. Slots, imputed modes and widths are those of ``TabularPreprocessor``.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowan.operators.features import FEATURES, NumericStats, category_counts, fit_numeric, mode_sql, modes, scaled_sql
from rowan.sources.scratch import written
from rowan.spec import DatasetSpec

_SCHEMA = "place int, value string, slot int"


@dataclass(frozen=True)
class CategoryDictionary:
    """``table`` has a row (place of the column, value, slot) for every category; a mode and a width for
    every column are all that the driver holds."""

    columns: list[str]
    modes: list[str]
    widths: list[int]
    table: DataFrame

    @classmethod
    def fit(cls, df: DataFrame, columns: Sequence[str]) -> CategoryDictionary:
        """Columns without a single value are left out."""
        spark = df.sparkSession
        if not columns:
            return cls([], [], [], spark.createDataFrame([], _SCHEMA))
        counts = written(category_counts(df, list(columns)))
        # A row for each column.
        found = {r["column"]: r["mode"] for r in modes(counts).collect()}
        widths = {r["column"]: r["count"] for r in counts.groupBy("column").count().collect()}
        kept = [c for c in columns if c in found]
        if not kept:
            return cls([], [], [], spark.createDataFrame([], _SCHEMA))
        place = F.array_position(F.array(*[F.lit(c) for c in kept]), F.col("column")) - 1
        ranged = (
            counts.select(place.cast("int").alias("place"), "value")
            .repartitionByRange("place", "value")
            .sortWithinPartitions("place", "value")
        )
        # The partition's number in the upper bits, the row's in the lower 33.
        numbered = written(ranged.withColumn("at", F.monotonically_increasing_id()))
        part, row = F.shiftright("at", 33), F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
        # A row for each partition.
        sizes = {r["part"]: r["count"] for r in numbered.groupBy(part.alias("part")).count().collect()}
        starts = np.cumsum([0, *(sizes[p] for p in sorted(sizes))])
        offsets = spark.createDataFrame(
            [(p, int(s)) for p, s in zip(sorted(sizes), starts, strict=False)], "part bigint, before bigint"
        )
        ranked = numbered.withColumn("part", part).join(F.broadcast(offsets), "part")
        slots = ranked.select("place", "value", (F.col("before") + row).cast("int").alias("slot"))
        return cls(kept, [found[c] for c in kept], [widths[c] for c in kept], written(slots))

    @property
    def width(self) -> int:
        return sum(self.widths)

    def encoded(self, df: DataFrame, output: str) -> DataFrame:
        """The rows with the slots of their categories, an array in the order of columns. An unseen value
        has none, a missing one that of its column's mode."""
        names = []
        for k, (name, mode) in enumerate(zip(self.columns, self.modes, strict=True)):
            value, slot = f"__value_{k}", f"__slot_{k}"
            own = self.table.filter(F.col("place") == k).select(F.col("value").alias(value), F.col("slot").alias(slot))
            df = df.join(own, F.expr(mode_sql(name, mode)) == F.col(value), "left").drop(value)
            names.append(slot)
        slots = F.array_compact(F.array(*names)) if names else F.array().cast("array<int>")
        return df.withColumn(output, slots).drop(*names)


@dataclass(frozen=True)
class WidePreprocessor:
    """Median, scaling, mode and one-hot as ``TabularPreprocessor``'s, the categories being a table."""

    numeric: list[NumericStats]
    dictionary: CategoryDictionary

    @classmethod
    def fit(cls, df: DataFrame, spec: DatasetSpec, columns: Sequence[str]) -> WidePreprocessor:
        numbers = spec.numeric_features(df.schema, list(columns))
        texts = spec.categorical_features(df.schema, list(columns))
        fitted = cls(fit_numeric(df, numbers), CategoryDictionary.fit(df, texts))
        if not fitted.width:
            raise ValueError("No feature column has a value.")
        return fitted

    @property
    def width(self) -> int:
        return len(self.numeric) + self.dictionary.width

    def transform(self, df: DataFrame, output: str = FEATURES) -> DataFrame:
        """The rows with their sparse vectors."""
        scaled = [F.expr(scaled_sql(s, df.schema[s.column].dataType)) for s in self.numeric]
        numbers = F.array(*scaled) if scaled else F.array().cast("array<double>")
        coded = self.dictionary.encoded(df.withColumn("__numbers", numbers), "__slots")
        vector = _vectors(len(self.numeric), self.width)
        return coded.withColumn(output, vector("__numbers", "__slots")).drop("__numbers", "__slots")

    def save(self, path: str) -> None:
        d = self.dictionary
        told = {"numeric": [asdict(s) for s in self.numeric], "columns": d.columns, "modes": d.modes, "widths": d.widths}
        d.table.write.mode("overwrite").parquet(f"{path}/dictionary")
        d.table.sparkSession.createDataFrame([(json.dumps(told),)], "told string").coalesce(1).write.mode(
            "overwrite"
        ).json(f"{path}/columns")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> WidePreprocessor:
        told = json.loads(spark.read.schema("told string").json(f"{path}/columns").first()["told"])
        table = spark.read.schema(_SCHEMA).parquet(f"{path}/dictionary")
        dictionary = CategoryDictionary(told["columns"], told["modes"], told["widths"], table)
        return cls([NumericStats(**s) for s in told["numeric"]], dictionary)


def _vectors(first: int, width: int):
    """Sparse vectors of the numbers in the first slots and ones in the others."""

    @F.arrow_udf(VectorUDT())
    def vector(numbers: pa.Array, slots: pa.Array) -> pa.Array:
        hot = pc.list_value_length(slots).to_numpy(zero_copy_only=False)
        n = len(hot)
        sizes = hot + first
        ends = np.concatenate([[0], np.cumsum(sizes)])
        number = np.zeros(ends[-1], bool)
        place = np.arange(ends[-1]) - np.repeat(ends[:-1], sizes)
        number[:] = place < first
        indices, values = np.empty(ends[-1], np.int32), np.ones(ends[-1])
        indices[number] = place[number]
        values[number] = numbers.flatten().to_numpy(zero_copy_only=False)
        indices[~number] = slots.flatten().to_numpy(zero_copy_only=False) + first
        offsets = pa.array(ends, pa.int32())
        parts = {
            "type": pa.array(np.zeros(n, np.int8)),
            "size": pa.array(np.full(n, width, np.int32)),
            "indices": pa.ListArray.from_arrays(offsets, pa.array(indices)),
            "values": pa.ListArray.from_arrays(offsets, pa.array(values)),
        }
        return pa.StructArray.from_arrays(list(parts.values()), list(parts))

    return vector
