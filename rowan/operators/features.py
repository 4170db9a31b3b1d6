"""Fitting and applying the feature transformation.

``TabularPreprocessor`` learns medians, moments, modes and category lists from a training table
and returns an ordinary ``PipelineModel`` of JVM stages, so applying it is map-only, it persists
with Spark ML's own writer, and it takes the raw (text) columns without changing them.
"""

from __future__ import annotations

import math
from collections.abc import Iterable
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexerModel, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowan.functions.text import column, number_sql, quoted, text_literal
from rowan.operators.order_stats import EXACT_ROWS, collected_median, median_bracket, medians
from rowan.spec import DatasetSpec

FEATURES = "__features"


@dataclass(frozen=True)
class NumericStats:
    """Per column: fitted median, then mean and population deviation after imputation."""

    column: str
    median: float
    mean: float
    std: float

    @property
    def scale(self) -> float:
        return self.std if self.std > 0 else 1.0


@dataclass(frozen=True)
class CategoryStats:
    """Per column: the imputed value and the sorted values seen."""

    column: str
    mode: str
    categories: tuple[str, ...]


def fit_numeric(
    df: DataFrame, columns: list[str], exact_rows: int = EXACT_ROWS, rows: int | None = None
) -> list[NumericStats]:
    """Medians and moments; columns without a single value are left out.

    Moments after imputation follow from the moments before it: the missing rows are so many
    copies of the median, so no second pass over the imputed column is needed. A table known to
    have few ``rows`` takes one pass; otherwise the moments pass also brackets the medians.
    """
    if not columns:
        return []
    small = rows is not None and rows <= exact_rows
    # Parsed once per row; the passes below use each value several times.
    parsed = df.select(
        *[
            F.expr(number_sql(c, df.schema[c].dataType)).alias(f"v{i}")
            for i, c in enumerate(columns)
        ]
    )
    values = [F.col(f"v{i}") for i in range(len(columns))]
    aggregates = [F.count(F.lit(1)).alias("rows")]
    for i, v in enumerate(values):
        aggregates += [
            F.count(v).alias(f"n{i}"),
            F.avg(v).alias(f"mean{i}"),
            F.var_pop(v).alias(f"var{i}"),
            (collected_median(v) if small else median_bracket(v)).alias(f"middle{i}"),
        ]
    row = parsed.agg(*aggregates).first()
    places = range(len(columns))
    middles = [row[f"middle{i}"] for i in places]
    if not small:
        counts = [row[f"n{i}"] for i in places]
        middles = medians(parsed, values, counts, exact_rows, middles)
    return [
        _imputed(name, middles[i], row["rows"], row[f"n{i}"], row[f"mean{i}"], row[f"var{i}"])
        for i, name in enumerate(columns)
        if middles[i] is not None
    ]


def _imputed(
    name: str, median: float, rows: int, n: int, mean: float, var: float
) -> NumericStats:
    """Moments after imputation from those of the ``n`` values present."""
    if not (math.isfinite(mean) and math.isfinite(var)):
        raise ValueError(f"Infinite values found in column: {name!r}")
    share, gap = n / rows, mean - median
    spread = share * var + share * (1.0 - share) * gap * gap
    return NumericStats(name, median, median + share * gap, math.sqrt(max(0.0, spread)))


def _without(parts: list[tuple[int, float, float]], left_out: int) -> tuple[int, float, float]:
    """Count, mean and variance of all parts but one, added up in their order."""
    n, mean, squares = 0, 0.0, 0.0
    for k, (m, part_mean, part_var) in enumerate(parts):
        if k == left_out or not m:
            continue
        gap = part_mean - mean
        squares += m * part_var + gap * gap * n * m / (n + m)
        mean += gap * m / (n + m)
        n += m
    return n, mean, squares / n if n else 0.0


def fit_numeric_folds(
    df: DataFrame, fold: str, k: int, columns: list[str], exact_rows: int = EXACT_ROWS
) -> list[list[NumericStats]]:
    """``fit_numeric`` of all rows outside each of the folds 0 to k - 1, in the passes that one fit takes.

    One pass gives the moments of every fold, and those of the others follow by addition. Medians are
    searched for in common passes, a search for each column and fold left out.
    """
    if not columns:
        return [[] for _ in range(k)]
    parsed = df.select(
        F.col(fold).alias("fold"),
        *[
            F.expr(number_sql(c, df.schema[c].dataType)).alias(f"v{i}")
            for i, c in enumerate(columns)
        ],
    )
    aggregates = [F.count(F.lit(1)).alias("rows")]
    for i in range(len(columns)):
        v = F.col(f"v{i}")
        aggregates += [F.count(v), F.avg(v), F.var_pop(v)]
    # A row for each fold.
    found = {r["fold"]: tuple(r)[1:] for r in parsed.groupBy("fold").agg(*aggregates).collect()}
    folds = [found.get(j, (0, *(0, None, None) * len(columns))) for j in range(k)]
    rows = [sum(f[0] for i, f in enumerate(folds) if i != j) for j in range(k)]
    cells = [(j, i) for j in range(k) for i in range(len(columns))]
    moments = {
        (j, i): _without([f[1 + 3 * i : 4 + 3 * i] for f in folds], j) for j, i in cells
    }
    values = [F.when(F.col("fold") != j, F.col(f"v{i}")) for j, i in cells]
    middles = dict(
        zip(cells, medians(parsed, values, [moments[c][0] for c in cells], exact_rows), strict=True)
    )
    return [
        [
            _imputed(name, middles[j, i], rows[j], *moments[j, i])
            for i, name in enumerate(columns)
            if middles[j, i] is not None
        ]
        for j in range(k)
    ]


def category_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows per column and present value, all columns in one pass: (column, value, n)."""
    cells = F.array(
        *[
            F.struct(F.lit(c).alias("column"), column(c).cast("string").alias("value"))
            for c in columns
        ]
    )
    return (
        df.select(F.explode(cells).alias("s"))
        .filter("s.value is not null")
        .groupBy("s.column", "s.value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def modes(counts: DataFrame) -> DataFrame:
    """Most frequent value per column, the smallest on a tie: (column, mode)."""
    best = F.min_by("value", F.struct(-F.col("n"), F.col("value")))
    return counts.groupBy("column").agg(best.alias("mode"))


def fit_modes(df: DataFrame, columns: list[str]) -> dict[str, str]:
    """Most frequent value per column, however many values there are: a row per column comes back."""
    return {r["column"]: r["mode"] for r in modes(category_counts(df, columns)).collect()}


def _refuse_wide(df: DataFrame, columns: list[str], limit: int) -> None:
    """Raise if a column has more values than the limit; nothing but sketches is shuffled."""
    error = 0.02
    sketches = [F.approx_count_distinct(column(c), error) for c in columns]
    found = df.agg(*[s.alias(f"n{i}") for i, s in enumerate(sketches)]).first()
    wide = [c for c, n in zip(columns, found, strict=True) if n > limit * (1 + 5 * error)]
    if wide:
        raise ValueError(f"More than {limit} categories in {wide}: {_ADVICE}")


_ADVICE = "declare identifier-like columns as the key or leave them out."


def fit_categories(
    df: DataFrame, columns: list[str], max_categories: int | None = None
) -> list[CategoryStats]:
    """Mode and sorted categories per column; columns without a single value are left out.

    A model has a slot and a weight for every category, so the lists are as large as the model.
    ``max_categories`` refuses columns with more values, before they are shuffled where a sketch
    tells.
    """
    if not columns:
        return []
    if max_categories is not None:
        _refuse_wide(df, columns, max_categories)
    counts = ((r["column"], r["value"], r["n"]) for r in category_counts(df, columns).collect())
    return _categories(counts, columns, max_categories)


def _categories(
    counts: Iterable[tuple[str, str, int]], columns: list[str], max_categories: int | None
) -> list[CategoryStats]:
    seen: dict[str, list[tuple[int, str]]] = {}
    for name, value, n in counts:
        seen.setdefault(name, []).append((-n, value))
    wide = [c for c in columns if max_categories is not None and len(seen.get(c, ())) > max_categories]
    if wide:
        raise ValueError(f"More than {max_categories} categories in {wide}: {_ADVICE}")
    return [
        CategoryStats(c, min(seen[c])[1], tuple(sorted(v for _, v in seen[c])))
        for c in columns
        if c in seen
    ]


def fit_categories_folds(
    df: DataFrame, fold: str, k: int, columns: list[str], max_categories: int | None = None
) -> list[list[CategoryStats]]:
    """``fit_categories`` of all rows outside each of the folds 0 to k - 1, from one pass.

    Every value is counted in each fold; outside a fold it has its other counts.
    """
    if not columns:
        return [[] for _ in range(k)]
    if max_categories is not None:
        _refuse_wide(df, columns, max_categories)
    cells = F.array(
        *[
            F.struct(F.lit(c).alias("column"), column(c).cast("string").alias("value"))
            for c in columns
        ]
    )
    exploded = df.select(F.col(fold).alias("fold"), F.explode(cells).alias("s"))
    counts = [F.count_if(F.col("fold") == j) for j in range(k)]
    counted = (
        exploded.filter("s.value is not null")
        .groupBy("s.column", "s.value")
        .agg(F.array(*counts).alias("n"))
        .collect()
    )
    total = [sum(r["n"]) for r in counted]
    return [
        _categories(
            (
                (r["column"], r["value"], n - r["n"][j])
                for r, n in zip(counted, total, strict=True)
                if n > r["n"][j]
            ),
            columns,
            max_categories,
        )
        for j in range(k)
    ]


def fit_folds(
    df: DataFrame,
    fold: str,
    k: int,
    spec: DatasetSpec,
    columns: list[str],
    output: str = FEATURES,
    max_categories: int | None = None,
) -> list[PipelineModel]:
    """The ``TabularPreprocessor`` of all rows outside each fold; the number of passes does not hang on k."""
    numbers = spec.numeric_features(df.schema, columns)
    texts = spec.categorical_features(df.schema, columns)
    # Two independent sets of passes over different columns.
    with ThreadPool(2) as pool:
        pending = pool.apply_async(fit_categories_folds, (df, fold, k, texts, max_categories))
        numeric = fit_numeric_folds(df, fold, k, numbers)
        categorical = pending.get()
    if not all(n or c for n, c in zip(numeric, categorical, strict=True)):
        raise ValueError("No feature column has a value.")
    return [transformation(df, n, c, output) for n, c in zip(numeric, categorical, strict=True)]


def _double_literal(value: float) -> str:
    return f"CAST('{value!r}' AS DOUBLE)"


def imputed_sql(stats: NumericStats, dtype: T.DataType) -> str:
    return f"coalesce({number_sql(stats.column, dtype)}, {_double_literal(stats.median)})"


def scaled_sql(stats: NumericStats, dtype: T.DataType) -> str:
    value = imputed_sql(stats, dtype)
    return f"({value} - {_double_literal(stats.mean)}) / {_double_literal(stats.scale)}"


def mode_sql(name: str, mode: str) -> str:
    return f"coalesce(CAST({quoted(name)} AS STRING), {text_literal(mode)})"


def category_sql(stats: CategoryStats) -> str:
    return mode_sql(stats.column, stats.mode)


def transformation(
    df: DataFrame,
    numeric: list[NumericStats],
    categorical: list[CategoryStats],
    output: str = FEATURES,
) -> PipelineModel:
    """Impute, scale, one-hot and assemble as fitted JVM stages.

    The numeric block comes first, then one block per category column. An unseen category lands
    in the indexer's extra slot, which the encoder drops: its block is all zeros.
    """
    numbers = [f"__num_{i}" for i in range(len(numeric))]
    texts = [f"__cat_{i}" for i in range(len(categorical))]
    indexes = [f"__idx_{i}" for i in range(len(categorical))]
    blocks = [f"__hot_{i}" for i in range(len(categorical))]
    expressions = [
        f"{scaled_sql(s, df.schema[s.column].dataType)} AS {n}"
        for s, n in zip(numeric, numbers, strict=True)
    ] + [f"{category_sql(s)} AS {n}" for s, n in zip(categorical, texts, strict=True)]
    # "__THIS__" is the transformer's own placeholder.
    stages = [SQLTransformer(statement=f"SELECT *, {', '.join(expressions)} FROM __THIS__")]
    if categorical:
        # One indexer per column: the many-column constructor pads shorter label lists with nulls.
        indexers = [
            StringIndexerModel.from_labels(
                list(s.categories), inputCol=t, outputCol=i, handleInvalid="keep"
            )
            for s, t, i in zip(categorical, texts, indexes, strict=True)
        ]
        # The encoder only needs the indexers' metadata, so it is fitted on no rows.
        shape = T.StructType([T.StructField(t, T.StringType()) for t in texts])
        no_rows = df.sparkSession.createDataFrame([], shape)
        encoder = OneHotEncoder(inputCols=indexes, outputCols=blocks, dropLast=True)
        stages += [*indexers, encoder.fit(PipelineModel(indexers).transform(no_rows))]
    stages.append(VectorAssembler(inputCols=numbers + blocks, outputCol=output))
    private = ", ".join(numbers + texts + indexes + blocks)
    stages.append(SQLTransformer(statement=f"SELECT * EXCEPT ({private}) FROM __THIS__"))
    return PipelineModel(stages)


class TabularPreprocessor(Estimator):
    """Median + standard scaling for declared numbers, mode + one-hot for the other features.

    ``rows`` is the table's size where the caller knows it, ``max_categories`` an optional limit
    to the values of a one-hot column.
    """

    def __init__(
        self,
        spec: DatasetSpec,
        columns: list[str] | None = None,
        output: str = FEATURES,
        rows: int | None = None,
        max_categories: int | None = None,
    ) -> None:
        super().__init__()
        self.spec = spec
        self.columns = columns
        self.output = output
        self.rows = rows
        self.max_categories = max_categories

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        columns = self.columns if self.columns is not None else dataset.columns
        columns = [c for c in columns if not c.startswith("__")]
        numbers = self.spec.numeric_features(dataset.schema, columns)
        texts = self.spec.categorical_features(dataset.schema, columns)
        # Two independent sets of passes over different columns.
        with ThreadPool(2) as pool:
            pending = pool.apply_async(fit_categories, (dataset, texts, self.max_categories))
            numeric = fit_numeric(dataset, numbers, rows=self.rows)
            categorical = pending.get()
        if not numeric and not categorical:
            raise ValueError("No feature column has a value.")
        return transformation(dataset, numeric, categorical, self.output)
