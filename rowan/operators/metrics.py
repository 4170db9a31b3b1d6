"""Binary metrics and threshold sweep, exact and per group.

Scored tables have a 0/1 label, a 0/1 prediction and a probability; ``by`` columns (model, fold,
trial) give one result per combination in the same jobs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from rowan.functions.scores import report_round

METRICS = ("accuracy", "precision", "recall", "f1", "roc_auc")
# The default threshold grid.
THRESHOLDS = (
    0.10, 0.15, 0.20, 0.25, 0.30, 0.35, 0.40, 0.45, 0.50,
    0.55, 0.60, 0.65, 0.70, 0.75, 0.80, 0.85, 0.90,
)

_COUNTS = ("tp", "fp", "fn", "tn")


def rates(tp: Column, fp: Column, fn: Column, tn: Column) -> dict[str, Column]:
    """Accuracy, precision, recall and F1 of confusion counts; 0 where a ratio is empty."""

    def ratio(part: Column, whole: Column) -> Column:
        return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))

    return {
        "accuracy": ratio(tp + tn, tp + fp + fn + tn),
        "precision": ratio(tp, tp + fp),
        "recall": ratio(tp, tp + fn),
        "f1": ratio(2 * tp, 2 * tp + fp + fn),
    }


def _confusion(label: str, prediction: str) -> list[Column]:
    y, p = F.col(label), F.col(prediction)
    return [
        F.count_if((y == 1) & (p == 1)).alias("tp"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.count_if((y == 0) & (p == 0)).alias("tn"),
    ]


def confusion(
    df: DataFrame, by: Sequence[str] = (), label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    return df.groupBy(*by).agg(*_confusion(label, prediction))


def _ranked_right(per_score: DataFrame, by: list[str], carried: Sequence[str]) -> DataFrame:
    """From rows (by..., __s, pos, neg, carried...) per distinct score: sums of the carried counts
    and ``roc_auc`` per group.

    Scores are dealt out in ranges, as many as shuffle partitions and merged where small. Running
    counts of negatives are taken inside a range and the ranges' totals chained afterwards, so no
    class or group is sorted in one task. Pair counts are exact decimals.
    """
    exact = "decimal(19,0)"
    ranged = per_score.repartitionByRange(*by, "__s").withColumn("__r", F.spark_partition_id())
    inside = W.partitionBy(*by, "__r").orderBy("__s").rowsBetween(W.unboundedPreceding, -1)
    below = F.coalesce(F.sum("neg").over(inside), F.lit(0)).alias("below")
    won = F.col("pos").cast(exact) * (2 * F.col("below") + F.col("neg")).cast(exact)
    sums = [F.sum(c).alias(c) for c in ("pos", "neg", *carried)]
    per_range = (
        ranged.select(*by, "__r", "pos", "neg", *carried, below)
        .groupBy(*by, "__r")
        .agg(*sums, F.sum(won).alias("won"))
    )
    # From here on there is one row per group and range.
    before = W.partitionBy(*by).orderBy("__r").rowsBetween(W.unboundedPreceding, -1)
    chained = per_range.withColumn("below", F.coalesce(F.sum("neg").over(before), F.lit(0)))
    won = F.col("won") + F.col("pos").cast(exact) * (2 * F.col("below")).cast(exact)
    pairs = 2 * F.col("pos").cast("double") * F.col("neg").cast("double")
    summed = chained.groupBy(*by).agg(*sums, F.sum(won).alias("won"))
    area = F.try_divide(F.col("won").cast("double"), pairs).alias("roc_auc")
    return summed.select(*by, *carried, area)


def _per_score(
    df: DataFrame, by: list[str], label: str, score: str, counts: list[Column]
) -> DataFrame:
    """One row per group and distinct score, combined before the shuffle. Rows without a score
    rank nowhere, but keep their other counts."""
    scored = F.col("__s").isNotNull()
    return (
        df.withColumn("__s", F.col(score).cast("double"))
        .groupBy(*by, "__s")
        .agg(
            F.count_if(scored & (F.col(label) == 1)).alias("pos"),
            F.count_if(scored & (F.col(label) == 0)).alias("neg"),
            *counts,
        )
    )


def roc_auc(
    df: DataFrame, by: Sequence[str] = (), label: str = "label", score: str = "probability"
) -> DataFrame:
    """Share of (positive, negative) pairs ranked right, ties half; NULL for a single class."""
    by = list(by)
    data = df.select(*by, F.col(label), F.col(score))
    return _ranked_right(_per_score(data, by, label, score, []), by, [])


def classification_metrics(
    df: DataFrame,
    by: Sequence[str] = (),
    label: str = "label",
    prediction: str = "prediction",
    probability: str = "probability",
) -> DataFrame:
    """One row per group with the four confusion counts and all five metrics, unrounded.

    One scan: confusion counts ride along with the scores. A null group is a group.
    """
    groups = list(by) or ["__all"]
    data = df if by else df.withColumn("__all", F.lit(0))
    data = data.select(*groups, F.col(label), F.col(prediction), F.col(probability))
    per_score = _per_score(data, groups, label, probability, _confusion(label, prediction))
    measured = _ranked_right(per_score, groups, _COUNTS)
    shares = rates(*[F.col(c) for c in _COUNTS])
    return measured.select(
        *by, *_COUNTS, *[shares[m].alias(m) for m in METRICS[:-1]], "roc_auc"
    )


def metric_rows(metrics: DataFrame, by: Sequence[str]) -> DataFrame:
    """Wide metrics to rows (..., metric, value)."""
    return metrics.unpivot(list(by), list(METRICS), "metric", "value")


def score_summary(scores: DataFrame, by: Sequence[str] = ("model", "metric")) -> DataFrame:
    """Mean and population deviation of fold scores."""
    return scores.groupBy(*by).agg(
        F.avg("value").alias("mean"), F.stddev_pop("value").alias("std")
    )


def threshold_sweep(
    df: DataFrame,
    thresholds: Sequence[float] | None = None,
    by: Sequence[str] = (),
    label: str = "label",
    probability: str = "probability",
) -> DataFrame:
    """Metrics at every threshold from one pass over the scored rows.

    Each row falls into the band between two neighbouring thresholds; the rows are counted per
    band, and a threshold's confusion counts are sums over the (few) bands.
    """
    grid = [float(t) for t in (thresholds or THRESHOLDS)]
    ordered = sorted(set(grid))
    # The splits are the thresholds themselves: a band computed by arithmetic misplaces rows.
    splits = [float("-inf"), *ordered, float("inf")]
    data = df.select(*by, F.col(label).alias("y"), F.col(probability).cast("double").alias("p"))
    banded = Bucketizer(splits=splits, inputCol="p", outputCol="band").transform(
        data.filter("y is not null and p is not null")
    )
    bands = banded.groupBy(*by, "band").agg(
        F.count_if(F.col("y") == 1).alias("pos"), F.count_if(F.col("y") == 0).alias("neg")
    )

    def at_or_above(counter: str, i: int) -> str:
        return f"sum(CASE WHEN band > {i} THEN {counter} ELSE 0 END)"

    # As text: building this many column objects one by one costs more than running them.
    cells = [
        f"named_struct('position', {position}, 'threshold', CAST('{t!r}' AS DOUBLE), "
        f"'tp', {at_or_above('pos', ordered.index(t))}, "
        f"'fp', {at_or_above('neg', ordered.index(t))})"
        for position, t in enumerate(grid)
    ]
    totals = bands.groupBy(*by).agg(
        F.sum("pos").alias("pos"),
        F.sum("neg").alias("neg"),
        F.expr(f"array({', '.join(cells)})").alias("cells"),
    )
    counted = totals.select(*by, "pos", "neg", F.explode("cells").alias("c")).select(
        *by,
        "c.position",
        F.round("c.threshold", 2).alias("threshold"),
        "c.tp",
        "c.fp",
        (F.col("pos") - F.col("c.tp")).alias("fn"),
        (F.col("neg") - F.col("c.fp")).alias("tn"),
    )
    shares = rates(*[F.col(c) for c in _COUNTS])
    return counted.select(
        *by,
        "position",
        "threshold",
        *_COUNTS,
        *[shares[m].alias(m) for m in ("precision", "recall", "f1", "accuracy")],
    )


def _first_row(sweep: DataFrame, by: Sequence[str], order: Column) -> DataFrame:
    fields = [c for c in sweep.columns if c not in by]
    first = F.min_by(F.struct(*fields), order).alias("row")
    return sweep.groupBy(*by).agg(first).select(*by, "row.*")


def best_threshold(sweep: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """First maximum of the F1 as reported (rounded), in grid order."""
    rounded = sweep.withColumn("f1_reported", report_round("f1"))
    order = F.struct(-F.col("f1_reported"), F.col("position"))
    return _first_row(rounded, by, order).drop("f1_reported")


def default_threshold(sweep: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The grid row nearest 0.5, the first one on a tie."""
    order = F.struct(F.abs(F.col("threshold") - 0.5), F.col("position"))
    return _first_row(sweep, by, order)


def select_best(scores: DataFrame, metric: str, names: Sequence[str]) -> DataFrame:
    """The model with the largest reported metric; on a tie the one named first.

    ``scores`` has one row per model with a column per metric.
    """
    place = F.array_position(F.array(*[F.lit(n) for n in names]), F.col("model"))
    ranked = scores.withColumn("reported", report_round(metric))
    return ranked.orderBy(F.desc("reported"), place).limit(1).select("model", metric)


def best_trial(trials: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """Per family the trial with the largest unrounded mean F1, the earliest on a tie."""
    fields = [c for c in trials.columns if c not in by]
    best = F.max_by(F.struct(*fields), F.struct(F.col("f1_mean"), -F.col("trial")))
    return (
        trials.groupBy(*by)
        .agg(best.alias("best"), F.count(F.lit(1)).alias("num_trials"))
        .select(*by, "best.*", "num_trials")
    )
