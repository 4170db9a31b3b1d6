"""Run-to-run comparison of quality reports.

Reports are the long fact tables of ``quality``; ``pairs`` says which run is compared with which
(``run_id``, ``previous_run_id``). A run without a previous report simply has no rows here. All
checks share one join of the runs' facts, which are a few rows per run whatever the data's size.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from rowan.functions.scores import report_round
from rowan.spec import DatasetSpec

# A change beyond these is flagged.
ROW_CHANGE = 0.1
TARGET_CHANGE = 0.05
MISSING_CHANGE = 0.01

ROWS, TARGET, MISSING = "row_count", "target_distribution", "missing_rate"
CHECKS = (ROWS, TARGET, MISSING)


def consecutive_pairs(reports: DataFrame) -> DataFrame:
    """Each run with the one before it; one row per run, whatever the size of the data."""
    runs = reports.select("run_id").distinct()
    previous = F.lag("run_id").over(W.orderBy("run_id"))
    return runs.select("run_id", previous.alias("previous_run_id")).filter(
        "previous_run_id is not null"
    )


def _measure(reports: DataFrame, spec: DatasetSpec, check: str) -> DataFrame:
    """What a check compares: (run_id, check, column, value)."""
    named = F.lit(check).alias("check")
    nothing = F.lit(None).cast("string").alias("column")
    if check == ROWS:
        counts = reports.filter("section = 'table' and metric = 'row_count'")
        return counts.select("run_id", named, nothing, "value")
    if check == MISSING:
        rates = reports.filter("section = 'missing' and metric = 'rate'")
        return rates.select("run_id", named, "column", report_round("value").alias("value"))
    positives = F.sum(F.when(F.col("column") == spec.positive, F.col("value")).otherwise(0.0))
    totals = reports.filter("section = 'target'").groupBy("run_id").agg(
        F.sum("value").alias("total"), positives.alias("positives")
    )
    rate = (F.col("positives") / F.col("total")).alias("value")
    return totals.filter("total > 0").select("run_id", named, nothing, rate)


def drift_report(
    reports: DataFrame, pairs: DataFrame, spec: DatasetSpec, checks: tuple[str, ...] = CHECKS
) -> DataFrame:
    """Rows (run_id, previous_run_id, check, column, current, previous, delta, pct_change, flagged).

    Row counts: the relative change counts, after rounding; none against an empty run. Target:
    the change of the positive rate counts before rounding; no row if a side is empty. Missing:
    only moved columns are listed; one that is new starts from 0, a vanished one is not looked at.
    """
    measures = reduce(DataFrame.unionByName, [_measure(reports, spec, c) for c in checks])
    current = pairs.join(measures, "run_id").withColumnRenamed("value", "current").alias("c")
    previous = measures.withColumnRenamed("value", "previous").alias("p")
    same = (
        (F.col("c.previous_run_id") == F.col("p.run_id"))
        & (F.col("c.check") == F.col("p.check"))
        & F.col("c.column").eqNullSafe(F.col("p.column"))
    )
    check, now, before = F.col("check"), F.col("current"), F.col("previous")
    rows, target, missing = (check == name for name in CHECKS)
    delta = now - before
    relative = report_round("try_divide(current - previous, previous)")
    share = F.when(before > 0, relative).otherwise(0.0)
    compared = (
        current.join(previous, same, "left")
        .select("c.*", "p.previous")
        .withColumn("previous", F.when(missing, F.coalesce(before, F.lit(0.0))).otherwise(before))
        .filter(before.isNotNull())
        .withColumn("change", delta)
        .withColumn("pct_change", F.when(rows, share))
    )
    moved = (
        F.when(rows, F.abs("pct_change") > ROW_CHANGE)
        .when(target, F.abs("change") > TARGET_CHANGE)
        .otherwise(F.abs("change") > MISSING_CHANGE)
    )
    return (
        compared.withColumn("flagged", moved)
        .filter(~missing | F.col("flagged"))
        .select(
            "run_id",
            "previous_run_id",
            "check",
            "column",
            F.when(target, report_round("current")).otherwise(now).alias("current"),
            F.when(target, report_round("previous")).otherwise(before).alias("previous"),
            F.when(rows, F.col("change")).otherwise(report_round("change")).alias("delta"),
            "pct_change",
            "flagged",
        )
    )


def drift_verdict(report: DataFrame) -> DataFrame:
    """One row per compared run: did anything move?"""
    return report.groupBy("run_id").agg(F.bool_or("flagged").alias("has_drift"))
