"""Training flow: gate, profile, drift, split, tune, fit, cross-validate, select, persist."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import asdict, dataclass, field
from datetime import UTC, datetime
from typing import Any

from pyspark import StorageLevel
from pyspark.ml import Model, PipelineModel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from rowan.functions.scores import encode_label, report_round
from rowan.functions.text import column
from rowan.operators.cv import (
    FOLDS_AT_ONCE,
    PARALLELISM,
    cross_validate,
    fit_families,
    packed,
)
from rowan.operators.drift import drift_report, drift_verdict
from rowan.operators.features import FEATURES, TabularPreprocessor
from rowan.operators.learners import LABEL, NETWORK, WEIGHT, candidates, weight_column
from rowan.operators.metrics import (
    METRICS,
    best_threshold,
    best_trial,
    classification_metrics,
    default_threshold,
    score_summary,
    select_best,
    threshold_sweep,
)
from rowan.operators.mlp import MLPModel, NetworkSettings, place_of, train_mlp
from rowan.operators.quality import gate, missing_columns, quality_report, unexpected_values
from rowan.operators.scoring import Scorer, with_scores
from rowan.operators.split import clamp_folds, inner_split, stratified_folds, stratified_split
from rowan.operators.tuning import apply_tuned, run_trials
from rowan.sources.models import save_model
from rowan.sources.epochs import EpochLog
from rowan.sources.runs import REFUSED, SCHEMAS, RunStore, new_run_id
from rowan.sources.tables import choose_source, read_raw, snapshot_path, write_snapshot
from rowan.spec import DatasetSpec

_INNER = "__inner"


# The default settings.
@dataclass(frozen=True)
class TrainingSettings:
    selection_metric: str = "f1"
    test_size: float = 0.2
    random_state: int = 42
    cv_enabled: bool = True
    cv_folds: int = 5
    tuning_enabled: bool = False
    tuning_samples: int = 20
    tuning_folds: int = 3
    network: NetworkSettings = NetworkSettings()
    models: Mapping[str, Mapping[str, Any]] = field(default_factory=dict)
    parallelism: int = PARALLELISM
    folds_at_once: int = FOLDS_AT_ONCE
    max_categories: int | None = None


@dataclass
class TrainingResult:
    """Fitted models and report tables; every table has a row per fact, not per data row."""

    models: dict[str, Scorer]
    selected: str
    sizes: dict[str, int]
    train_sizes: dict[str, int]
    settings: dict[str, dict[str, Any]]
    test_metrics: DataFrame
    cross_validation: DataFrame | None
    tuning: DataFrame | None
    history: DataFrame
    thresholds: DataFrame
    best_threshold: Row
    default_threshold: Row

    @property
    def model(self) -> Scorer:
        return self.models[self.selected]


def framework_of(family: str) -> str:
    return "network" if family == NETWORK else "pipeline"


def _local(df: DataFrame) -> DataFrame:
    """Detach a report-sized table from the data it was computed from."""
    return df.sparkSession.createDataFrame(df.collect(), df.schema)


def train_models(
    df: DataFrame,
    spec: DatasetSpec,
    settings: TrainingSettings = TrainingSettings(),
    persist_input: bool = False,
    log: EpochLog | None = None,
) -> TrainingResult:
    """Fit, evaluate and compare all enabled families on a gated raw table.

    ``df`` is read several times; pass a table in columnar storage, or let it be persisted. ``log``
    keeps the network's epochs and gives those it has.
    """
    spark, seed = df.sparkSession, settings.random_state
    columns = spec.feature_columns(df.columns)
    base = df.withColumn(LABEL, encode_label(column(spec.target), spec.positive, spec.negative))
    persisted = []
    if persist_input:
        base = base.persist(StorageLevel.MEMORY_AND_DISK)
        persisted.append(base)
    try:
        split = stratified_split(base, LABEL, spec.key, settings.test_size, seed)
        train = base.filter(~split.is_held_out & column(LABEL).isNotNull())
        test = base.filter(split.is_held_out)
        kept = split.kept
        rows = sum(kept.values())
        families = candidates(settings.models)

        tuning = None
        if settings.tuning_enabled and families:
            k = clamp_folds(settings.tuning_folds, kept)
            if k:
                folds = stratified_folds(train, LABEL, spec.key, k, seed)
                trials, sampled = run_trials(
                    train, spec, families, folds, columns,
                    settings.tuning_samples, seed, settings.parallelism,
                    settings.folds_at_once, settings.max_categories,
                )
                winners = best_trial(trials).collect()
                tuned = {r["model"]: sampled[r["model"]][r["trial"]] for r in winners}
                families = apply_tuned(families, tuned)
                tuning = spark.createDataFrame(
                    [
                        (
                            r["model"], json.dumps(tuned[r["model"]]), round(r["f1_mean"], 4),
                            round(r["f1_std"], 4), r["num_trials"],
                        )
                        for r in winners
                    ],
                    SCHEMAS["tuning"].removesuffix(", run_id string"),
                )

        preprocessor = TabularPreprocessor(
            spec, columns, rows=rows, max_categories=settings.max_categories
        ).fit(train)
        network = settings.network
        inner = None
        if network.enabled:
            inner = inner_split(train, LABEL, spec.key, network.validation_split, seed, kept)
        held = inner.is_held_out if inner else F.lit(False)
        assembled = preprocessor.transform(train.withColumn(_INNER, held)).select(
            FEATURES, LABEL, _INNER, weight_column(kept).alias(WEIGHT), place_of(spec.key, seed)
        )
        fitting = packed(assembled, rows).persist(StorageLevel.MEMORY_AND_DISK)
        persisted.append(fitting)

        fitted: dict[str, Model | MLPModel] = {}
        fitted.update(fit_families(fitting, families, rows, seed, settings.parallelism))
        if network.enabled:
            sizes = inner.kept if inner else kept
            positives, negatives = sizes.get("1.0", 0), sizes.get("0.0", 0)
            fitted[NETWORK] = train_mlp(
                fitting.filter(~F.col(_INNER)),
                fitting.filter(_INNER) if inner else None,
                preprocessor,
                (sum(sizes.values()), rows - sum(sizes.values())),
                negatives / positives if positives else 1.0,
                network,
                seed,
                log,
            )

        scored = with_scores(
            fitted, preprocessor.transform(test).select(FEATURES, LABEL), [LABEL]
        ).persist(StorageLevel.MEMORY_AND_DISK)
        persisted.append(scored)
        measured = classification_metrics(scored, ["model"], label=LABEL)
        test_metrics = _local(measured)
        selected = select_best(test_metrics, settings.selection_metric, list(fitted)).first()[0]
        sweep = _local(threshold_sweep(scored.filter(F.col("model") == selected), label=LABEL))

        cross_validation = None
        k = clamp_folds(settings.cv_folds, kept) if settings.cv_enabled else 0
        if k and families:
            folds = stratified_folds(train, LABEL, spec.key, k, seed)
            cross_validation = cross_validate(
                train, spec, families, folds, columns, seed, settings.parallelism,
                settings.folds_at_once, settings.max_categories,
            )

        mlp = fitted.get(NETWORK)
        epochs = mlp.summary.history if isinstance(mlp, MLPModel) and mlp.summary else []
        history = spark.createDataFrame(
            [(NETWORK, e["epoch"], e["train_loss"], e.get("val_loss")) for e in epochs],
            SCHEMAS["history"].removesuffix(", run_id string"),
        )
        models: dict[str, Scorer] = {
            name: m if isinstance(m, MLPModel) else PipelineModel([preprocessor, m])
            for name, m in fitted.items()
        }
        return TrainingResult(
            models, selected, split.sizes, kept, families, test_metrics, cross_validation,
            tuning, history, sweep, best_threshold(sweep).first(),
            default_threshold(sweep).first(),
        )
    finally:
        for frame in persisted:
            frame.unpersist()


def metric_report(result: TrainingResult) -> DataFrame:
    """All models' numbers as rows (model, section, metric, value), rounded for the report."""
    parts = result.test_metrics.unpivot("model", list(METRICS), "metric", "value").select(
        "model", F.lit("test").alias("section"), "metric", report_round("value").alias("value")
    )
    if result.cross_validation is not None:
        summary = score_summary(result.cross_validation)
        cells = summary.unpivot(["model", "metric"], ["mean", "std"], "statistic", "value")
        parts = parts.unionByName(
            cells.select(
                "model",
                F.concat(F.lit("cross_validation_"), "statistic").alias("section"),
                "metric",
                report_round("value").alias("value"),
            )
        )
    network = result.models.get(NETWORK)
    if isinstance(network, MLPModel) and network.summary:
        s = network.summary
        facts = {
            "train_rows": s.train_rows,
            "validation_rows": s.validation_rows,
            "best_epoch": s.best_epoch,
            "epochs_completed": s.epochs_completed,
            "used_validation_split": int(s.used_validation_split),
        }
        parts = parts.unionByName(
            parts.sparkSession.createDataFrame(
                [(NETWORK, "training", name, float(v)) for name, v in facts.items()],
                "model string, section string, metric string, value double",
            )
        )
    return parts


def run_training(
    spark: SparkSession,
    source: str | None,
    spec: DatasetSpec,
    root: str,
    settings: TrainingSettings = TrainingSettings(),
    fmt: str | None = None,
    reader: Mapping[str, str] | None = None,
    fallback: str | None = None,
    continues: str | None = None,
) -> dict[str, Any]:
    """One recorded training run over the table at ``source``, or else at ``fallback``; returns its
    summary. ``reader`` goes to Spark's reader.

    ``continues`` names a run that ended before its time: this one takes that run's snapshot for its
    table, and with the same settings the network's epochs that it had finished.
    """
    store, run_id = RunStore(spark, root), new_run_id()
    store.start(run_id)
    if continues:
        dataset = snapshot_path(store.root, continues)
    else:
        raw = read_raw(spark, choose_source(source, fallback), fmt, reader)
        dataset = write_snapshot(raw, store.root, run_id)
    raw = spark.read.parquet(dataset)
    log = EpochLog(spark, f"{store.root}/epochs/run_id={continues or run_id}")

    def record(table: str, rows: DataFrame) -> None:
        store.append(table, rows.withColumn("run_id", F.lit(run_id)))

    try:
        if missing_columns(raw, spec):
            gate(raw, spec)
        # Kept whether or not the gate passes.
        record("unexpected", unexpected_values(raw, spec).drop("run_id"))
        # One row per fact: computed once for the gate and the record.
        report = quality_report(raw, spec, run_id).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            gate(raw, spec, report)
            record("quality", report)
        finally:
            report.unpersist()
    except ValueError:
        store.commit(run_id, REFUSED)
        raise
    previous = store.previous_id(run_id)
    compared = store.of_run("quality", run_id, *([previous] if previous else []))
    record("drift", drift_report(compared, store.previous_pair(run_id), spec))
    verdict = drift_verdict(store.of_run("drift", run_id)).first()

    result = train_models(raw, spec, settings, log=log)
    artifact = save_model(spark, result.model, f"{store.root}/models/run_id={run_id}/best_model")

    record("metrics", metric_report(result))
    record("history", result.history)
    if result.tuning is not None:
        record("tuning", result.tuning)
    shown = ["threshold", "precision", "recall", "f1", "accuracy"]
    chosen = spark.createDataFrame(
        [
            (kind, *[row[c] for c in shown])
            for kind, row in (
                ("best_f1", result.best_threshold),
                ("default", result.default_threshold),
            )
        ],
        "kind string, " + ", ".join(f"{c} double" for c in shown),
    )
    sweep = result.thresholds.select(F.lit("grid").alias("kind"), *shown).unionByName(chosen)
    record(
        "thresholds",
        sweep.select("kind", "threshold", *[report_round(c).alias(c) for c in shown[1:]]),
    )

    rows, train_rows = sum(result.sizes.values()), sum(result.train_sizes.values())
    summary = {
        "dataset_rows": rows,
        "train_rows": train_rows,
        "test_rows": rows - train_rows,
        "target_positive_rate": round(result.sizes.get("1.0", 0) / rows, 4),
        "selected_model": result.selected,
        "selected_framework": framework_of(result.selected),
        "selection_metric": settings.selection_metric,
        "best_model_artifact": artifact,
        "models_evaluated": list(result.models),
        "run_id": run_id,
    }
    store.append("summary", spark.createDataFrame([Row(**summary)], SCHEMAS["summary"]))
    config = {**asdict(settings), "models": result.settings}
    manifest = {
        "created_at_utc": datetime.now(UTC).isoformat(),
        "config": json.dumps(config),
        "selected_model": summary["selected_model"],
        "selected_framework": summary["selected_framework"],
        "selection_metric": summary["selection_metric"],
        "artifact_paths": {
            "dataset": dataset,
            "model": artifact,
            **{t: f"{store.path(t)}/run_id={run_id}" for t in SCHEMAS if t not in ("manifest", "commits")},
        },
        "run_id": run_id,
    }
    store.append("manifest", spark.createDataFrame([Row(**manifest)], SCHEMAS["manifest"]))
    store.commit(run_id)
    return {**summary, "has_drift": bool(verdict and verdict["has_drift"]), "result": result}
