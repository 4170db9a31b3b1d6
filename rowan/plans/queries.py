"""One query per operator, over the whole of the given tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowan.functions.scores import argmax_class, at_least, encode_label, report_round, sigmoid
from rowan.functions.text import is_blank, is_invalid_number, to_number
from rowan.operators import drift, features, metrics, quality
from rowan.operators.cv import cross_validate as run_cross_validation
from rowan.operators.learners import (
    LABEL,
    balanced_weights,
    candidates,
    class_weights,
    positive_weight,
)
from rowan.operators.dictionary import CategoryDictionary, WidePreprocessor
from rowan.operators.mlp import MLPModel, NetworkSettings
from rowan.operators.scoring import score
from rowan.operators.split import clamp_folds, inner_split, stratified_folds, stratified_split
from rowan.operators.tuning import run_trials
from rowan.plans import views
from rowan.plans.training import TrainingSettings, metric_report, train_models
from rowan.sources.runs import latest
from rowan.sources.scratch import written

SEED = 42
Query = Callable[[SparkSession, str], DataFrame]


# Cleaning


def na_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.clean_lines(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", "raw_price", "flag"
    )


def coerce_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = views.clean_lines(spark, sf_dir)
    raw, price = F.col("raw_price"), F.col("price")
    return df.withColumn("price", to_number(df, "raw_price")).select(
        "l_orderkey",
        "l_linenumber",
        "price",
        F.coalesce(is_blank(raw), F.lit(False)).cast("int").alias("blank"),
        is_invalid_number(raw, price).cast("int").alias("invalid"),
    )


def encode_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.lines(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", encode_label(F.col("status"), "F", "O").alias("label")
    )


# Gate and profile


def gate_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with null keys and null targets besides their other dirt."""
    key = F.col("l_orderkey")
    lines = views.clean_lines(spark, sf_dir).withColumns(
        {
            "status": F.when(key % 71 != 0, F.col("status")),
            "l_orderkey": F.when(key % 61 != 0, key),
        }
    )
    found = quality.violations(lines, views.LINES)
    return found.select("step", "position", "check", "column", "n")


def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = views.table(spark, sf_dir, "lineitem")
    orders = views.table(spark, sf_dir, "orders")
    # Null keys equal each other.
    some = lines.select(F.when(F.col("l_suppkey") % 3 != 0, F.col("l_suppkey")).alias("some_suppkey"))
    checks = [
        ("l_orderkey", lines), ("l_partkey", lines), ("o_orderkey", orders), ("some_suppkey", some),
    ]
    counted = [
        quality.duplicate_keys(df, key).select(F.lit(key).alias("key"), "duplicates")
        for key, df in checks
    ]
    return reduce(DataFrame.unionByName, counted)


def _profile(spark: SparkSession, sf_dir: str, section: str) -> DataFrame:
    df = views.clean_lines(spark, sf_dir).drop("yr")
    return quality.column_profile(df, views.LINES, (section,))


def table_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _profile(spark, sf_dir, "table").select("metric", "value")


def missing_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _profile(spark, sf_dir, "missing").select("column", "metric", "value")


def coercion_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _profile(spark, sf_dir, "numeric").select("column", "metric", "value")


def category_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.unexpected_values(views.clean_lines(spark, sf_dir), views.LINES)
    return found.select("column", "value", "n")


def observed_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.category_counts(
        views.clean_lines(spark, sf_dir), ["flag", "status"]
    ).select("column", "value", "n")


def target_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = quality.target_distribution(views.clean_lines(spark, sf_dir), "flag")
    return counted.select("value", "n")


def _yearly_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = views.clean_lines(spark, sf_dir)
    return quality.quality_report(df, views.LINES, by="yr")


def quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _yearly_reports(spark, sf_dir).withColumn("value", F.round("value", 6))


def run_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest run's missing facts, runs being ship years."""
    df = views.clean_lines(spark, sf_dir)
    facts = quality.column_profile(df, views.LINES, ("missing",), by="yr")
    return latest(facts).select("run_id", "column", "metric", F.round("value", 6).alias("value"))


# Drift between ship years


def run_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = views.lines(spark, sf_dir).select(F.col("yr").cast("string").alias("run_id"))
    return drift.consecutive_pairs(df)


def _facts(spark: SparkSession, sf_dir: str, section: str) -> DataFrame:
    df = views.clean_lines(spark, sf_dir)
    return quality.column_profile(df, views.LINES, (section,), by="yr")


def drift_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = _facts(spark, sf_dir, "table")
    pairs = drift.consecutive_pairs(facts)
    return drift.drift_report(facts, pairs, views.LINES, (drift.ROWS,)).drop("column")


def drift_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = quality.target_distribution(views.lines(spark, sf_dir), "status", by="yr")
    facts = counted.select(
        "run_id",
        F.lit("target").alias("section"),
        F.col("value").alias("column"),
        F.lit("count").alias("metric"),
        F.col("n").cast("double").alias("value"),
    )
    pairs = drift.consecutive_pairs(facts)
    found = drift.drift_report(facts, pairs, views.LINES, (drift.TARGET,))
    return found.drop("column", "pct_change")


def drift_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = _facts(spark, sf_dir, "missing")
    pairs = drift.consecutive_pairs(facts)
    found = drift.drift_report(facts, pairs, views.LINES, (drift.MISSING,))
    return found.drop("pct_change")


def drift_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A few rows per year, used by every comparison.
    reports = written(_yearly_reports(spark, sf_dir))
    return drift.drift_report(reports, drift.consecutive_pairs(reports), views.LINES)


def drift_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.drift_verdict(drift_report(spark, sf_dir))


# Class balance, splits and folds


def _customers(spark: SparkSession, sf_dir: str, *columns: str | Column) -> DataFrame:
    """Columns of the customer view, which takes a pass over all orders: derived once, read often."""
    return written(views.customers(spark, sf_dir).select(*columns))


def _labelled_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = views.CUSTOMERS
    label = encode_label(F.col(spec.target), spec.positive, spec.negative)
    return _customers(spark, sf_dir, "c_custkey", label.alias(LABEL))


def class_weight(spark: SparkSession, sf_dir: str) -> DataFrame:
    weights = class_weights(_labelled_customers(spark, sf_dir))
    return weights.select(F.col(LABEL).alias("label"), "n", F.round("weight", 6).alias("weight"))


def positive_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    weight = positive_weight(_labelled_customers(spark, sf_dir))
    return weight.select(F.round("pos_weight", 6).alias("pos_weight"))


def _split(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _labelled_customers(spark, sf_dir)
    split = stratified_split(df, LABEL, "c_custkey", 0.2, SEED)
    return df.select(
        "c_custkey",
        F.col(LABEL).alias("label"),
        F.when(split.is_held_out, "test").otherwise("train").alias("split"),
    )


def stratified_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _split(spark, sf_dir)


def split_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = _split(spark, sf_dir).groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("label"), 6).alias("positive_rate")
    )
    return sizes


def inner_validation_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _labelled_customers(spark, sf_dir)
    outer = stratified_split(df, LABEL, "c_custkey", 0.2, SEED)
    train = df.filter(~outer.is_held_out)
    inner = inner_split(train, LABEL, "c_custkey", 0.2, SEED, outer.kept)
    assert inner is not None
    return train.select("c_custkey", inner.is_held_out.cast("int").alias("validation"))


def stratified_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _labelled_customers(spark, sf_dir)
    folds = stratified_folds(df, LABEL, "c_custkey", 5, SEED)
    return df.select("c_custkey", F.col(LABEL).alias("label"), folds.fold.alias("fold"))


# Features


def fold_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and balanced weight of each class among the rows that every fold is fitted on."""
    df = _labelled_customers(spark, sf_dir)
    folds = stratified_folds(df, LABEL, "c_custkey", 5, SEED)
    rows = [
        (fold, float(c), n, balanced_weights(sizes)[c])
        for fold in range(folds.k)
        for sizes in [folds.training_sizes(fold)]
        for c, n in sizes.items()
    ]
    found = spark.createDataFrame(rows, "fold int, label double, n bigint, weight double")
    return found.select("fold", "label", "n", F.round("weight", 6).alias("weight"))


def impute_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _customers(spark, sf_dir, "c_custkey", *views.CUSTOMERS.numeric)
    fitted = features.fit_numeric(df, list(views.CUSTOMERS.numeric))
    return df.select(
        "c_custkey",
        *[
            F.expr(features.imputed_sql(s, df.schema[s.column].dataType)).alias(s.column)
            for s in fitted
        ],
    )


def impute_median_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unreadable price texts replaced by the median of the readable ones."""
    df = views.clean_lines(spark, sf_dir)
    (price,) = features.fit_numeric(df, ["raw_price"])
    imputed = features.imputed_sql(price, df.schema["raw_price"].dataType)
    return df.select("l_orderkey", "l_linenumber", F.expr(imputed).alias("price"))


def impute_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = views.clean_lines(spark, sf_dir)
    imputed = F.expr(features.mode_sql("flag", features.fit_modes(df, ["flag"])["flag"])).alias("flag")
    return df.select("l_orderkey", "l_linenumber", imputed)


def column_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = views.customers(spark, sf_dir)
    return features.modes(features.category_counts(df, ["segment", "nation", "lapsed"]))


def scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _customers(spark, sf_dir, "c_custkey", *views.CUSTOMERS.numeric)
    fitted = features.fit_numeric(df, list(views.CUSTOMERS.numeric))
    return df.select(
        "c_custkey",
        *[
            F.round(F.expr(features.scaled_sql(s, df.schema[s.column].dataType)), 6).alias(s.column)
            for s in fitted
        ],
    )


def _slots(
    spark: SparkSession, sf_dir: str, numeric: list[str], texts: list[str], fitted_on: str = "true"
) -> DataFrame:
    df = _customers(spark, sf_dir, "c_custkey", *numeric, *texts)
    part = df.filter(fitted_on)
    model = features.transformation(
        df, features.fit_numeric(part, numeric), features.fit_categories(part, texts)
    )
    vector = vector_to_array(F.col(features.FEATURES)).alias("vector")
    return model.transform(df).select("c_custkey", vector)


def onehot(spark: SparkSession, sf_dir: str) -> DataFrame:
    hot = _slots(spark, sf_dir, [], ["segment", "nation"])
    cells = hot.select("c_custkey", F.posexplode("vector").alias("slot", "value"))
    return cells.filter("value <> 0")


def feature_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _slots(spark, sf_dir, list(views.CUSTOMERS.numeric), ["segment"])
    return rows.select("c_custkey", F.posexplode("vector").alias("slot", "value")).select(
        "c_custkey", "slot", (F.round("value", 6) + 0.0).alias("value")
    )


def fit_apart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fitted on some customers, applied to all: one segment is unseen and encodes to nothing."""
    part = "c_custkey % 3 <> 0 AND segment <> 'BUILDING'"
    rows = _slots(spark, sf_dir, list(views.CUSTOMERS.numeric), ["segment"], part)
    return rows.select("c_custkey", F.posexplode("vector").alias("slot", "value")).select(
        "c_custkey", "slot", (F.round("value", 6) + 0.0).alias("value")
    )


def _dictionary_slots(
    spark: SparkSession, sf_dir: str, numeric: list[str], texts: list[str], fitted_on: str = "true"
) -> DataFrame:
    """As ``_slots``, with the categories as a table that is joined."""
    df = _customers(spark, sf_dir, "c_custkey", *numeric, *texts)
    part = df.filter(fitted_on)
    fitted = WidePreprocessor(features.fit_numeric(part, numeric), CategoryDictionary.fit(part, texts))
    vector = vector_to_array(F.col(features.FEATURES)).alias("vector")
    return fitted.transform(df).select("c_custkey", vector)


def onehot_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    hot = _dictionary_slots(spark, sf_dir, [], ["segment", "nation"])
    cells = hot.select("c_custkey", F.posexplode("vector").alias("slot", "value"))
    return cells.filter("value <> 0")


def fit_apart_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``fit_apart``, with the categories as a table."""
    part = "c_custkey % 3 <> 0 AND segment <> 'BUILDING'"
    rows = _dictionary_slots(spark, sf_dir, list(views.CUSTOMERS.numeric), ["segment"], part)
    return rows.select("c_custkey", F.posexplode("vector").alias("slot", "value")).select(
        "c_custkey", "slot", (F.round("value", 6) + 0.0).alias("value")
    )


def schema_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No number declared: the columns' types make the same features as the declaration."""
    spec = replace(views.CUSTOMERS, numeric=())
    columns = [*views.CUSTOMERS.numeric, "segment"]
    df = _customers(spark, sf_dir, "c_custkey", *columns)
    rows = features.TabularPreprocessor(spec, columns).fit(df).transform(df)
    vector = vector_to_array(F.col(features.FEATURES))
    return rows.select("c_custkey", F.posexplode(vector).alias("slot", "value")).select(
        "c_custkey", "slot", (F.round("value", 6) + 0.0).alias("value")
    )


# Scores, metrics and selection


def score_linear_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fixed linear scorer on the assembled features: slot i weighs (7 i mod 11 - 5) / 10."""
    rows = _slots(spark, sf_dir, list(views.CUSTOMERS.numeric), ["segment"])
    terms = F.transform("vector", lambda x, i: x * (F.pmod(7 * i, F.lit(11)) - 5) / 10)
    logit = F.aggregate(terms, F.lit(0.0), lambda total, x: total + x)
    scored = rows.select("c_custkey", sigmoid(logit).alias("p"))
    return scored.select(
        "c_custkey",
        F.round("p", 6).alias("probability"),
        at_least(F.col("p")).alias("predicted"),
    )


def score_network_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A network of fixed weights over the customer features, by way of the scoring operator: three
    hidden units, weight (7 i + 5 j) mod 11 - 5 tenths from input i to unit j, biases of a tenth."""
    numeric = list(views.CUSTOMERS.numeric)
    df = _customers(spark, sf_dir, "c_custkey", *numeric, "segment")
    fitted = features.transformation(
        df, features.fit_numeric(df, numeric), features.fit_categories(df, ["segment"])
    )
    width = fitted.transform(df.limit(1)).first()[features.FEATURES].size
    first = [(7 * i + 5 * j) % 11 / 10 - 0.5 for i in range(width) for j in range(3)]
    network = MLPModel(fitted, [width, 3, 1], np.array([*first, 0.1, 0.1, 0.1, 0.7, -0.4, 0.2, 0.1]), 0.0)
    scored = score(network, df, views.CUSTOMERS)
    return scored.select(
        "c_custkey", F.round("positive_probability", 2).alias("probability"), "predicted_label"
    )


def threshold_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inclusive threshold against argmax, which differ on exact ties."""
    p = F.col("probability")
    return views.scored_orders(spark, sf_dir).groupBy("model").agg(
        F.sum(at_least(p, 0.3)).alias("at_least_03"),
        F.sum(at_least(p, 0.5)).alias("at_least_05"),
        F.sum(argmax_class(p)).alias("argmax"),
    )


def round_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half-to-even rounding of mean prices per customer nation."""
    means = (
        views.table(spark, sf_dir, "customer")
        .groupBy("c_nationkey")
        .agg((F.sum(F.col("c_acctbal").cast("decimal(14,2)")).cast("double")).alias("total"))
    )
    tie = F.col("c_nationkey") / F.lit(32.0)
    shares = means.select("c_nationkey", (F.col("total") / F.lit(1e6)).alias("x"), tie.alias("y"))
    return shares.select(
        "c_nationkey", report_round("x").alias("share"), report_round("y").alias("tie")
    )


def confusion_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = metrics.confusion(views.scored_orders(spark, sf_dir), ["model"])
    shares = metrics.rates(*[F.col(c) for c in ("tp", "fp", "fn", "tn")])
    return measured.select(
        "model", "tp", "fp", "fn", "tn", *[F.round(v, 6).alias(m) for m, v in shares.items()]
    )


def roc_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    areas = metrics.roc_auc(views.scored_orders(spark, sf_dir), ["model"])
    return areas.select("model", F.round("roc_auc", 9).alias("roc_auc"))


def _sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.threshold_sweep(views.scored_orders(spark, sf_dir), by=["model"])


_SWEEP = ("precision", "recall", "f1", "accuracy")


def threshold_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sweep(spark, sf_dir).select(
        "model", "threshold", "tp", "fp", "fn", "tn", *[F.round(m, 6).alias(m) for m in _SWEEP]
    )


def best_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = metrics.best_threshold(_sweep(spark, sf_dir), ["model"])
    return best.select("model", "threshold", F.round("f1", 6).alias("f1"))


def default_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    row = metrics.default_threshold(_sweep(spark, sf_dir), ["model"])
    return row.select("model", "threshold", *[F.round(m, 6).alias(m) for m in _SWEEP])


def classification_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Without a name for one fold: null is a group.
    scored = views.scored_orders(spark, sf_dir).withColumn("fold", F.nullif("fold", F.lit(4)))
    measured = metrics.classification_metrics(scored, ["model", "fold"])
    return measured.select(
        "model", "fold", *[F.round(m, 6).alias(m) for m in metrics.METRICS]
    )


def cv_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = metrics.classification_metrics(
        views.scored_orders(spark, sf_dir), ["model", "fold"]
    )
    summary = metrics.score_summary(metrics.metric_rows(measured, ["model", "fold"]))
    return summary.select(
        "model", "metric", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std")
    )


def model_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = metrics.classification_metrics(views.scored_orders(spark, sf_dir), ["model"])
    best = metrics.select_best(measured, "f1", ["c", "b", "a"])
    return best.select("model", F.round("f1", 6).alias("f1"))


def best_trial(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per model the variant with the best mean F1 over folds."""
    counted = metrics.confusion(
        views.scored_orders(spark, sf_dir, variants=4), ["model", "trial", "fold"]
    )
    f1 = metrics.rates(*[F.col(c) for c in ("tp", "fp", "fn", "tn")])["f1"]
    trials = (
        counted.withColumn("f1", f1)
        .groupBy("model", "trial")
        .agg(F.avg("f1").alias("f1_mean"), F.stddev_pop("f1").alias("f1_std"))
    )
    return metrics.best_trial(trials).select(
        "model",
        "trial",
        F.round("f1_mean", 6).alias("f1_mean"),
        F.round("f1_std", 6).alias("f1_std"),
        "num_trials",
    )


# Learners on labelled documents

_NO_NETWORK = NetworkSettings(enabled=False)


def _only(*families: str) -> dict[str, dict[str, bool]]:
    return {f: {"enabled": f in families} for f in candidates()}


def _train(spark: SparkSession, sf_dir: str, settings: TrainingSettings):
    return train_models(
        views.documents(spark, sf_dir), views.DOCUMENTS, settings, persist_input=True
    )


def _test_report(spark: SparkSession, sf_dir: str, settings: TrainingSettings) -> DataFrame:
    return metric_report(_train(spark, sf_dir, settings))


def train_logistic(spark: SparkSession, sf_dir: str) -> DataFrame:
    settings = TrainingSettings(
        cv_enabled=False, network=_NO_NETWORK, models=_only("logistic_regression")
    )
    return _test_report(spark, sf_dir, settings)


def score_logistic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logistic regression fitted on the labelled documents' training part, applied to every document."""
    settings = TrainingSettings(
        cv_enabled=False, network=_NO_NETWORK, models=_only("logistic_regression")
    )
    model = _train(spark, sf_dir, settings).model
    scored = score(model, views.document_features(spark, sf_dir), views.DOCUMENTS)
    return scored.select("doc_id", "predicted_label")


def train_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    settings = TrainingSettings(
        cv_enabled=False, network=_NO_NETWORK, models=_only("random_forest")
    )
    return _test_report(spark, sf_dir, settings)


def train_network(spark: SparkSession, sf_dir: str) -> DataFrame:
    settings = TrainingSettings(cv_enabled=False, models=_only())
    return _train(spark, sf_dir, settings).history


def _document_folds(spark: SparkSession, sf_dir: str, k: int):
    spec = views.DOCUMENTS
    df = views.documents(spark, sf_dir)
    label = encode_label(F.col(spec.target), spec.positive, spec.negative)
    df = df.withColumn(LABEL, label).persist()
    try:
        folds = stratified_folds(df, LABEL, spec.key, k, SEED)
        if clamp_folds(k, folds.sizes) < k:
            raise ValueError(f"Too few rows of a class for {k} folds.")
    except Exception:
        df.unpersist()
        raise
    return df, folds, spec.feature_columns(views.DOCUMENTS.required)


def cross_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    df, folds, columns = _document_folds(spark, sf_dir, 5)
    try:
        scores = run_cross_validation(df, views.DOCUMENTS, candidates(), folds, columns, SEED)
        return metrics.score_summary(scores)
    finally:
        df.unpersist()


def random_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    df, folds, columns = _document_folds(spark, sf_dir, 3)
    try:
        samples = TrainingSettings().tuning_samples
        return run_trials(df, views.DOCUMENTS, candidates(), folds, columns, samples, SEED)[0]
    finally:
        df.unpersist()


def train_and_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train all families on the labelled documents, then score every document with the best."""
    model = _train(spark, sf_dir, TrainingSettings()).model
    scored = score(model, views.document_features(spark, sf_dir), views.DOCUMENTS)
    return scored.select("doc_id", "positive_probability", "predicted_label")


def score_network(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train the network on the labelled documents, then score every document with it."""
    model = _train(spark, sf_dir, TrainingSettings(cv_enabled=False, models=_only())).model
    scored = score(model, views.document_features(spark, sf_dir), views.DOCUMENTS)
    return scored.select("doc_id", "positive_probability", "predicted_label")


def train_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All three families with default settings: test, cross-validation and training numbers."""
    return _test_report(spark, sf_dir, TrainingSettings())


def tuned_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole training: search over both families, cross-validation, all three families fitted."""
    return _test_report(spark, sf_dir, TrainingSettings(tuning_enabled=True))


QUERIES: dict[str, Query] = {
    "na_normalise": na_normalise,
    "coerce_numeric": coerce_numeric,
    "encode_label": encode_labels,
    "gate_violations": gate_violations,
    "duplicate_keys": duplicate_keys,
    "table_profile": table_profile,
    "missing_profile": missing_profile,
    "coercion_report": coercion_report,
    "category_report": category_report,
    "observed_values": observed_values,
    "target_distribution": target_distribution,
    "quality_report": quality_report,
    "run_latest": run_latest,
    "run_pairs": run_pairs,
    "drift_rows": drift_rows,
    "drift_target": drift_target,
    "drift_missing": drift_missing,
    "drift_report": drift_report,
    "drift_verdict": drift_verdict,
    "class_weights": class_weight,
    "positive_weight": positive_weights,
    "stratified_split": stratified_splits,
    "split_summary": split_summary,
    "inner_split": inner_validation_split,
    "stratified_folds": stratified_fold,
    "fold_weights": fold_weights,
    "impute_median": impute_median,
    "impute_median_text": impute_median_text,
    "impute_mode": impute_mode,
    "column_modes": column_modes,
    "scale": scale,
    "onehot": onehot,
    "feature_matrix": feature_matrix,
    "fit_apart": fit_apart,
    "onehot_dictionary": onehot_dictionary,
    "fit_apart_dictionary": fit_apart_dictionary,
    "schema_roles": schema_roles,
    "score_linear_fixed": score_linear_fixed,
    "score_network_fixed": score_network_fixed,
    "threshold_classes": threshold_classes,
    "round_report": round_report,
    "confusion_metrics": confusion_metrics,
    "roc_auc": roc_auc,
    "classification_metrics": classification_metrics,
    "threshold_sweep": threshold_sweep,
    "best_threshold": best_threshold,
    "default_threshold": default_threshold,
    "cv_summary": cv_summary,
    "model_selection": model_selection,
    "best_trial": best_trial,
    "train_logistic": train_logistic,
    "score_logistic": score_logistic,
    "train_forest": train_forest,
    "train_network": train_network,
    "cross_validate": cross_validate,
    "random_search": random_search,
    "train_and_score": train_and_score,
    "score_network": score_network,
    "train_compare": train_compare,
    "tuned_run": tuned_run,
}
