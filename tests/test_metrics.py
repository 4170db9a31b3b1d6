from __future__ import annotations

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from rowan.operators.metrics import (
    THRESHOLDS,
    best_threshold,
    best_trial,
    classification_metrics,
    default_threshold,
    roc_auc,
    score_summary,
    select_best,
    threshold_sweep,
)

# Confusion counts (TP, FP) per threshold of a published 1,409-row test part with
# 374 positives, and the rounded metrics published for three of them.
COUNTS = (
    (368, 718), (364, 646), (357, 562), (347, 482), (330, 415), (320, 359), (311, 313),
    (302, 279), (284, 240), (262, 203), (237, 163), (215, 129), (188, 91), (147, 61),
    (110, 35), (77, 19), (33, 8),
)
POSITIVES, NEGATIVES = 374, 1035
PUBLISHED = {
    0.10: (0.3389, 0.984, 0.5041, 0.4862),
    0.45: (0.5198, 0.8075, 0.6325, 0.7509),
    0.50: (0.542, 0.7594, 0.6325, 0.7658),
}


@pytest.fixture(scope="module")
def published(spark):
    """Rows that have exactly these counts at and above each threshold."""
    grid = [0.0, *THRESHOLDS, 1.0]
    at_least = [(POSITIVES, NEGATIVES), *COUNTS, (0, 0)]
    rows = []
    for low, here, above in zip(grid, at_least, at_least[1:], strict=False):
        rows += [(1, low)] * (here[0] - above[0]) + [(0, low)] * (here[1] - above[1])
    return spark.createDataFrame(rows, "label int, probability double")


def test_published_sweep(published):
    sweep = threshold_sweep(published)
    rows = sweep.orderBy("position").collect()
    assert [(r["tp"], r["fp"]) for r in rows] == list(COUNTS)
    assert [r["threshold"] for r in rows] == list(THRESHOLDS)
    for r in rows:
        if r["threshold"] in PUBLISHED:
            got = tuple(round(r[m], 4) for m in ("precision", "recall", "f1", "accuracy"))
            assert got == PUBLISHED[r["threshold"]]
    # The unrounded F1 is larger at 0.50; the first of equal reported ones wins.
    assert best_threshold(sweep).first()["threshold"] == 0.45
    assert default_threshold(sweep).first()["threshold"] == 0.5


def test_callers_thresholds_keep_their_order(published):
    sweep = threshold_sweep(published, [0.9, 0.4, 0.6, 0.4])
    rows = sweep.orderBy("position").collect()
    assert [r["threshold"] for r in rows] == [0.9, 0.4, 0.6, 0.4]
    assert rows[1]["tp"] == rows[3]["tp"] == 311
    assert default_threshold(sweep).first()["position"] in (1, 2)


def mann_whitney(y, p):
    pos, neg = p[y == 1][:, None], p[y == 0][None, :]
    return ((pos > neg).sum() + 0.5 * (pos == neg).sum()) / (pos.size * neg.size)


@pytest.fixture(params=["true", "false"])
def merged_ranges(spark, request):
    """Small ranges of scores merged into one, or not."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, request.param)
    yield
    spark.conf.unset(name)


def test_auc_is_exact_with_ties(spark, merged_ranges):
    rng = np.random.default_rng(5)
    y = rng.integers(0, 2, 2000)
    p = np.round((rng.random(2000) + 0.2 * y) / 1.2, 2)
    p[: 700] = 0.5
    df = spark.createDataFrame(list(zip(y.tolist(), p.tolist())), "label int, probability double")
    got = roc_auc(df).first()["roc_auc"]
    assert got == pytest.approx(mann_whitney(y, p), abs=1e-12)


def test_one_class_has_no_auc(spark):
    df = spark.createDataFrame([(1, 1, 0.4), (1, 0, 0.9)], "label int, prediction int, probability double")
    row = classification_metrics(df).first()
    assert row["roc_auc"] is None
    assert (row["accuracy"], row["precision"], row["recall"]) == (0.5, 1.0, 0.5)


def test_empty_ratios_are_zero(spark):
    df = spark.createDataFrame([(0, 0, 0.1)], "label int, prediction int, probability double")
    row = classification_metrics(df).first()
    assert (row["precision"], row["recall"], row["f1"], row["accuracy"]) == (0, 0, 0, 1)


def test_groups_match_their_own_runs(spark):
    rng = np.random.default_rng(1)
    rows = [
        (m, int(rng.integers(0, 2)), int(rng.integers(0, 2)), float(rng.random()))
        for m in ("a", "b")
        for _ in range(300)
    ]
    schema = "model string, label int, prediction int, probability double"
    df = spark.createDataFrame(rows, schema)
    for r in classification_metrics(df, ["model"]).collect():
        mine = [x for x in rows if x[0] == r["model"]]
        y, p = (np.array([x[i] for x in mine]) for i in (1, 3))
        assert r["roc_auc"] == pytest.approx(mann_whitney(y, p), abs=1e-12)
        assert r["accuracy"] == np.mean([x[1] == x[2] for x in mine])


@given(st.lists(st.tuples(st.integers(0, 1), st.floats(0, 1)), min_size=1, max_size=60))
@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_sweep_counts_by_definition(spark, rows):
    df = spark.createDataFrame(rows, "label int, probability double")
    got = threshold_sweep(df).orderBy("position").collect()
    for r in got:
        t = r["threshold"]
        assert r["tp"] == sum(y == 1 and p >= t for y, p in rows)
        assert r["fp"] == sum(y == 0 and p >= t for y, p in rows)
    assert all(a["recall"] >= b["recall"] for a, b in zip(got, got[1:], strict=False))


def test_summary_selection_and_trials(spark):
    scores = spark.createDataFrame(
        [("m", 0, "f1", 0.5), ("m", 1, "f1", 0.7)], "model string, fold int, metric string, value double"
    )
    row = score_summary(scores).first()
    assert (row["mean"], row["std"]) == (pytest.approx(0.6), pytest.approx(0.1))
    models = spark.createDataFrame([("b", 0.70001), ("a", 0.7)], "model string, f1 double")
    assert select_best(models, "f1", ["a", "b"]).first()["model"] == "a"
    trials = spark.createDataFrame(
        [("m", 0, 0.6, 0.1), ("m", 1, 0.8, 0.1), ("m", 2, 0.8, 0.0)],
        "model string, trial int, f1_mean double, f1_std double",
    )
    best = best_trial(trials).first()
    assert (best["trial"], best["num_trials"]) == (1, 3)


def test_null_group_and_null_scores_in_one_scan(spark, merged_ranges):
    rows = [(g, k % 2, None if k == 7 else k / 40, int(k > 20)) for g in (None, "a") for k in range(40)]
    df = spark.createDataFrame(rows, "model string, label int, probability double, prediction int")
    measured = classification_metrics(df, ["model"])
    a, b = sorted(measured.collect(), key=lambda r: r["model"] is None)
    assert (a["model"], b["model"]) == ("a", None)
    assert a["roc_auc"] == b["roc_auc"] == pytest.approx(roc_auc(df, ["model"]).first()["roc_auc"])
    assert a["tp"] + a["fp"] + a["fn"] + a["tn"] == 40
    plan = measured._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("LogicalRDD") == 1
