from __future__ import annotations

import pytest

from rowan.operators.drift import consecutive_pairs, drift_report, drift_verdict
from rowan.spec import CUSTOMER_SPEC

SCHEMA = "run_id string, section string, column string, metric string, value double"


def report(run, rows, positives, rates):
    facts = [
        (run, "table", None, "row_count", float(rows)),
        (run, "target", "Yes", "count", float(positives)),
        (run, "target", "No", "count", float(rows - positives)),
    ]
    return facts + [(run, "missing", c, "rate", r) for c, r in rates.items()]


def compare(spark, previous, current):
    reports = spark.createDataFrame([*report("1", *previous), *report("2", *current)], SCHEMA)
    found = drift_report(reports, consecutive_pairs(reports), CUSTOMER_SPEC)
    verdict = drift_verdict(found).first()["has_drift"]
    return {(r["check"], r["column"]): r for r in found.collect()}, verdict


@pytest.mark.parametrize(("rows", "pct", "flagged"), [(111, 0.11, True), (110, 0.10, False)])
def test_row_change(spark, rows, pct, flagged):
    found, verdict = compare(spark, (100, 20, {}), (rows, rows // 5, {}))
    assert found["row_count", None]["pct_change"] == pct
    assert found["row_count", None]["flagged"] is flagged
    assert verdict is flagged


@pytest.mark.parametrize(("positives", "flagged"), [(26, True), (24, False)])
def test_target_change(spark, positives, flagged):
    found, verdict = compare(spark, (100, 20, {}), (100, positives, {}))
    assert found["target_distribution", None]["current"] == positives / 100
    assert found["target_distribution", None]["flagged"] is flagged
    assert verdict is flagged


def test_missing_rates(spark):
    found, verdict = compare(
        spark, (100, 20, {"gone": 0.5, "same": 0.1, "near": 0.10}), (100, 20, {"new": 0.02, "same": 0.1, "near": 0.105})
    )
    assert found["missing_rate", "new"]["previous"] == 0.0
    assert [k for k in found if k[0] == "missing_rate"] == [("missing_rate", "new")]
    assert verdict is True


def test_empty_previous_run(spark):
    found, _ = compare(spark, (0, 0, {}), (10, 2, {}))
    assert found["row_count", None]["pct_change"] == 0.0
    assert ("target_distribution", None) not in found
