from __future__ import annotations

import pytest

from customer_data import row, rows, table
from rowan.operators.quality import (
    duplicate_keys,
    gate,
    quality_report,
    unexpected_values,
    violations,
)
from rowan.spec import CUSTOMER_SPEC, DatasetSpec


def facts(report):
    return {(r["section"], r["column"], r["metric"]): r["value"] for r in report.collect()}


def test_duplicate_keys_are_rejected(spark):
    df = table(spark, [row(1), row(2, customerID="00001")])
    with pytest.raises(ValueError, match="Duplicate customerID values found."):
        gate(df, CUSTOMER_SPEC)


def test_unexpected_target_is_rejected(spark):
    df = table(spark, [row(1, Churn="Maybe"), row(2)])
    with pytest.raises(ValueError, match=r"Unexpected categorical values .*: \['Churn'\]"):
        gate(df, CUSTOMER_SPEC)


def test_report_counts(spark):
    report = facts(quality_report(table(spark, rows(33)), CUSTOMER_SPEC, "r1"))
    assert report["table", None, "row_count"] == 33
    assert report["table", None, "column_count"] == 21
    assert report["table", None, "duplicate_keys"] == 0
    assert report["numeric", "TotalCharges", "invalid"] == 0
    assert report["numeric", "TotalCharges", "missing_after_coercion"] == 3
    assert report["missing", "TotalCharges", "count"] == 0
    assert report["target", "Yes", "count"] + report["target", "No", "count"] == 33


@pytest.mark.parametrize(
    ("records", "drop", "message"),
    [
        ([row(1)], ["tenure", "Churn"], r"Missing required columns: \['tenure', 'Churn'\]"),
        ([row(1, Churn=None), row(2)], [], "Target column contains null values."),
        ([row(1, TotalCharges="12x", tenure="1d")], [], r"columns: \['tenure', 'TotalCharges'\]"),
        ([row(1, customerID=None), row(2, customerID=None, Churn=None)], [], "Duplicate"),
    ],
)
def test_gate_order_and_messages(spark, records, drop, message):
    with pytest.raises(ValueError, match=message):
        gate(table(spark, records).drop(*drop), CUSTOMER_SPEC)


def test_gate_accepts_blanks_nulls_and_extra_columns(spark):
    from pyspark.sql import functions as F

    df = table(spark, [row(1, TotalCharges=" "), row(2, gender=None)])
    gate(df.withColumn("region", F.lit("x")), CUSTOMER_SPEC)
    assert violations(df, CUSTOMER_SPEC).count() == 0


def test_null_keys_equal_each_other(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "k string")
    assert duplicate_keys(df, "k").first()["duplicates"] == 2


def test_unexpected_values_are_listed_whole(spark):
    df = table(spark, [row(1, gender="x"), row(2, gender="x"), row(3, Contract="Weekly"), row(4)])
    got = {(r["column"], r["value"], r["n"]) for r in unexpected_values(df, CUSTOMER_SPEC).collect()}
    assert got == {("gender", "x", 2), ("Contract", "Weekly", 1)}


def test_empty_table_and_wide_table(spark):
    spec = DatasetSpec("k", "t", "1", "0", ())
    empty = facts(quality_report(spark.createDataFrame([], "k string, t string"), spec))
    assert empty["table", None, "row_count"] == 0
    assert empty["missing", "t", "rate"] is None
    wide = spark.range(4).selectExpr(
        "cast(id as string) as k", "'1' as t", *[f"nullif(id, {i % 4}) as c{i}" for i in range(150)]
    )
    report = facts(quality_report(wide, spec))
    assert all(report["missing", f"c{i}", "count"] == 1 for i in range(150))


def test_grouped_report_equals_one_report_per_run(spark):
    from pyspark.sql import functions as F

    df = table(spark, rows(40)).withColumn("run", (F.col("customerID") % 2).cast("string"))
    both = quality_report(df, CUSTOMER_SPEC, by="run")
    for run in ("0", "1"):
        alone = quality_report(df.filter(F.col("run") == run).drop("run"), CUSTOMER_SPEC, run)
        assert facts(both.filter(F.col("run_id") == run)) == facts(alone)
