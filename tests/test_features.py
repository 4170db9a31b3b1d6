from __future__ import annotations

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from customer_data import row, rows, table
from rowan.operators.features import (
    FEATURES,
    TabularPreprocessor,
    fit_categories,
    fit_modes,
    fit_numeric,
    modes,
    category_counts,
)
from rowan.operators.order_stats import medians
from rowan.spec import CUSTOMER_SPEC, DatasetSpec


def vectors(model, df, key="customerID"):
    scored = model.transform(df).select(key, vector_to_array(FEATURES).alias("x"))
    return {r[key]: r["x"] for r in scored.collect()}


def fit(df):
    return TabularPreprocessor(CUSTOMER_SPEC, CUSTOMER_SPEC.feature_columns(df.columns)).fit(df)


def numbers(records, name):
    values = [r[name] for r in records]
    return np.array([float(v) if v and v.strip() else np.nan for v in values])


def test_median_and_population_scaling(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "v double")
    (s,) = fit_numeric(df, ["v"])
    assert (s.median, s.mean) == (2.5, 4.0)
    assert s.std == pytest.approx(np.std([1, 2, 3, 10]))


def test_moments_after_imputation(spark):
    records = rows(50)
    for s in fit_numeric(table(spark, records), list(CUSTOMER_SPEC.numeric)):
        raw = numbers(records, s.column)
        filled = np.where(np.isnan(raw), np.nanmedian(raw), raw)
        assert s.median == np.nanmedian(raw)
        assert s.mean == pytest.approx(filled.mean(), rel=1e-12)
        assert s.std == pytest.approx(filled.std(), rel=1e-12)


@given(
    st.lists(st.one_of(st.integers(-3, 3), st.floats(-1e9, 1e9), st.just(7.5)), min_size=1, max_size=300)
)
@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_bracketed_median_is_exact(spark, values):
    values = [float(v) for v in values]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    (got,) = medians(df, [F.col("v")], [len(values)], exact_rows=2)
    assert got == (sorted(values)[(len(values) - 1) // 2] + sorted(values)[len(values) // 2]) / 2


def test_bracketed_median_with_a_hot_value_and_two_columns(spark):
    df = spark.range(100_000).select(
        F.when(F.col("id") % 3 == 0, 5.0).otherwise((F.col("id") * 7919 % 100_003) / 1e4).alias("a"),
        F.when(F.col("id") % 2 == 0, F.lit(-1.0)).otherwise(F.col("id") * 1.0).alias("b"),
    )
    pdf = df.toPandas()
    got = medians(df, [F.col("a"), F.col("b")], [100_000, 100_000], exact_rows=50)
    assert got == [np.median(pdf["a"]), np.median(pdf["b"])]


def test_modes_break_ties_by_the_smallest(spark):
    df = spark.createDataFrame([("b", "x"), ("a", None), ("b", "x"), ("a", None)], "p string, q string")
    got = {r["column"]: r["mode"] for r in modes(category_counts(df, ["p", "q"])).collect()}
    assert got == {"p": "a", "q": "x"}
    fitted = fit_categories(df.withColumn("none", F.lit(None).cast("string")), ["p", "q", "none"])
    assert [(s.column, s.mode, s.categories) for s in fitted] == [
        ("p", "a", ("a", "b")), ("q", "x", ("x",)),
    ]


def test_categories_beyond_the_driver_are_refused(spark):
    df = spark.range(50).selectExpr("cast(id as string) as c")
    with pytest.raises(ValueError, match="More than 10 categories"):
        fit_categories(df, ["c"], max_categories=10)


def test_feature_vector_by_hand(spark):
    records = rows(60)
    got = vectors(fit(table(spark, records)), table(spark, records))
    blocks = [c for c in CUSTOMER_SPEC.required if c in CUSTOMER_SPEC.allowed and c != "Churn"]
    scaled = []
    for name in CUSTOMER_SPEC.numeric:
        raw = numbers(records, name)
        filled = np.where(np.isnan(raw), np.nanmedian(raw), raw)
        scaled.append((filled - filled.mean()) / filled.std())
    for i, r in enumerate(records):
        want = [s[i] for s in scaled]
        for c in blocks:
            want += [float(r[c] == v) for v in sorted({x[c] for x in records})]
        assert got[r["customerID"]] == pytest.approx(want, abs=1e-9)


def test_unseen_and_missing_values_at_scoring(spark):
    records = rows(60)
    model = fit(table(spark, records))
    odd = [
        row(3, customerID="unseen", Contract="Weekly", tenure="x"),
        row(3, customerID="null", Contract=None, tenure=None),
    ]
    got = vectors(model, table(spark, odd))
    categories = ["Month-to-month", "One year", "Two year"]
    start = 4
    for c in CUSTOMER_SPEC.required:
        if c == "Contract":
            break
        if c in CUSTOMER_SPEC.allowed:
            start += len({r[c] for r in records})
    block = slice(start, start + len(categories))
    assert got["unseen"][block] == [0.0, 0.0, 0.0]
    assert sum(got["null"][block]) == 1.0
    assert got["unseen"][1] == got["null"][1]


def test_constant_and_empty_columns(spark):
    spec = DatasetSpec("k", "t", "1", "0", ("c", "e"))
    df = spark.createDataFrame(
        [("a", "1", "5", None, "x'\\y"), ("b", "0", "5", None, "z")],
        "k string, t string, c string, e string, s string",
    )
    model = TabularPreprocessor(spec).fit(df)
    assert vectors(model, df, "k") == {"a": [0.0, 1.0, 0.0], "b": [0.0, 0.0, 1.0]}


def test_transformation_keeps_raw_columns_and_persists(spark, tmp_path):
    df = table(spark, rows(30))
    model = fit(df)
    assert model.transform(df).columns == [*df.columns, FEATURES]
    model.write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    assert vectors(again, df) == vectors(model, df)
    plan = model.transform(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_modes_and_limits_of_identifier_like_columns(spark):
    df = spark.range(200_000).selectExpr("cast(id as string) AS name", "'x' AS same", "id % 3 AS third")
    assert fit_modes(df.union(df.limit(1)), ["name", "same"]) == {"name": "0", "same": "x"}
    (stats,) = fit_categories(df, ["name"])
    assert len(stats.categories) == 200_000
    with pytest.raises(ValueError, match=r"More than 100 categories in \['name'\]"):
        fit_categories(df, ["same", "name"], max_categories=100)
    assert [s.column for s in fit_categories(df, ["same"], max_categories=1)] == ["same"]
    with pytest.raises(ValueError, match="More than 2 categories"):
        fit_categories(df.select(F.col("third").cast("string")), ["third"], max_categories=2)


def test_infinite_values_are_named(spark):
    df = spark.createDataFrame([("1",), ("inf",), ("2",)], "price string")
    with pytest.raises(ValueError, match="Infinite values found in column: 'price'"):
        fit_numeric(df, ["price"])


def test_numbers_are_told_by_their_type(spark):
    spec = DatasetSpec("k", "y", "1", "0", numeric=("text",), allowed={"code": ("1", "2")})
    df = spark.createDataFrame(
        [(k, "1", float(k), k % 2 + 1, str(k), k > 2, "a") for k in range(5)],
        "k long, y string, amount double, code int, text string, flag boolean, word string",
    )
    assert spec.numeric_features(df.schema, df.columns) == ["amount", "text"]
    assert spec.categorical_features(df.schema, df.columns) == ["code", "flag", "word"]
    model = TabularPreprocessor(spec, spec.feature_columns(df.columns)).fit(df)
    assert model.transform(df).first()[FEATURES].size == 2 + 2 + 2 + 1
