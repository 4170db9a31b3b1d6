from __future__ import annotations

import pytest
from customer_data import row, rows, table
from pyspark.sql import functions as F

from rowan import CUSTOMER_SPEC
from rowan.operators.dictionary import CategoryDictionary, WidePreprocessor
from rowan.operators.features import FEATURES, TabularPreprocessor

COLUMNS = CUSTOMER_SPEC.feature_columns(CUSTOMER_SPEC.required)


def vectors(df):
    return {r["customerID"]: r[FEATURES] for r in df.select("customerID", FEATURES).collect()}


@pytest.fixture(scope="module")
def fitting(spark):
    odd = [row(90, gender=None, Contract=None, tenure=None), row(91, PaymentMethod=" odd,\n'value'"), row(92, gender="é汉")]
    return table(spark, rows(60) + odd).repartition(5).persist()


def test_vectors_are_those_of_the_listed_categories(spark, fitting):
    wide = WidePreprocessor.fit(fitting, CUSTOMER_SPEC, COLUMNS)
    listed = TabularPreprocessor(CUSTOMER_SPEC, COLUMNS).fit(fitting)
    other = table(spark, [row(1, Contract="Weekly"), row(2, gender=None, TotalCharges="x"), row(3)])
    for df in (fitting, other):
        got, want = vectors(wide.transform(df)), vectors(listed.transform(df))
        assert set(got) == set(want)
        for key, vector in got.items():
            assert vector.size == want[key].size == wide.width
            assert vector.toArray().tolist() == pytest.approx(want[key].toArray().tolist(), abs=1e-12)
    assert wide.transform(other).columns == [*other.columns, FEATURES]


def test_a_dictionary_is_kept_and_read_again(spark, fitting, tmp_path):
    wide = WidePreprocessor.fit(fitting, CUSTOMER_SPEC, COLUMNS)
    wide.save(f"{tmp_path}/wide")
    again = WidePreprocessor.load(spark, f"{tmp_path}/wide")
    assert vectors(again.transform(fitting)) == vectors(wide.transform(fitting))


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_many_categories_are_joined(spark, threshold):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        n = 60_000
        df = spark.range(n).select(
            F.col("id"),
            F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("v"), F.col("id"))).alias("a"),
            F.concat(F.lit("w"), F.col("id") % 7).alias("b"),
        )
        fitted = CategoryDictionary.fit(df, ["a", "b"])
        assert fitted.widths == [40_001, 7] and fitted.modes == ["hot", "w0"]
        coded = fitted.encoded(df, "slots")
        assert coded.count() == n
        values = sorted({"hot", *(f"v{i}" for i in range(n) if i % 3)})
        places = {v: k for k, v in enumerate(values)}
        for r in coded.filter("id < 60 OR id > 59900").collect():
            assert r["slots"] == [places[r["a"]], 40_001 + r["id"] % 7]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_columns_without_a_value(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, None, None)], "k int, c string, d string")
    fitted = CategoryDictionary.fit(df, ["c", "d"])
    assert (fitted.columns, fitted.width) == (["d"], 1)
    assert [r["s"] for r in fitted.encoded(df, "s").orderBy("k").collect()] == [[0], [0]]
    assert CategoryDictionary.fit(df, ["c"]).width == 0
    assert [r["s"] for r in CategoryDictionary.fit(df, []).encoded(df, "s").collect()] == [[], []]
