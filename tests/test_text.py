from __future__ import annotations

import random

import pandas as pd
import pytest
from pandas._libs.parsers import STR_NA_VALUES
from pyspark.sql import functions as F

from rowan.functions.scores import argmax_class, at_least, encode_label, report_round
from rowan.functions.text import (
    NA_TOKENS,
    is_blank,
    is_invalid_number,
    normalise_na,
    strip,
    to_number,
)
from rowan.sources.tables import choose_source, read_raw

NUMBERS = [
    "1", "-1.5", "+2.", ".5", "1e3", "1E-2", " 7 ", "\t8\n", " 9　", "inf", "-Infinity",
    "1d", "1f", "12x", "1,000", "1_000", "0x10", "--1", "", " ", "nan ", "1 2", "e5", ".", "+",
    "00012", "1.2.3", "1e", "99999999999999999999",
]


def test_numbers_parse_as_in_pandas(spark):
    df = spark.createDataFrame(list(enumerate(NUMBERS)), "i int, t string")
    got = df.select("i", to_number(df, "t").alias("v")).orderBy("i").collect()
    for text, (_, value) in zip(NUMBERS, got, strict=True):
        want = pd.to_numeric(pd.Series([text]), errors="coerce").iloc[0]
        assert (value is None) if pd.isna(want) else (value == pytest.approx(want, rel=1e-14)), repr(text)


def test_typed_numbers_and_nan(spark):
    df = spark.createDataFrame([(1.5,), (float("nan"),), (None,)], "v double")
    assert [r[0] for r in df.select(to_number(df, "v")).collect()] == [1.5, None, None]


def test_strip_and_blank_know_unicode(spark):
    texts = [" a ", "\ta\n", " a　", "a b", "　", "", "\x1fa"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = df.select(strip(F.col("t")), is_blank(F.col("t"))).collect()
    assert [r[0] for r in got] == [t.strip() for t in texts]
    assert [r[1] for r in got] == [t.strip() == "" for t in texts]


def test_invalid_numbers_are_present_and_not_blank(spark):
    cases = [("12x", True), ("1d", True), ("1,000", True), (" ", False), (None, False), ("3", False)]
    df = spark.createDataFrame([(t,) for t, _ in cases], "t string")
    got = [r[0] for r in df.select(is_invalid_number(F.col("t"), to_number(df, "t"))).collect()]
    assert got == [want for _, want in cases]


def test_na_tokens_are_the_csv_readers(spark):
    assert set(NA_TOKENS) == set(STR_NA_VALUES)
    df = spark.createDataFrame([(t, 1) for t in [*NA_TOKENS, " ", "nope"]], "t string, n int")
    kept = normalise_na(df).filter("t is not null").collect()
    assert [r["t"] for r in kept] == [" ", "nope"]


def test_csv_keeps_text_and_leading_zeros(spark, tmp_path):
    path = tmp_path / "in.csv"
    path.write_text('id,v,s\n0001,NA,"a ""b"", c"\n0002,1.50,None\n')
    got = read_raw(spark, str(path)).orderBy("id").collect()
    assert [tuple(r) for r in got] == [("0001", None, 'a "b", c'), ("0002", "1.50", None)]


def test_source_choice():
    assert choose_source("a", "b") == "a"
    assert choose_source(None, "b") == "b"
    with pytest.raises(ValueError):
        choose_source(None, None)


def test_labels_thresholds_and_rounding(spark):
    df = spark.createDataFrame([("Yes", 0.5), ("No", 0.4), ("?", 0.6)], "t string, p double")
    got = df.select(
        encode_label(F.col("t"), "Yes", "No"), at_least(F.col("p")), argmax_class(F.col("p"))
    ).collect()
    assert [tuple(r) for r in got] == [(1.0, 1, 0), (0.0, 0, 0), (None, 1, 1)]
    rng = random.Random(1)
    values = [0.03125, 0.00015, 0.63245, 0.12345, 2.5e-5, -0.03125, 0.0, 1.0, 1234.56785, None]
    values += [rng.uniform(-2, 2) for _ in range(300)]
    values += [rng.randrange(20_000) / 2e4 for _ in range(2000)]
    values += [rng.randrange(4096) / 4096 for _ in range(300)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    rounded = [r[0] for r in df.select(report_round("v")).collect()]
    assert rounded == [None if v is None else round(v, 4) for v in values]
