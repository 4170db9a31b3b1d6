from __future__ import annotations

import hashlib
import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rowan.operators.split import (
    allocate,
    clamp_folds,
    fold_sizes,
    holdout_counts,
    inner_split,
    key_hash,
    stratified_folds,
    stratified_split,
)


def labelled(spark, n, positives, partitions=1):
    return spark.range(0, n, 1, partitions).select(
        F.concat(F.lit("k"), "id").alias("key"),
        F.when(F.col("id") < positives, 1.0).otherwise(0.0).alias("label"),
    )


def test_sizes_of_the_published_run():
    held = holdout_counts({"1.0": 1869, "0.0": 5174}, 0.2)
    assert (sum(held.values()), held["1.0"]) == (1409, 374)
    inner = holdout_counts({"1.0": 1495, "0.0": 4139}, 0.2)
    assert sum(inner.values()) == 1127


@given(st.integers(2, 5000), st.integers(2, 5000), st.floats(0.05, 0.95))
@settings(max_examples=200)
def test_holdout_sizes_are_exact_and_proportional(a, b, fraction):
    n = a + b
    held = math.ceil(fraction * n)
    if held < 2 or n - held < 2:
        with pytest.raises(ValueError):
            holdout_counts({"0": a, "1": b}, fraction)
        return
    counts = holdout_counts({"0": a, "1": b}, fraction)
    assert sum(counts.values()) == held
    assert all(abs(counts[c] - held * size / n) <= 1 for c, size in (("0", a), ("1", b)))


@given(st.integers(1, 500), st.integers(1, 500), st.integers(2, 10))
def test_folds_differ_by_at_most_one(a, b, k):
    dealt = fold_sizes({"0": a, "1": b}, k)
    for sizes in (*dealt.values(), [sum(s) for s in zip(*dealt.values(), strict=True)]):
        assert max(sizes) - min(sizes) <= 1
    assert [sum(d) for d in dealt.values()] == [a, b]


def test_split_takes_the_smallest_hashes_of_each_class(spark):
    df = labelled(spark, 7043, 1869)
    split = stratified_split(df, "label", "key", 0.2, 42)
    got = {r["key"] for r in df.filter(split.is_held_out).collect()}
    want = set()
    for keys, n in (([f"k{i}" for i in range(1869)], 374), ([f"k{i}" for i in range(1869, 7043)], 1035)):
        want |= set(sorted(keys, key=lambda k: hashlib.md5(f"42:{k}".encode()).hexdigest())[:n])
    assert got == want
    assert split.kept == {"0.0": 4139, "1.0": 1495}


def test_split_does_not_depend_on_partitioning(spark):
    rows = []
    for partitions in (1, 8):
        df = labelled(spark, 500, 100, partitions)
        split = stratified_split(df, "label", "key", 0.25, 7)
        rows.append({r["key"] for r in df.filter(split.is_held_out).collect()})
    assert rows[0] == rows[1]


def test_split_and_folds_need_no_shuffle(spark):
    df = labelled(spark, 500, 100)
    split = stratified_split(df, "label", "key", 0.25, 7)
    folds = stratified_folds(df, "label", "key", 3, 7)
    plan = df.select(split.is_held_out, folds.fold)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_repeated_keys_cannot_be_split_silently(spark):
    df = labelled(spark, 100, 50).withColumn("key", F.lit("same"))
    with pytest.raises(ValueError, match="repeat"):
        stratified_split(df, "label", "key", 0.2, 1)


def test_small_classes(spark):
    df = labelled(spark, 5, 1)
    with pytest.raises(ValueError, match="at least two rows"):
        stratified_split(df, "label", "key", 0.2, 1)
    assert inner_split(df, "label", "key", 0.2, 1, {"0.0": 4, "1.0": 1}) is None
    assert inner_split(df, "label", "key", 0.0, 1, {"0.0": 4, "1.0": 4}) is None


@given(st.integers(20, 400), st.integers(2, 7))
@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_fold_counts(spark, n, k):
    df = labelled(spark, n, n // 2)
    folds = stratified_folds(df, "label", "key", k, 3)
    got = df.groupBy("label", folds.fold.alias("f")).count().collect()
    counts = {(str(r["label"]), r["f"]): r["count"] for r in got}
    want = {(c, f): s for c, sizes in folds.dealt.items() for f, s in enumerate(sizes) if s}
    assert counts == want


def test_clamp_and_allocate():
    assert clamp_folds(5, {"0": 4, "1": 9}) == 4
    assert clamp_folds(5, {"0": 1, "1": 9}) == 0
    assert allocate({"a": 3, "b": 3, "c": 4}, 5) == {"a": 2, "b": 1, "c": 2}


def test_composite_keys_do_not_collide(spark):
    keys = [("a:b", "c"), ("a", "b:c"), (None, "x"), ("x", None), ("x", ""), (None, None), ("a,b", "c")]
    df = spark.createDataFrame(keys, "k string, l string")
    assert df.select(key_hash(["k", "l"], 1).alias("h")).distinct().count() == len(keys)
