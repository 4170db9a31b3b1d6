"""Labels, probabilities, predicted classes and report rounding."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F


def first_match(branches: Sequence[tuple[Column, Column]], default: Column | None) -> Column:
    """Value of the first condition that holds, tested in order."""
    condition, value = branches[0]
    cases = F.when(condition, value)
    for condition, value in branches[1:]:
        cases = cases.when(condition, value)
    return cases if default is None else cases.otherwise(default)


def encode_label(c: Column, positive: str, negative: str) -> Column:
    """1.0 for the positive text, 0.0 for the negative one, NULL for anything else."""
    text = c.cast("string")
    return F.when(text == positive, 1.0).when(text == negative, 0.0)


def at_least(probability: Column, threshold: float = 0.5) -> Column:
    """Predicted class by an inclusive threshold."""
    return (probability >= F.lit(float(threshold))).cast("int")


def argmax_class(probability: Column) -> Column:
    """Predicted class of the larger probability; an exact tie is class 0."""
    return (probability > F.lit(0.5)).cast("int")


def positive_probability(vector: Column) -> Column:
    return vector_to_array(vector)[1]


def sigmoid(logit: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-logit))


def report_round(sql: str, digits: int = 4) -> Column:
    """Round the binary value of an expression half-to-even, as reports do.

    Neither ``round`` nor ``bround`` does this (both start from the shortest decimal text), and
    decisions hang on it: ties between rounded scores, flags on rounded rates. The double is
    compared with the midpoint of its two candidates in whole numbers, both times 2**74. It is
    SQL text because one parsed string is far cheaper to build than thirty column objects.
    """
    unit = 10**digits
    x = f"abs(CAST({sql} AS DOUBLE))"
    whole = f"floor({x} * {2**30}D)"
    rest = f"floor(({x} * {2**30}D - {whole}) * {2**44}D)"
    value = f"(CAST({whole} AS DECIMAL(20,0)) * {2**44}BD + CAST({rest} AS DECIMAL(20,0)))"
    lower = f"floor({x} * {unit}D)"
    scaled = f"{value} * {unit}BD"
    middle = f"CAST(2 * {lower} + 1 AS DECIMAL(20,0)) * {2**73}BD"
    up = f"{scaled} > {middle} OR ({scaled} = {middle} AND {lower} % 2 = 1)"
    rounded = f"({lower} + CASE WHEN {up} THEN 1 ELSE 0 END) / {unit}D"
    # Beyond this size the digits asked for are at the end of a double's precision.
    sized = f"CASE WHEN {x} < {2**20}D THEN {rounded} ELSE round({x}, {digits}) END"
    return F.expr(f"CASE WHEN {sql} < 0 THEN -({sized}) WHEN {sql} IS NOT NULL THEN {sized} END")
