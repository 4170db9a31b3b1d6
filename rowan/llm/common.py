"""Expressions and session helpers that the corpus operators share."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

#: Space, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = " \t\n\x0b\x0c\r"
BLANK_RUN = r"[\x20\x09-\x0D]+"

#: Stand for a missing id where a key is needed: below and above every id.
LEAST_ID = -(2**63)
MOST_ID = 2**63 - 1


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once, however often and deep body refers to it."""
    return F.transform(F.array(value), body)[0]


def whole_text(text: Column) -> Column:
    """The text; a null one is empty."""
    return F.coalesce(text.cast("string"), F.lit(""))


def words(text: Column) -> Column:
    """The maximal runs of characters other than BLANKS, in order."""
    trimmed = F.btrim(text, F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, BLANK_RUN))


def ascii_lower(text: Column) -> Column:
    """A-Z to a-z and nothing else. Pure ASCII takes the cheaper built-in."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def hash_pair(value: Column) -> tuple[Column, Column]:
    """128 bits of hash as two longs."""
    return F.xxhash64(value), F.xxhash64(F.lit(1), value)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
