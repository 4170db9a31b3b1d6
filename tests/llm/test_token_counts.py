from __future__ import annotations

import base64
import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rowan.llm.token_counts import (
    length_histogram, length_quantiles, limit_table, token_lengths, truncated_totals,
)
from tests.llm.plain import AWKWARD, awkward

tokenizers = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")
FILE, PATTERN = tokenizers.path("byte_bpe_50k.tiktoken"), tokenizers.PATTERN


@pytest.fixture(scope="module")
def sizes():
    with open(FILE, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    library = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return [len(library.encode_ordinary(t or "")) for _, t in AWKWARD]


@pytest.fixture(scope="module")
def table(spark):
    return limit_table(length_histogram(token_lengths(awkward(spark), FILE, PATTERN))).persist()


def test_limit_table(table, sizes):
    rows = table.collect()
    assert {r["n_tokens"]: r["docs"] for r in rows} == Counter(sizes)
    for r in rows:
        limit = r["n_tokens"]
        assert r["docs_over"] == sum(s > limit for s in sizes)
        assert r["tokens_over"] == sum(s for s in sizes if s > limit)
        assert r["total_docs"] == len(sizes) and r["total_tokens"] == sum(sizes)
        assert r["truncated_tokens"] == sum(min(s, limit) for s in sizes)


def test_any_limit(table, sizes):
    limits = [1, 2, 17, 511, 512, 513, 4096, 10**7]
    got = {r["context_limit"]: r["truncated_tokens"] for r in truncated_totals(table, limits).collect()}
    assert got == {x: sum(min(s, x) for s in sizes) for x in limits}


def test_quantiles(table, sizes):
    shares = [0.01, 0.25, 0.5, 0.9, 1.0]
    got = {r["share"]: r["n_tokens"] for r in length_quantiles(table, shares).collect()}
    assert got == {x: sorted(sizes)[math.ceil(x * len(sizes)) - 1] for x in shares}


def test_groups_with_a_null_one(spark, sizes):
    lengths = token_lengths(awkward(spark), FILE, PATTERN, by=F.col("lang"))
    rows = limit_table(length_histogram(lengths)).collect()
    for name in ("en", None):
        own = [s for k, s in enumerate(sizes) if (k % 2 == 1) == (name == "en")]
        mine = [r for r in rows if r["by"] == name]
        assert {r["n_tokens"]: r["docs"] for r in mine} == Counter(own)
        assert all(r["truncated_tokens"] == sum(min(s, r["n_tokens"]) for s in own) for r in mine)


def test_empty_table(spark):
    empty = limit_table(length_histogram(token_lengths(awkward(spark).limit(0), FILE, PATTERN)))
    assert empty.count() == 0
    assert truncated_totals(empty, [5]).count() == 0
