from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pytest

from rowan.llm.lexical import _Query, build_index, index_sizes, impact_lists, query_terms, ranked
from tests.llm.plain import AWKWARD, LOWER, awkward, ordered

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def plain(rows, items, most=20):
    """Every document scored for every item."""
    docs = [(i, Counter(terms(t))) for i, t in rows]
    docs = [(i, c, sum(c.values())) for i, c in docs if c]
    total = sum(n for _, _, n in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    weight = {t: math.floor(1000 * math.log((2 * len(docs) + 2) / (2 * n + 1))) for t, n in df.items()}
    out = []
    for item, text in dict.fromkeys(items):
        scored = []
        for i, c, n in docs:
            m = 100 - 25 + (25 * n * len(docs)) // total
            score = sum(weight[t] * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t in terms(text) if t in c)
            if score:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, k + 1, s[3], -s[0]) for k, s in enumerate(sorted(scored, key=lambda s: s[:3])[:most])]
    return ordered(out)


def searched(spark, docs, items, most=20):
    table = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS term", "2 AS block")
    found = ranked(build_index(docs), table, most)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    return ordered(found.collect())


def corpus(n, seed=3):
    draw = np.random.default_rng(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    share = 1 / np.arange(1, 401)
    share /= share.sum()
    sizes = draw.integers(1, 120, n)
    return [(int(k), " ".join(draw.choice(vocabulary, s, p=share))) for k, s in enumerate(sizes)]


@pytest.mark.parametrize("docs_in_block", [150, 30])
def test_same_as_scoring_every_document(spark, docs_in_block):
    rows = corpus(600)
    draw = np.random.default_rng(4)
    items = [(k, " ".join(f"w{w}" for w in draw.integers(0, 420, s))) for k, s in enumerate([1, 2, 3, 9, 40, 200])]
    items += [(9, "w1 w1 W1 w2"), (9, "w1 w1 W1 w2"), (9, "w300"), (10, None), (11, ""), (12, "unheard of")]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(600 // docs_in_block)
    most = 20 if docs_in_block > 100 else 3
    assert searched(spark, table, items, most) == plain(rows, items, most)


def test_awkward_documents(spark):
    items = [(1, "word5x5 passage1 again"), (2, "É 汉字 nbsp em\x85nel X 1"), (3, "a" * 50_000), (None, "own line of SIX")]
    assert searched(spark, awkward(spark), items) == plain(AWKWARD, items)


def test_ties_come_by_id_across_blocks(spark):
    rows = [(k, "the same words") for k in range(100, 0, -1)] + [(None, "the same words"), (200, "other")]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = searched(spark, table, [(1, "same the")])
    assert [(r[1], r[2]) for r in sorted(got, key=lambda r: r[1])] == [(k, k) for k in range(1, 21)]


def test_empty_tables(spark):
    docs = awkward(spark)
    assert searched(spark, docs.limit(0), [(1, "word")]) == []
    table = spark.createDataFrame([], "item_id long, text string")
    assert ranked(build_index(docs), table).count() == 0


def test_pair_lists_hold_the_joint_maximum(spark):
    rows = corpus(300)
    table = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    index = build_index(table)
    sizes = index_sizes(index)
    items = spark.createDataFrame([(1, "w3 w7 w50 w120")], "item_id long, text string")
    wanted = query_terms(index, sizes, items, "item_id", "text")
    lists = impact_lists(index, sizes, wanted).collect()
    single = {r["term"]: dict(zip(r["at"], r["gain"], strict=True)) for r in lists if r["other"] is None}
    pairs = [r for r in lists if r["other"] is not None]
    assert len(single) == 4 and len(pairs) == 2
    for r in pairs:
        a, b = single[r["term"]], single[r["other"]]
        both = {k: a[k] + b[k] for k in a.keys() & b.keys()}
        assert dict(zip(r["at"], r["gain"], strict=True)) == both and r["most"] == max(both.values(), default=0)


def test_pair_bounds_are_tighter_than_those_of_terms(spark):
    at, gain = np.arange(4, dtype=np.int32), np.array([9, 1, 1, 1])
    lists = {"a": (at, gain), "b": (at, gain[::-1].copy())}
    query = _Query()
    query.pairs = {0: [("a", 1), ("b", 1)]}
    most = {("a", None): 9, ("b", None): 9}
    assert query.bounds(lists, most)[0][0] == 18
    assert query.bounds(lists, most | {("a", "b"): 10})[0][0] == 10
