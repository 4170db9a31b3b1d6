from __future__ import annotations

import random

import pytest

from rowan.llm.components import components
from rowan.llm.simhash import close_pairs, keep_one_of_each, near_duplicates
from tests.llm.plain import AWKWARD, awkward, fingerprint, groups, ordered


def expected(rows, most_bits):
    prints = {t: fingerprint(t) for _, t in rows}
    root = groups(sorted(set(prints.values())), lambda a, b: (a ^ b).bit_count() <= most_bits)
    least: dict[int, int] = {}
    for i, t in rows:
        if i is not None:
            group = root[prints[t]]
            least[group] = min(least.get(group, i), i)
    return [(i, f"{prints[t]:016x}", least.get(root[prints[t]])) for i, t in rows]


def varied(seed, copies=30):
    draw = random.Random(seed)
    base = [f"w{draw.randrange(400)}" for _ in range(300)]
    rows = []
    for i in range(copies):
        words = list(base)
        for _ in range(draw.randrange(4)):
            words[draw.randrange(len(words))] = f"z{draw.randrange(50)}"
        rows.append((draw.randrange(1000) * 3 + i % 3, " ".join(words)))
    return rows


def test_awkward_rows(spark):
    got = near_duplicates(awkward(spark)).collect()
    assert ordered(got) == ordered(expected(AWKWARD, 2))


@pytest.mark.parametrize("most_bits", [0, 1, 2, 3])
def test_links_at_every_radius(spark, most_bits):
    rows = varied(5)
    got = near_duplicates(awkward(spark, rows), most_bits=most_bits).collect()
    assert ordered(got) == ordered(expected(rows, most_bits))


def test_pairs_connect_what_brute_force_connects(spark):
    draw = random.Random(3)
    values = {draw.getrandbits(64)}
    while len(values) < 60:
        values.add(draw.choice(sorted(values)) ^ (1 << draw.randrange(64)) ^ (1 << draw.randrange(8)))
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    pairs = close_pairs(spark.createDataFrame([(v,) for v in signed], "fp long"), 2)
    for r in pairs.collect():
        assert ((r["a"] ^ r["b"]) & (2**64 - 1)).bit_count() <= 2
    want = groups(sorted(signed), lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count() <= 2)
    got = dict(map(tuple, components(pairs).collect()))
    assert {n: got.get(n, n) for n in signed} == want


def test_long_chain_is_one_component(spark):
    edges = [(i, i + 1) for i in range(200)] + [(500, 501), (7, 7)]
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert dict(map(tuple, got)) == {**{i: 0 for i in range(201)}, 500: 500, 501: 500}
    assert len(got) == 203


def test_no_edges(spark):
    assert components(spark.createDataFrame([(3, 3)], "a long, b long")).count() == 0


def test_one_of_each_stays(spark):
    docs = awkward(spark)
    kept = keep_one_of_each(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    prints = [fingerprint(r["text"]) for r in rows]
    every = {fingerprint(t) for _, t in AWKWARD}
    root = groups(sorted(every), lambda a, b: (a ^ b).bit_count() <= 2)
    assert sorted(root[p] for p in prints) == sorted(set(root.values()))
    assert {r["doc_id"] for r in rows} == {c for _, _, c in expected(AWKWARD, 2)}


def test_empty_table(spark):
    assert near_duplicates(awkward(spark).limit(0)).count() == 0
    assert keep_one_of_each(awkward(spark).limit(0)).count() == 0
