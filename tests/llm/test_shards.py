from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from rowan.llm.shards import shard_of, sharded, with_shards, with_slots, write_shards
from tests.llm.plain import AWKWARD, awkward, ordered


def plain_shard(key, weights):
    def bid(i):
        digits = hashlib.md5(f"{'' if key is None else key}:{i}".encode()).hexdigest()[:13]
        return -weights[i] / math.log((int(digits, 16) + 0.5) / 16**13), -i

    return max(range(len(weights)), key=bid)


def test_documents_against_a_plain_loop(spark):
    got = sharded(awkward(spark)).collect()
    want = []
    for i, t in AWKWARD:
        body = (t or "").encode()
        want.append((i, len(body) + 1, zlib.crc32(body), "key", plain_shard(i, [1] * 16), plain_shard(i, [1] * 17)))
    assert ordered(
        (r["doc_id"], r["size"], r["text_crc32"], r["law"], r["shard"], r["grown_shard"]) for r in got
    ) == ordered(want)
    held = defaultdict(list)
    for r in got:
        held[r["shard"]].append(r)
    for rows in held.values():
        rows.sort(key=lambda r: r["slot"])
        assert [r["slot"] for r in rows] == list(range(len(rows)))
        keys = [(-1 if r["doc_id"] is None else r["doc_id"], r["size"], r["text_crc32"]) for r in rows]
        assert keys == sorted(keys)


def test_a_hot_key_is_numbered_without_gaps(spark):
    rows = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"))
    got = with_slots(with_shards(rows.repartition(5), "k", [1.0] * 4), "shard", ["k"])
    held = defaultdict(list)
    for r in got.collect():
        held[r["shard"]].append((r["slot"], r["k"]))
    assert sum(map(len, held.values())) == 9000
    for rows in held.values():
        rows.sort()
        assert [s for s, _ in rows] == list(range(len(rows)))
        assert [k for _, k in rows] == sorted(k for _, k in rows)


def moves(spark, before, after):
    got = spark.range(20_000).select(shard_of(F.col("id"), before).alias("a"), shard_of(F.col("id"), after).alias("b"))
    return {(r["a"], r["b"]): r["count"] for r in got.groupBy("a", "b").count().collect()}


def test_weights_are_met(spark):
    weights = [1.0, 2.0, 0.0, 5.0]
    got = Counter(r["s"] for r in spark.range(20_000).select(shard_of(F.col("id"), weights).alias("s")).collect())
    assert set(got) == {0, 1, 3}
    for s, n in got.items():
        assert abs(n / 20_000 - weights[s] / 8) < 0.02


def test_changes_move_only_what_they_must(spark):
    grown = moves(spark, [1.0] * 8, [1.0] * 9)
    assert all(a == b or b == 8 for a, b in grown)
    assert abs(sum(n for (a, b), n in grown.items() if a != b) / 20_000 - 1 / 9) < 0.02
    gone = moves(spark, [1.0] * 8, [1.0] * 3 + [0.0] + [1.0] * 4)
    assert all(a == b or a == 3 for a, b in gone)
    heavier = moves(spark, [1.0] * 8, [1.0] * 7 + [2.0])
    assert all(a == b or b == 7 for a, b in heavier)


def test_placement_repeats_elsewhere(spark):
    weights = [1.0, 3.0, 0.5]
    got = spark.range(500).select("id", shard_of(F.col("id"), weights).alias("s")).collect()
    assert all(r["s"] == plain_shard(r["id"], weights) for r in got)


@pytest.mark.parametrize("weights", [[], [0.0], [-1.0], [float("inf")], [float("nan"), 0.0]])
def test_no_shard_to_go_to(spark, weights):
    with pytest.raises(ValueError, match="positive"):
        shard_of(F.col("id"), weights)


def test_empty_table(spark):
    assert sharded(awkward(spark).limit(0)).count() == 0


def test_written_shards_hold_every_row_in_order(spark, tmp_path):
    rows = with_slots(with_shards(awkward(spark), "doc_id", [1.0] * 3), "shard", ["doc_id"])
    write_shards(rows, f"{tmp_path}/out", 2)
    back = spark.read.parquet(f"{tmp_path}/out").select("doc_id", "text", "shard", "slot").collect()
    assert ordered(back) == ordered(rows.select("doc_id", "text", "shard", "slot").collect())
    assert all(len(r) <= 2 for r in [spark.read.parquet(str(f)).collect() for f in tmp_path.rglob("*.parquet")])
