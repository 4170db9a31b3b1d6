"""Sharding by weighted rendezvous hashing.

Every shard draws a number for every key, from the md5 of key and shard, and the key goes where
weight / -ln(number) is largest. A shard's draw hangs on nothing but the key and itself: another shard takes
keys only into itself, a shard that goes gives up only its own, and a changed weight moves keys only to or from
its shard. Placement needs no table, no shuffle and no state, and md5 lets any other system repeat it.

Slots number the rows of a shard without a gap, in the order asked for. The rows are dealt by ranges of shard,
order and position in the input, sorted inside the ranges and numbered from the counts of the ranges before.
No task holds a shard: one key may hold any share of the rows, as equal keys are told apart by position.

Defined cases: a null key is a key like any other and shares the shard of the empty one; a null text has no
bytes; shards without a positive weight get nothing, and without any shard the call raises; rows that repeat
are placed and numbered each, and equal ones may swap slots; an empty table gives an empty result; further
columns are carried, whatever their names but those of the results.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowan.llm.common import whole_text
from rowan.sources.scratch import written

SHARDS = 16
#: Hex digits of the hash behind a draw, so many bits that a double holds the draw exactly.
DIGITS = 13


def _draw(key: Column, shard: Column) -> Column:
    """Between 0 and 1, both excluded."""
    digest = F.md5(F.concat_ws(":", F.coalesce(key.cast("string"), F.lit("")), shard.cast("string")))
    number = F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("double")
    return (number + 0.5) / F.lit(float(16**DIGITS))


def shard_of(key: Column, weights: Sequence[float]) -> Column:
    """The shard of a key, by position in `weights`."""
    held = [(float(w), i) for i, w in enumerate(weights) if w > 0]
    if not held or not all(math.isfinite(w) for w, _ in held):
        raise ValueError("Shards need finite weights, at least one of them positive.")
    shards = F.array(*[F.struct(F.lit(w).alias("weight"), F.lit(i).alias("place")) for w, i in held])

    def bid(shard: Column) -> Column:
        # Equal bids go to the smaller number.
        return F.struct((-shard["weight"] / F.ln(_draw(key, shard["place"]))).alias("bid"), (-shard["place"]).alias("p"))

    return -F.array_max(F.transform(shards, bid))["p"]


def with_shards(rows: DataFrame, key: str, weights: Sequence[float], name: str = "shard") -> DataFrame:
    """The rows with the shard of their key."""
    return rows.withColumn(name, shard_of(F.col(key), weights))


def with_slots(rows: DataFrame, shard: str, order: Sequence[str], name: str = "slot") -> DataFrame:
    """The rows with their number inside their shard, from 0, by `order`."""
    mark = uuid.uuid4().hex[:8]
    at, place, part = f"at_{mark}", f"place_{mark}", f"part_{mark}"
    keys = [shard, *order, at]
    # Written, so that neither the ranges' bounds nor a lost executor read other positions than these.
    positions = written(rows.withColumn(at, F.monotonically_increasing_id()))
    ranged = positions.repartitionByRange(*keys).sortWithinPartitions(*keys)
    # The number of the range in the upper bits, of the row in the lower 33.
    placed = written(ranged.withColumn(place, F.monotonically_increasing_id())).withColumn(
        part, F.shiftright(place, 33)
    )
    counts = placed.groupBy(shard, part).agg(F.count("*").alias("n"), F.min(place).alias("first"))
    before = Window.partitionBy(shard).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(shard, part, (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias(mark))
    slotted = placed.join(starts, [shard, part]).withColumn(name, F.col(place) + F.col(mark))
    return slotted.select(*rows.columns, name)


def sharded(
    docs: DataFrame, shards: int = SHARDS, doc_id: str = "doc_id", text: str = "text", weights: Sequence[float] | None = None
) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard, the shard if there were one more."""
    weights = list(weights) if weights is not None else [1.0] * shards
    body = whole_text(F.col(text))
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    rows = with_shards(rows, "doc_id", weights)
    rows = with_shards(rows, "doc_id", [*weights, sum(weights) / len(weights)], "grown_shard")
    return with_slots(rows, "shard", ["doc_id", "size", "text_crc32"])


def write_shards(rows: DataFrame, path: str, rows_per_file: int, shard: str = "shard", slot: str = "slot") -> None:
    """Slotted rows as Parquet, a folder for each shard, its files in the order of slots."""
    file = F.floor(F.col(slot) / rows_per_file)
    dealt = rows.repartition(F.col(shard), file).sortWithinPartitions(shard, slot)
    dealt.write.partitionBy(shard).option("maxRecordsPerFile", rows_per_file).parquet(path)
