"""SimHash near-dedup by meeting in the middle.

A fingerprint takes the majority of each bit over the hashes of a document's shingles. Two fingerprints
within r bits meet in some value at most half as far from either: every distinct fingerprint emits all
values of its ball, the shuffle brings equal values together, and colliding pairs are verified.
Copies share a fingerprint and emit once, so no value can gather more fingerprints than a ball holds.

Defined cases: null, empty and blank texts have fingerprint zero, which links like any other; texts with
fewer words than a shingle are one shingle; a null id stays null and never becomes a component's id
unless the component has no other; every input row gives one result row, repeated rows included; an
empty table gives an empty result; further columns are ignored or carried, whatever their names.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowan.llm.common import MOST_ID, ascii_lower, let, shuffle_partitions, whole_text, words
from rowan.llm.components import components
from rowan.sources.scratch import written

SHINGLE_WORDS = 3
MOST_BITS = 2
_BITS = 64
_LOW = 0x0000000100000001


def shingle_hashes(text: Column, width: int) -> Column:
    """XXH64 (seed 42) of each shingle, repeats included."""

    def hashed(w: Column) -> Column:
        each = F.transform(
            F.sequence(F.lit(0), F.size(w) - width),
            lambda i: F.xxhash64(F.concat_ws(" ", *(F.get(w, i + k) for k in range(width)))),
        )
        none = F.array().cast("array<bigint>")
        short = F.when(F.size(w) == 0, none).otherwise(F.array(F.xxhash64(F.array_join(w, " "))))
        return F.when(F.size(w) >= width, each).otherwise(short)

    return let(words(ascii_lower(text)), hashed)


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = SHINGLE_WORDS) -> DataFrame:
    """id, body (hash of the text), rows (how many rows have both), fp; one row per id and body.

    Bit counts are summed in pairs, bit k in the low half of a long and bit k + 32 in the high half.
    Rows that repeat id and text only multiply the counts, which leaves the majority as it is.
    """
    body = whole_text(F.col(text))
    keyed = docs.select(
        F.col(doc_id).cast("long").alias("id"),
        F.xxhash64(body).alias("body"),
        shingle_hashes(body, width).alias("hashes"),
    )
    # Apart from the step above, or the hash of the text would be taken anew for every shingle.
    spread = keyed.select("id", "body", F.posexplode_outer("hashes").alias("place", "h"))
    counts = [
        F.coalesce(F.sum(F.shiftrightunsigned("h", k).bitwiseAND(F.lit(_LOW))), F.lit(0)).alias(f"c{k}")
        for k in range(_BITS // 2)
    ]
    summed = spread.groupBy("id", "body").agg(
        F.count("h").alias("n"), F.sum(F.when(F.coalesce("place", F.lit(0)) == 0, 1)).alias("rows"), *counts
    )

    def bit(k: int) -> Column:
        pair = F.col(f"c{k % 32}")
        count = F.shiftrightunsigned(pair, 32) if k >= 32 else pair.bitwiseAND(F.lit(0xFFFFFFFF))
        return F.when(2 * count > F.col("n"), F.shiftleft(F.lit(1).cast("long"), k)).otherwise(F.lit(0).cast("long"))

    fp = reduce(lambda a, b: a.bitwiseOR(b), (bit(k) for k in range(_BITS)))
    return summed.select("id", "body", "rows", fp.alias("fp"))


def _ball(radius: int) -> list[int]:
    """All masks of up to `radius` bits, as signed longs."""
    masks = (sum(1 << b for b in bits) for r in range(radius + 1) for bits in combinations(range(_BITS), r))
    return [m - (1 << _BITS) if m >> (_BITS - 1) else m for m in masks]


def close_pairs(prints: DataFrame, most_bits: int = MOST_BITS) -> DataFrame:
    """prints: a column fp of distinct values. Pairs a, b within most_bits that connect all that are.

    Under each shared value the least fingerprint of the near ball is paired with all others there. Any
    two fingerprints in reach share a value in one's near and the other's far ball, so no link between
    groups is lost, while pairs grow with fingerprints and not with their square.
    """
    if not 0 <= most_bits <= 4:
        raise ValueError("balls are practical up to 4 bits")
    near, far = most_bits // 2, most_bits - most_bits // 2
    inner = len(_ball(near))
    masks = F.array(
        *(F.struct(F.lit(m).alias("m"), F.lit(k < inner).alias("near")) for k, m in enumerate(_ball(far)))
    )
    # Dealt out first: a small table's few partitions would each become a hundred times as many rows.
    dealt = prints.repartition(shuffle_partitions(prints.sparkSession), "fp")
    spread = dealt.select("fp", F.explode(masks).alias("v"))
    variants = spread.select("fp", F.col("fp").bitwiseXOR(F.col("v.m")).alias("value"), "v.near")
    middle = F.min(F.when(F.col("near"), F.col("fp"))).over(Window.partitionBy("value"))
    met = variants.select("fp", middle.alias("least")).where("least <> fp")
    pairs = met.where(F.bit_count(F.col("fp").bitwiseXOR(F.col("least"))) <= most_bits)
    return pairs.select(F.col("least").alias("a"), F.col("fp").alias("b")).distinct()


def linked(prints: DataFrame, most_bits: int = MOST_BITS) -> DataFrame:
    """fp, root (a fingerprint that names the component) and component, the least id reachable from it.

    prints: id and fp, in any number.
    """
    least_id = F.min(F.coalesce("id", F.lit(MOST_ID))).alias("least")
    distinct = written(prints.groupBy("fp").agg(least_id))
    roots = components(close_pairs(distinct, most_bits)).toDF("fp", "root")
    named = distinct.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    group = written(named)
    least = written(group.groupBy("root").agg(F.min("least").alias("component")))
    return group.join(least, "root").select("fp", "root", F.nullif("component", F.lit(MOST_ID)).alias("component"))


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    width: int = SHINGLE_WORDS,
    most_bits: int = MOST_BITS,
) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id of every row."""
    prints = written(fingerprints(docs, doc_id, text, width))
    groups = written(linked(prints, most_bits))
    rows = prints.join(groups, "fp").withColumn("row", F.explode(F.sequence(F.lit(1), F.col("rows"))))
    return rows.select(
        F.col("id").alias("doc_id"),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def keep_one_of_each(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    width: int = SHINGLE_WORDS,
    most_bits: int = MOST_BITS,
) -> DataFrame:
    """Of each component the document with the least id (a null one counts as greatest), with its own
    columns; of rows that repeat that id, one."""
    prints = written(fingerprints(docs, doc_id, text, width))
    groups = linked(prints, most_bits)
    rank = F.struct(F.coalesce("id", F.lit(MOST_ID)).alias("__id"), F.col("body").alias("__body"))
    winners = prints.join(groups, "fp").groupBy("root").agg(F.min(rank).alias("w")).select("w.*")
    rows = docs.select(
        F.struct("*").alias("__row"),
        F.coalesce(F.col(doc_id).cast("long"), F.lit(MOST_ID)).alias("__id"),
        F.xxhash64(whole_text(F.col(text))).alias("__body"),
    )
    kept = rows.join(winners, ["__id", "__body"], "left_semi")
    return kept.dropDuplicates(["__id", "__body"]).select("__row.*")
