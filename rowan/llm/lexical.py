"""Ranked lexical search: pair-bound MaxScore over blocks of documents.

The index is a table. A task cuts its documents into blocks and writes, for every block, one row with its
documents' ids and lengths and one row for every term with its postings; no text is shuffled. Statistics are
sums over these rows. Before a batch of queries runs, `impact_lists` turns the postings of its terms into
impacts and intersects the postings of its term pairs: a pair's list holds the documents with both terms and
what both together give, its maximum being what no document of the block exceeds for the pair. Every list also tells its MOST-th highest impact: so many documents have at least that.

A query pairs its terms by falling weight, each with the next one. In a block the most that a pair can give is
the largest of either term alone and of both together, which is often far below the sum of the two maxima, as
the document where one term counts most need not hold the other. Pairs are taken from the largest bound down
and their impacts added to all their documents; once the bounds of the pairs left fall below the score that
the last of the best has already, no document unseen can enter, and the rest is looked up only for documents
whose score and remaining bounds still reach it. The search of a block starts from the best MOST-th highest
impact that any list of the query has in any block, so that blocks whose bounds stay below are passed over
whole. Scores are whole numbers and exact; nothing is approximated.

The best of every block meet in two steps, by query and group of blocks, then by query. Queries come in parts
of PART_QUERIES, a task holds one part and one block. A query reaches a block through the terms they share.

Defined cases: null and empty texts hold no terms, are not counted and never found; rows that repeat, by id or
whole, are documents each and may be found each; a null id is a document like any other and comes after those
that tie with it; items that repeat id and text are one query; items of one id and different texts are queries
of their own, each ranked from 1; items without terms, or with terms that no document holds, find nothing;
empty tables give an empty result; further columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from array import array
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from rowan.llm.common import whole_text
from rowan.sources.scratch import written

MOST = 20
BLOCK_DOCS = 65_536
BLOCK_BYTES = 64 << 20
PART_QUERIES = 1_000
#: Blocks whose best meet first.
GROUP_BLOCKS = 256

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

_INDEX = "block long, term string, at array<int>, tf array<int>, ids array<long>, lengths array<long>"
_INDEX_ARROW = pa.schema(
    [
        ("block", pa.int64()),
        ("term", pa.string()),
        ("at", pa.list_(pa.int32())),
        ("tf", pa.list_(pa.int32())),
        ("ids", pa.list_(pa.int64())),
        ("lengths", pa.list_(pa.int64())),
    ]
)
#: In UTF-8 every byte of a term's character is a digit, a letter or above 0x7F; all others become blanks.
_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b > 0x7F else 0x20
    for b in range(256)
)


def terms_of(text: Column) -> Column:
    """The terms of a text in order, repeats included."""
    folded = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.regexp_extract_all(folded, F.lit(_TERM), F.lit(0))


class _Numbers(dict):
    """Numbers its keys in the order they are first asked for."""

    def __missing__(self, key: bytes) -> int:
        self[key] = number = len(self)
        return number


class _Block:
    def __init__(self) -> None:
        self.ids: list[int | None] = []
        self.lengths, self.sizes = array("q"), array("i")
        self.terms, self.numbers, self.tfs = _Numbers(), array("i"), array("i")
        self.bytes = 0

    def add(self, doc_id: int | None, text: bytes) -> None:
        found = text.translate(_FOLD).split(b" ")
        counts = Counter(found)
        blanks = counts.pop(b"", 0)
        if not counts:
            return
        self.ids.append(doc_id)
        self.lengths.append(len(found) - blanks)
        self.sizes.append(len(counts))
        self.numbers.extend(map(self.terms.__getitem__, counts))
        self.tfs.extend(counts.values())
        self.bytes += len(text)

    @property
    def full(self) -> bool:
        return len(self.ids) >= BLOCK_DOCS or self.bytes >= BLOCK_BYTES

    def batches(self, block: int) -> Iterator[pa.RecordBatch]:
        """Documents in the order of their ids, then the postings of every term in that order."""
        n = len(self.ids)
        order = sorted(range(n), key=lambda k: (self.ids[k] is None, self.ids[k] or 0))
        place = np.empty(n, np.int32)
        place[order] = np.arange(n, dtype=np.int32)
        lengths = np.array(self.lengths)[order]
        yield _index_batch(block, ids=[[self.ids[k] for k in order]], lengths=[lengths])
        numbers, tfs = np.array(self.numbers), np.array(self.tfs, np.int32)
        at = np.repeat(place, np.array(self.sizes))
        by_term = np.lexsort((at, numbers))
        at, tfs = at[by_term], tfs[by_term]
        ends = np.cumsum(np.bincount(numbers))
        names = [t.decode("utf-8", "replace") for t in self.terms]
        for low in range(0, len(names), 8192):
            high = min(low + 8192, len(names))
            first = ends[low - 1] if low else 0
            offsets = pa.array(np.concatenate([[first], ends[low:high]]) - first, pa.int32())
            span = slice(first, ends[high - 1])
            lists = (pa.ListArray.from_arrays(offsets, pa.array(x[span], pa.int32())) for x in (at, tfs))
            yield _index_batch(block, names[low:high], *lists)


def _index_batch(block: int, term=None, at=None, tf=None, ids=None, lengths=None) -> pa.RecordBatch:
    n = len(term if term is not None else ids)
    columns = [[block] * n, term, at, tf, ids, lengths]
    filled = (c if isinstance(c, pa.Array) else pa.array([None] * n if c is None else c, f.type)
              for c, f in zip(columns, _INDEX_ARROW, strict=True))
    return pa.RecordBatch.from_arrays(list(filled), schema=_INDEX_ARROW)


def _indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    # Blocks are named by task and number in it: a task that runs again names its own alike.
    number = TaskContext.get().partitionId() << 32
    block = _Block()
    for batch in batches:
        for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
            block.add(doc_id.as_py(), text.as_py())
            if block.full:
                yield from block.batches(number)
                block, number = _Block(), number + 1
    if block.ids:
        yield from block.batches(number)


def build_index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The index table, written: a row with ids and lengths for every block (term null), and a row with
    at (places in ids) and tf for every term of it."""
    body = whole_text(F.col(text)).cast("binary")
    given = docs.select(F.col(doc_id).cast("long").alias("doc_id"), body.alias("body"))
    return written(given.mapInArrow(_indexed, _INDEX))


def _asked(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """part, query, item_id, term and n (its repeats) of every query."""
    queries = items.select(F.col(item_id).alias("item_id"), whole_text(F.col(text)).alias("body")).distinct()
    queries = queries.select("item_id", F.xxhash64("item_id", "body").alias("query"), terms_of(F.col("body")).alias("t"))
    parts = max(1, math.ceil(items.count() / PART_QUERIES))
    part = F.pmod(F.col("query"), F.lit(parts)).cast("int").alias("part")
    return queries.select(part, "query", "item_id", F.explode("t").alias("term")).groupBy(
        "part", "query", "item_id", "term"
    ).agg(F.count("*").alias("n"))


@dataclass(frozen=True)
class Sizes:
    """Blocks, documents with a term, and the sum of their lengths."""

    blocks: int
    docs: int
    total: int


def index_sizes(index: DataFrame) -> Sizes:
    length = F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)
    sums = index.where("term IS NULL").agg(F.count("*"), F.sum(F.size("ids")), F.sum(length)).first()
    return Sizes(*(int(x or 0) for x in sums))


def query_terms(index: DataFrame, sizes: Sizes, items: DataFrame, item_id: str, text: str) -> DataFrame:
    """For every part and term: weight, the queries that use it (with the number of the pair it has there) and
    the terms it is paired with."""
    asked = written(_asked(items, item_id, text))
    postings = index.where("term IS NOT NULL").select("term", F.size("at").alias("held"))
    held = postings.join(asked.select("term").distinct(), "term").groupBy("term").agg(F.sum("held").alias("df"))
    weight = F.floor(1000 * F.ln(F.lit(2.0 * sizes.docs + 2) / (2 * F.col("df") + 1))).alias("weight")
    known = asked.join(held.select("term", weight), "term")
    # A window over the terms of one query.
    own = Window.partitionBy("part", "query", "item_id").orderBy(F.desc("weight"), "term")
    turn = F.row_number().over(own) - 1
    known = known.withColumn("pair", F.floor(turn / 2).cast("int")).withColumn(
        "partner", F.when(turn % 2 == 0, F.lead("term").over(own))
    )
    uses = F.collect_list(F.struct("query", "item_id", "n", "pair")).alias("uses")
    partners = F.sort_array(F.collect_set("partner")).alias("partners")
    return known.groupBy("part", "term", "weight").agg(uses, partners)


_LISTS = "block long, part int, term string, other string, most long, nth long, at array<int>, gain array<long>"
_LISTS_ARROW = pa.schema(
    [
        ("block", pa.int64()),
        ("part", pa.int32()),
        ("term", pa.string()),
        ("other", pa.string()),
        ("most", pa.int64()),
        ("nth", pa.int64()),
        ("at", pa.list_(pa.int32())),
        ("gain", pa.list_(pa.int64())),
    ]
)


def _values(lists: pa.ChunkedArray) -> list[np.ndarray]:
    """A numpy view of every list; empty where there is none."""
    whole = lists.combine_chunks()
    ends, values = whole.offsets.to_numpy(), whole.values.to_numpy(zero_copy_only=False)
    return [values[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]


def _nth(values: np.ndarray, n: int) -> int:
    """The n-th highest; zero where there are fewer."""
    return int(np.partition(values, len(values) - n)[len(values) - n]) if len(values) >= n else 0


def _lists(sizes: Sizes, top: int) -> Callable[[tuple, pa.Table, pa.Table], pa.Table]:
    def task(key: tuple, postings: pa.Table, blocks: pa.Table) -> pa.Table:
        out: dict[str, list] = {f.name: [] for f in _LISTS_ARROW}
        if len(postings):
            lengths = _values(blocks.column("lengths"))[0]
            norm = 12 * (100 - 25 + (25 * lengths * sizes.docs) // sizes.total)
            terms = postings.column("term").to_pylist()
            weights = postings.column("weight").to_numpy()
            rows = zip(terms, weights, _values(postings.column("at")), _values(postings.column("tf")), strict=True)
            held = {t: (at, w * ((10**9 * tf.astype(np.int64)) // (1000 * tf + norm[at]))) for t, w, at, tf in rows}
            pairs = [
                (a, b) for a, others in zip(terms, postings.column("partners").to_pylist(), strict=True) for b in others
            ]

            def tell(term: str, other: str | None, at: np.ndarray, gain: np.ndarray) -> None:
                row = (key[0].as_py(), key[1].as_py(), term, other, int(gain.max(initial=0)), _nth(gain, top), at, gain)
                for column, value in zip(out.values(), row, strict=True):
                    column.append(value)

            for term, (at, gain) in held.items():
                tell(term, None, at, gain)
            for a, b in pairs:
                if b in held:
                    (at, gain), (at_b, gain_b) = held[a], held[b]
                    both, i, j = np.intersect1d(at, at_b, assume_unique=True, return_indices=True)
                    tell(a, b, both, gain[i] + gain_b[j])
        return pa.table(out, schema=_LISTS_ARROW)

    return task


def _blocks(index: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows with ids and lengths, once for every part of the queries."""
    last = wanted.agg(F.max("part")).first()[0] or 0
    part = F.explode(F.sequence(F.lit(0), F.lit(last))).alias("part")
    # Under an alias, as postings of the same table meet these rows.
    return index.where("term IS NULL").select(F.col("block").alias("block"), part, "ids", "lengths")


def impact_lists(index: DataFrame, sizes: Sizes, wanted: DataFrame, top: int = MOST) -> DataFrame:
    """For every block and part: the impacts of each term, and of each pair (other not null) where both are."""
    postings = index.where("term IS NOT NULL").select("block", "term", "at", "tf")
    postings = postings.join(wanted.select("part", "term", "weight", "partners"), "term")
    blocks = _blocks(index, wanted).select("block", "part", "lengths")
    grouped = postings.groupBy("block", "part").cogroup(blocks.groupBy("block", "part"))
    return grouped.applyInArrow(_lists(sizes, top), _LISTS)


_BEST = "item_id {}, query long, block long, doc_id long, score long"


class _Query:
    """One query in one block."""

    def __init__(self) -> None:
        self.pairs: dict[int, list[tuple[str, int]]] = {}

    def bounds(self, lists: dict, most: dict) -> list[tuple[int, list[tuple[np.ndarray, np.ndarray]]]]:
        """For every pair with a term in the block: the most it can give, and its terms' impacts; largest first."""
        out = []
        for held in self.pairs.values():
            alone = [n * most[t, None] for t, n in held]
            bound = sum(alone)
            if len(held) == 2:
                (a, n), (b, m) = held
                both = most.get((a, b), most.get((b, a)))
                # Terms that never meet have an empty list, whose maximum is zero.
                bound = max(*alone, bound if both is None else min(bound, max(n, m) * both))
            out.append((bound, [(lists[t][0], lists[t][1] * n) for t, n in held]))
        return sorted(out, key=lambda g: -g[0])

    def least(self, reach: dict) -> int:
        """What the last of the best has at least, by lists of any block; scores count from one."""
        known = [n * reach[t, None] for held in self.pairs.values() for t, n in held]
        for held in self.pairs.values():
            if len(held) == 2:
                (a, n), (b, m) = held
                known.append(min(n, m) * reach.get((a, b), reach.get((b, a), 0)))
        return max(1, *known)

    def best(self, lists: dict, most: dict, reach: dict, docs: int, top: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the highest, equal ones by place, without those that cannot be among the best
        of all blocks."""
        groups, least = self.bounds(lists, most), self.least(reach)
        left = np.append(np.cumsum([g[0] for g in groups][::-1])[::-1], 0)
        score = np.zeros(docs, np.int64)
        k = 0
        while k < len(groups) and left[k] >= least:
            for at, gain in groups[k][1]:
                score[at] += gain
            k += 1
            least = max(least, _nth(score, top))
        at = np.flatnonzero(score + left[k] >= least)
        score = score[at]
        for j in range(k, len(groups)):
            for held, gain in groups[j][1]:
                place = np.minimum(np.searchsorted(held, at), len(held) - 1)
                score += np.where(held[place] == at, gain[place], 0)
            least = max(least, _nth(score, top))
            on = score + left[j + 1] >= least
            at, score = at[on], score[on]
        order = np.lexsort((at, -score))[:top]
        return at[order], score[order]


def _searched(top: int, schema: pa.Schema) -> Callable[[tuple, pa.Table, pa.Table], pa.Table]:
    def task(key: tuple, rows: pa.Table, blocks: pa.Table) -> pa.Table:
        out: dict[str, list] = {f.name: [] for f in schema}
        if len(rows):
            ids = blocks.column("ids")[0].values
            names = list(zip(rows.column("term").to_pylist(), rows.column("other").to_pylist(), strict=True))
            most = dict(zip(names, rows.column("most").to_pylist(), strict=True))
            reach = dict(zip(names, rows.column("reach").to_pylist(), strict=True))
            values = zip(names, _values(rows.column("at")), _values(rows.column("gain")), strict=True)
            lists = {t: (at, gain) for (t, other), at, gain in values if other is None}
            queries: dict[tuple, _Query] = {}
            for (term, other), uses in zip(names, rows.column("uses").to_pylist(), strict=True):
                for use in uses if other is None else ():
                    query = queries.setdefault((use["item_id"], use["query"]), _Query())
                    query.pairs.setdefault(use["pair"], []).append((term, use["n"]))
            for (item, number), query in queries.items():
                at, score = query.best(lists, most, reach, len(ids), top)
                n = len(at)
                block = key[0].as_py()
                found = ([item] * n, [number] * n, [block] * n, ids.take(pa.array(at)).to_pylist(), score.tolist())
                for column, value in zip(out.values(), found, strict=True):
                    column += value
        return pa.table(out, schema=schema)

    return task


def _top(rows: DataFrame, by: list[str], most: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def ranked(
    index: DataFrame, items: DataFrame, most: int = MOST, item_id: str = "item_id", text: str = "text"
) -> DataFrame:
    """item_id, rank, doc_id and score: the highest-scoring documents of every item."""
    sizes = index_sizes(index)
    wanted = written(query_terms(index, sizes, items, item_id, text))
    lists = written(impact_lists(index, sizes, wanted, most))
    # What a list reaches in its best block. Pairs are told by their maxima alone: their lists stay where they are.
    single = F.col("other").isNull()
    name = ["part", "term", F.coalesce("other", F.lit("")).alias("pair")]
    reach = lists.groupBy(*name).agg(F.max("nth").alias("reach"))
    uses = wanted.select("part", "term", F.lit("").alias("pair"), "uses")
    told = reach.join(uses, ["part", "term", "pair"], "left")
    kept = [F.when(single, F.col(c)).alias(c) for c in ("at", "gain")]
    rows = lists.select("block", "other", "most", *name, *kept).join(told, ["part", "term", "pair"])
    blocks = _blocks(index, wanted).select("block", "part", "ids")
    kind = items.schema[item_id].dataType
    schema = pa.schema(
        [("item_id", to_arrow_type(kind)), *((c, pa.int64()) for c in ("query", "block", "doc_id", "score"))]
    )
    grouped = rows.groupBy("block", "part").cogroup(blocks.groupBy("block", "part"))
    found = grouped.applyInArrow(_searched(most, schema), _BEST.format(kind.simpleString()))
    groups = max(1, math.ceil(sizes.blocks / GROUP_BLOCKS))
    by, group = ["item_id", "query"], F.pmod(F.xxhash64("block"), F.lit(groups))
    first = _top(found.withColumn("group", group), [*by, "group"], most)
    last = _top(first.drop("rank"), by, most)
    return last.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
