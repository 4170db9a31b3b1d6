"""Substring dedup: words inside a window that an earlier document also has are removed.

Every window of fixed length gets a rolling (Rabin-Karp) hash. Map tasks hash their documents with numpy
and settle repeats among them; the first owner of each hash goes, packed, to the bucket of its hash,
where Spark brings all its owners together and the least document keeps it. Window starts that others
had earlier go on, packed, by document and merge into maximal removal intervals.

A window moves as seven bytes of its hash and about two bytes more, once. Hashes deal windows out evenly:
copies of one passage meet in as many buckets as it has windows, and a map task sends one owner of each, so
that no bucket grows with the size of a group of copies. The hash's first byte is left to the bucket: with
256 buckets or more all 64 bits are compared, and among n windows about n^2 / 2^65 pairs are mistaken
(0.0006 in all for 1.5e8 windows; with 100 buckets four times that).

Defined cases: a null or blank text has no words; a null id counts as greater than all others, and two
null ids as equal; rows that repeat an id never remove each other's words; documents shorter than a
window lose nothing; an empty table gives an empty result; further columns are ignored or carried,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowan.llm.common import MOST_ID, let, shuffle_partitions, whole_text, words

WINDOW = 13
#: Text that a map task hashes and settles at a time; a longer document is taken alone.
CHUNK_BYTES = 16 << 20
BLOCK_BYTES = 2 << 20

_U = np.uint64
_PACKED = pa.schema(
    [
        ("bucket", pa.int32()), ("hashes", pa.binary()), ("ids", pa.binary()), ("tags", pa.binary()),
        ("counts", pa.binary()), ("steps", pa.binary()),
    ]
)
_PACKED_TYPES = "bucket int, hashes binary, ids binary, tags binary, counts binary, steps binary"

_BLANK = np.zeros(256, bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True
_BYTE = np.random.default_rng(20250101).integers(1, 2**63, 256, dtype=np.int64).astype(_U)


class _Powers:
    """Powers of an odd base modulo 2^64 and of its inverse."""

    def __init__(self, base: int) -> None:
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, _U)

    def reach(self, n: int) -> None:
        if len(self.up) < n:
            n = max(n, 2 * len(self.up))
            with np.errstate(over="ignore"):
                self.up, self.down = (
                    np.concatenate([np.ones(1, _U), np.cumprod(np.full(n - 1, x, _U), dtype=_U)])
                    for x in (self.base, self.inverse)
                )


_IN_WORD, _IN_WINDOW = _Powers(0x9E3779B97F4A7C15), _Powers(0xD6E8FEB86659FD93)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> _U(31))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(29))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(32))


def _stretch_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers: _Powers) -> np.ndarray:
    """Polynomial hash of values[start:end] for each pair, from one running sum."""
    powers.reach(len(values))
    total = np.zeros(len(values) + 1, _U)
    np.cumsum(values * powers.up[: len(values)], out=total[1:])
    return _mixed((total[ends] - total[starts]) * powers.down[starts])


def window_hashes(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, document and first word of every window. data: the UTF-8 bytes of all documents;
    offsets: where each begins, and the end."""
    inside = ~_BLANK[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    doc = np.searchsorted(offsets, starts, side="right") - 1
    each = _stretch_hashes(_BYTE[data], starts, ends, _IN_WORD)
    begin = np.flatnonzero(doc[width - 1 :] == doc[: len(doc) - width + 1]) if len(doc) >= width else starts[:0]
    hashes = _stretch_hashes(each, begin, begin + width, _IN_WINDOW) if len(begin) else each[:0]
    place = begin - np.searchsorted(doc, doc[begin])
    return hashes, doc[begin], place


def _planes(values: np.ndarray, size: int) -> bytes:
    """Little-endian bytes, byte 0 of all values first: small values then compress well."""
    return values.astype(f"<u{size}").view(np.uint8).reshape(-1, size).T.tobytes()


def _unplaned(packed: bytes, size: int) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(packed, np.uint8).reshape(size, -1).T).view(f"<u{size}").ravel()


def _bytes_of(hashes: np.ndarray) -> np.ndarray:
    return hashes.astype("<u8").view(np.uint8).reshape(-1, 8)


def _seven_bytes(packed: bytes) -> np.ndarray:
    hashes = np.zeros(len(packed) // 7, "<u8")
    hashes.view(np.uint8).reshape(-1, 8)[:, :7] = np.frombuffer(packed, np.uint8).reshape(-1, 7)
    return hashes


def _pack(bucket: int, hashes: np.ndarray | None, doc: np.ndarray, place: np.ndarray, ids, tags) -> dict:
    """doc ascends, and place within each."""
    head = np.flatnonzero(np.diff(doc, prepend=-1))
    steps = np.diff(place, prepend=0)
    steps[head] = place[head]
    own = ids[doc[head]].view(_U)
    return {
        "bucket": bucket,
        "hashes": None if hashes is None else np.ascontiguousarray(_bytes_of(hashes)[:, :7]).tobytes(),
        "ids": _planes(np.diff(own, prepend=_U(0)), 8),
        "tags": _planes(tags[doc[head]], 4),
        "counts": _planes(np.diff(np.append(head, len(doc))), 4),
        "steps": _planes(steps, 4),
    }


def _unpack(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """ids, tags, counts by document; place of every window."""
    counts, steps = _unplaned(row["counts"], 4).astype(np.int64), _unplaned(row["steps"], 4).astype(np.int64)
    run, head = np.cumsum(steps), np.cumsum(counts) - counts
    place = run - np.repeat(run[head] - steps[head], counts)
    return np.cumsum(_unplaned(row["ids"], 8), dtype=_U).view(np.int64), _unplaned(row["tags"], 4), counts, place


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held, size = [], 0
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            held.append(part := batch.slice(start, 256))
            size += part.get_total_buffer_size() if part.num_rows == batch.num_rows else part.nbytes
            if size >= CHUNK_BYTES:
                yield pa.Table.from_batches(held)
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def _hashed(table: pa.Table, width: int) -> tuple[np.ndarray, ...]:
    """Hash, document (its place in the table) and first word of the table's windows, block by block."""
    texts = table.column("text").cast(pa.large_binary()).combine_chunks()
    texts = texts.chunk(0) if isinstance(texts, pa.ChunkedArray) else texts
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    found, at = [], 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + BLOCK_BYTES, side="right")) - 1)
        hashes, doc, place = window_hashes(data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at], width)
        found.append((hashes, (doc + at).astype(np.int32), place.astype(np.int32)))
        at = to
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _settled(table: pa.Table, width: int, labels: list[int], to: int) -> Iterator[dict]:
    """Packed rows of one chunk: the windows it must ask about, by bucket, and those it settles itself."""
    table = table.sort_by("id")
    ids = table.column("id").to_numpy()
    tags = table.column("tag").to_numpy()
    hashes, doc, place = _hashed(table, width)
    if not len(hashes):
        return
    buckets = len(labels)
    order = np.argsort(hashes, kind="stable")  # ids ascend within a hash
    ordered = hashes[order]
    head = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    owner = ids[doc[order[head]]]
    later = np.zeros(len(hashes), bool)
    later[order] = ids[doc[order]] > np.repeat(owner, np.diff(np.append(head, len(order))))
    if later.any():
        yield _pack(labels[to % buckets], None, doc[later], place[later], ids, tags)
    ask = np.flatnonzero(~later)
    bucket = ((hashes[ask] >> _U(32)) * _U(buckets) >> _U(32)).astype(np.int64)
    dealt = ask[np.argsort(bucket, kind="stable")]
    ends = np.cumsum(np.bincount(bucket, minlength=buckets))
    for k, (a, b) in enumerate(zip(np.concatenate([[0], ends[:-1]]), ends, strict=True)):
        if b > a:
            mine = dealt[a:b]
            yield _pack(labels[k], hashes[mine], doc[mine], place[mine], ids, tags)


def _dealer(width: int, labels: list[int]):
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        for number, table in enumerate(_chunks(batches)):
            for row in _settled(table, width, labels, task + 31 * number):
                yield pa.RecordBatch.from_pylist([row], schema=_PACKED)

    return deal


def _told(ids: np.ndarray, tags: np.ndarray, doc: np.ndarray, place: np.ndarray, labels: list[int]) -> Iterator[dict]:
    """Packed rows of window starts, dealt out by document. doc ascends, and place within each."""
    to = (_mixed(ids.view(_U) ^ _mixed(tags.astype(_U))) % _U(len(labels))).astype(np.int64)[doc]
    dealt = np.argsort(to, kind="stable")
    ends = np.cumsum(np.bincount(to, minlength=len(labels)))
    for label, a, b in zip(labels, np.concatenate([[0], ends[:-1]]), ends, strict=True):
        if b > a:
            mine = dealt[a:b]
            yield _pack(label, None, doc[mine], place[mine], ids, tags)


def _owners(labels: list[int]):
    """Of one bucket of hashes: the window starts that a smaller id has too, by document."""

    def judge(table: pa.Table) -> pa.Table:
        out, asked = [], []
        for row in table.to_pylist():
            ids, tags, counts, place = _unpack(row)
            doc = np.repeat(np.arange(len(ids)), counts)
            if row["hashes"] is None:
                out += _told(ids, tags, doc, place, labels)
            else:
                asked.append((_seven_bytes(row["hashes"]), ids, tags, counts, place))
        if asked:
            hashes, ids, tags, counts, place = (np.concatenate(x) for x in zip(*asked, strict=True))
            doc = np.repeat(np.arange(len(ids)), counts)
            order = np.argsort(hashes, kind="stable")
            ordered, owners = hashes[order], ids[doc[order]]
            head = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
            least = np.repeat(np.minimum.reduceat(owners, head), np.diff(np.append(head, len(order))))
            late = np.sort(order[owners > least])
            out += _told(ids, tags, doc[late], place[late], labels)
        return pa.Table.from_pylist(out, schema=_PACKED)

    return judge


def _by_document(table: pa.Table) -> pa.Table:
    """All window starts of the documents dealt here, sorted, one row for each document."""
    parts = [_unpack(row) for row in table.to_pylist()]
    ids, tags, counts, place = (np.concatenate(x) for x in zip(*parts, strict=True))
    ids, tags = np.repeat(ids, counts), np.repeat(tags, counts)
    order = np.lexsort((place, tags, ids))
    ids, tags, place = ids[order], tags[order], place[order]
    head = np.flatnonzero(np.concatenate([[True], (ids[1:] != ids[:-1]) | (tags[1:] != tags[:-1])]))
    bounds = pa.array(np.append(head, len(ids)), pa.int32())
    return pa.table(
        {
            "id": pa.array(ids[head], pa.int64()),
            "tag": pa.array(tags[head], pa.int64()),
            "starts": pa.ListArray.from_arrays(bounds, pa.array(place, pa.int32())),
        }
    )


def _labels(spark: SparkSession, count: int) -> list[int]:
    """As many bucket labels, which Spark's hash deals to as many partitions, one to each."""
    deal = F.pmod(F.hash(F.col("id").cast("int")), F.lit(count)).alias("to")
    least = spark.range(32 * count + 64).select("id", deal).groupBy("to").agg(F.min("id").alias("id"))
    found = {r["id"] for r in least.collect()}
    spare = (x for x in range(count + len(found)) if x not in found)
    return sorted([*found, *(next(spare) for _ in range(count - len(found)))])


def removed_starts(docs: DataFrame, width: int = WINDOW, buckets: int | None = None) -> DataFrame:
    """docs: id, tag, text. id, tag and the sorted starts of the windows that an earlier document has.

    buckets: two for each shuffle partition unless given; a bucket's hashes must fit a task's memory.
    """
    spark = docs.sparkSession
    labels = _labels(spark, buckets or 2 * shuffle_partitions(spark))
    packed = docs.select("id", "tag", "text").mapInArrow(_dealer(width, labels), _PACKED_TYPES)
    late = packed.groupBy("bucket").applyInArrow(_owners(labels), _PACKED_TYPES)
    return late.groupBy("bucket").applyInArrow(_by_document, "id long, tag long, starts array<int>")


def _kept(tokens: Column, starts: Column, width: int) -> Column:
    """The words that no window covers: stretches between neighbouring windows."""

    def stretches(w: Column, s: Column) -> Column:
        begins = F.concat(F.array(F.lit(0)), F.transform(s, lambda p: p + width))
        ends = F.concat(s, F.array(F.size(w)))
        parts = F.arrays_zip(begins.alias("a"), ends.alias("b"))
        open_parts = F.filter(parts, lambda p: p["b"] > p["a"])
        return F.flatten(F.transform(open_parts, lambda p: F.slice(w, p["a"] + 1, p["b"] - p["a"])))

    return F.when(F.size(starts) == 0, tokens).otherwise(let(tokens, lambda w: let(starts, lambda s: stretches(w, s))))


def dedup_substrings(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WINDOW, buckets: int | None = None
) -> DataFrame:
    """row (a struct of the input's columns), n_words, n_removed and kept, the array of remaining words."""
    keyed = (
        F.coalesce(F.col(doc_id).cast("long"), F.lit(MOST_ID)).alias("id"),
        F.crc32(whole_text(F.col(text))).alias("tag"),
    )
    bare = docs.select(*keyed, whole_text(F.col(text)).alias("text"))
    starts = removed_starts(bare, width, buckets)
    met = docs.select(F.struct("*").alias("row"), *keyed).join(starts, ["id", "tag"], "left")
    parted = met.select(
        "row",
        words(whole_text(F.col("row")[text])).alias("words"),
        F.coalesce("starts", F.array().cast("array<int>")).alias("starts"),
    ).withColumn("kept", _kept(F.col("words"), F.col("starts"), width))
    return parted.select(
        "row",
        F.size("words").cast("long").alias("n_words"),
        (F.size("words") - F.size("kept")).cast("long").alias("n_removed"),
        "kept",
    )
