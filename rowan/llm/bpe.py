"""Byte-level BPE encoding and decoding, by recursive DuckDB queries inside Spark tasks.

A task splits its texts by the tokenizer's pattern and keeps the ids of the words it has met. New words
go, as rows of token and position, to a recursive query that joins neighbouring tokens with the merge
table and contracts each word's leftmost pair of least rank until none is left. Decoding joins ids with
the vocabulary and aggregates their bytes in order.

A long stretch without a break is cut into overlapping pieces of PIECE bytes, encoded like words of their own.
Ids are those of the whole where every two neighbours among them are what they encode to together, so two pieces
may be joined behind a token that both have at the same place. Pieces that share none are encoded again as one,
so that the work grows with the length of a stretch unless its tokens hang on each other over long distances.

Memory in a task is bounded: texts are taken in batches, new words in blocks, and the words kept are
let go beyond WORDS_KEPT. No rows are shuffled, so a hot source or group costs no more than other rows.

Defined cases: a null or empty text has no tokens and decodes to nothing; a null id stays null; repeated
rows are encoded each for itself; an empty table gives an empty result; further columns are ignored or
carried, whatever their names.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowan.llm.common import whole_text

#: Words whose ids a task keeps in each of two generations; bytes of new words and tokens that a query
#: takes at a time.
WORDS_KEPT = 350_000
BLOCK_BYTES = 800_000
BLOCK_TOKENS = 1_000_000
#: Characters of text that a task encodes at a time; a longer text is taken alone.
BATCH_CHARS = 2_500_000
#: Longer pieces contract all pairs of least rank in a round, where that cannot change the result.
LONG = 48
#: Bytes of a piece of a long stretch, and how many of them it shares with the next.
PIECE = 48
SHARED = 24

#: A mark names one pair of all, so that windows need not heed where a word ends.
_LEFTMOST = """
WITH RECURSIVE state(word, pos, token, after, done) AS (
  SELECT word, pos, token, after, false FROM start
  UNION ALL (
    WITH ranked AS (
      SELECT word, pos, token, after, rank, (rank::BIGINT << 32) + pos AS mark
      FROM state LEFT JOIN merge ON first = token AND second = after WHERE NOT done
    ), low AS (
      SELECT word AS of_word, min(mark) AS least FROM ranked GROUP BY word
    ), seen AS (
      SELECT ranked.*, least, lag(mark) OVER near AS before, lead(mark) OVER near AS next_mark,
        lead(rank) OVER near AS next_rank, lead(after) OVER near AS next_after
      FROM ranked JOIN low ON word = of_word
      WINDOW near AS (ORDER BY pos)
    )
    SELECT word, pos, CASE WHEN mark = least THEN rank ELSE token END,
      CASE WHEN mark = least THEN next_after WHEN next_mark = least THEN next_rank ELSE after END, least IS NULL
    FROM seen WHERE least IS NULL OR before IS DISTINCT FROM least
  )
)
SELECT pos, token FROM state WHERE done ORDER BY pos
"""

#: As above, but all non-overlapping pairs of the least rank at once. A rank whose product could take
#: part in a merge of lower rank (`alone`) still contracts its leftmost pair only.
_ALL_OF_A_RANK = """
WITH RECURSIVE state(word, pos, token, done) AS (
  SELECT word, pos, token, false FROM start
  UNION ALL (
    WITH pair AS (
      SELECT word, pos, token, lead(token) OVER (PARTITION BY word ORDER BY pos) AS after FROM state WHERE NOT done
    ), ranked AS (
      SELECT word, pos, token, rank, alone, min(rank) OVER (PARTITION BY word) AS least,
        row_number() OVER (PARTITION BY word ORDER BY pos) AS n
      FROM pair LEFT JOIN merge ON first = token AND second = after
    ), marked AS (
      SELECT *, coalesce(rank = least, false) AS hit,
        n - row_number() OVER (PARTITION BY word, coalesce(rank = least, false) ORDER BY pos) AS run
      FROM ranked
    ), chosen AS (
      SELECT *, hit AND row_number() OVER (PARTITION BY word, hit, run ORDER BY pos) % 2 = 1
          AND (NOT alone OR row_number() OVER (PARTITION BY word, hit ORDER BY pos) = 1) AS contract
      FROM marked
    ), told AS (
      SELECT *, lag(contract) OVER (PARTITION BY word ORDER BY pos) AS swallowed FROM chosen
    )
    SELECT word, pos, CASE WHEN contract THEN rank ELSE token END, least IS NULL
    FROM told WHERE NOT coalesce(swallowed, false)
  )
)
SELECT pos, token FROM state WHERE done ORDER BY pos
"""

#: One thread aggregates in the order of the subquery; sorting once is cheaper than in each group.
_DECODE = """
SELECT text, string_agg(piece, '') AS whole
FROM (SELECT text, piece FROM ids JOIN vocabulary USING (id) ORDER BY pos)
GROUP BY text ORDER BY text
"""


class _Places(dict):
    """Numbers words in the order in which they are first asked for."""

    def __missing__(self, word: str) -> int:
        place = self[word] = len(self)
        return place


class _Known:
    """Words met, with their ids one after another in one array."""

    def __init__(self) -> None:
        self.places = _Places()
        self.ends, self.ids = array("q", [0]), array("i")

    def keep(self, lists: Iterable[Sequence[int]]) -> None:
        """The ids of the words numbered last, in their order."""
        for ids in lists:
            self.ids.extend(ids)
            self.ends.append(len(self.ids))

    def ids_at(self, place: int) -> array:
        return self.ids[self.ends[place] : self.ends[place + 1]]

    def gather(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the words at the places in a row, and how many each has."""
        ends = np.array(self.ends, np.int64)
        begins, sizes = ends[places], ends[places + 1] - ends[places]
        shift = begins - (np.cumsum(sizes) - sizes)
        take = np.repeat(shift, sizes) + np.arange(sizes.sum())
        return np.array(self.ids, np.int32)[take], sizes


def _seam(a: tuple[int, np.ndarray, np.ndarray], b: tuple[int, np.ndarray, np.ndarray]) -> int:
    """The end of the first token that both pieces have at the same place and that has a next one in the
    second; -1 if there is none."""
    own = a[1] >= b[0]
    both = np.flatnonzero(np.isin(b[1][:-1], a[1][own]))
    for k in both:
        j = int(np.searchsorted(a[1], b[1][k]))
        # The last token of the first piece is cut short perhaps, one that both have is not.
        if j + 1 < len(a[1]) and a[1][j + 1] == b[1][k + 1] and a[2][j] == b[2][k]:
            return int(b[1][k + 1])
    return -1


class Coder:
    """A rank file and pattern, with the DuckDB tables made from them; one for each Python worker."""

    def __init__(self, ranks_path: str, pattern: str) -> None:
        import duckdb
        import regex

        with open(ranks_path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines)}
        self.pattern = regex.compile(pattern)
        self.byte_token = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        self.joins = np.zeros((256, 256), bool)
        merges = []
        for token, rank in self.ranks.items():
            for k in range(1, len(token)):
                self.joins[token[k - 1], token[k]] = True
                if (a := self.ranks.get(token[:k])) is not None and (b := self.ranks.get(token[k:])) is not None:
                    merges.append((a, b, rank))
        first, second, rank = np.array(merges, np.int32).T
        made = np.array([len(t) > 1 for t in self.ranks], bool)
        by_rank = np.zeros(max(self.ranks.values()) + 1, bool)
        by_rank[list(self.ranks.values())] = made
        early = np.zeros(len(by_rank), bool)
        for part in (first, second):
            early[part[(rank < part) & by_rank[part]]] = True
        self.db = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "400MB", "temp_directory": ""})
        self._table("merge", first=first, second=second, rank=rank, alone=early[rank])
        self.pieces = {r: t for t, r in self.ranks.items()}
        size = max(self.pieces) + 1
        pieces = [self.pieces.get(i, b"").decode("latin-1") for i in range(size)]
        self._table("vocabulary", id=np.arange(size, dtype=np.int32), piece=pieces)
        self._forget()

    def _table(self, name: str, **columns) -> None:
        rows = pa.table(columns)
        self.db.register("given", rows)
        self.db.execute(f"CREATE OR REPLACE TABLE {name} AS SELECT * FROM given")
        self.db.unregister("given")

    def _forget(self) -> None:
        """Starts a new generation: words that it meets again are taken over from the one before, and
        the one before that goes."""
        self.older = self.newer if hasattr(self, "newer") else _Known()
        self.newer = _Known()

    def _ids_of(self, words: list[str]) -> list[Sequence[int]]:
        """The ids of new words: known before, in the vocabulary as they are, or by their merges."""
        lists: list[Sequence[int]] = [()] * len(words)
        hard: list[int] = []
        data: list[bytes] = []
        size, older = 0, self.older.places.get
        for k, word in enumerate(words):
            if (place := older(word)) is not None:
                lists[k] = self.older.ids_at(place)
                continue
            raw = word.encode()
            if (token := self.ranks.get(raw)) is not None:
                lists[k] = (token,)
                continue
            hard.append(k)
            data.append(raw)
            size += len(raw)
            if size >= BLOCK_BYTES:
                self._merge(data, hard, lists)
                hard, data, size = [], [], 0
        if hard:
            self._merge(data, hard, lists)
        return lists

    def _merge(self, words: list[bytes], to: list[int], lists: list[Sequence[int]]) -> None:
        data = np.frombuffer(b"".join(words), np.uint8)
        starts = np.cumsum([0, *map(len, words)])
        # No merge reaches over two bytes that are neighbours in no token.
        cut = np.ones(len(data), bool)
        cut[1:] = ~self.joins[data[:-1], data[1:]]
        cut[starts[:-1]] = True
        begins = np.flatnonzero(cut)
        sizes = np.diff(np.append(begins, len(data)))
        short = np.repeat(sizes <= PIECE, sizes)
        stretch = np.cumsum(cut) - 1
        pos = np.arange(len(data), dtype=np.int32)
        parts = [self._contract(_LEFTMOST, stretch[short], pos[short], self.byte_token[data[short]])]
        long = sizes > PIECE
        parts += [self._long(data, begins[long], sizes[long])] if long.any() else []
        pos, tokens = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(pos, kind="stable")
        tokens, ends = tokens[order].tolist(), np.searchsorted(pos[order], starts).tolist()
        for k, a, b in zip(to, ends, ends[1:], strict=False):
            lists[k] = tokens[a:b]

    def _long(self, data: np.ndarray, begins: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and ids of the tokens of stretches longer than a piece."""
        step = PIECE - SHARED
        counts = np.maximum(1, -(-(sizes - SHARED) // step))
        of = np.repeat(np.arange(len(sizes)), counts)
        nth = np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)
        low = begins[of] + nth * step
        high = np.minimum(low + PIECE, (begins + sizes)[of])
        # Encoded pieces, in order: where each begins, the places of its tokens and their ids.
        done: list[tuple[int, np.ndarray, np.ndarray]] = self._pieces(data, low, high)
        stop = high
        while True:
            # Behind which token each piece takes over from the one before it; -1 where none is shared.
            seam = np.array([-1] + [_seam(a, b) for a, b in zip(done, done[1:], strict=False)])
            first = np.append(True, of[1:] != of[:-1])
            lost = (seam < 0) & ~first
            if not lost.any():
                break
            heads, tails = np.flatnonzero(~lost), np.append(np.flatnonzero(~lost)[1:], len(of)) - 1
            grown = heads != tails
            again = iter(self._pieces(data, low[heads[grown]], stop[tails[grown]]))
            done = [next(again) if g else done[h] for g, h in zip(grown, heads, strict=True)]
            of, low, stop = of[heads], low[heads], stop[tails]
        places, tokens = [], []
        for k, (_, at, ids) in enumerate(done):
            begin = seam[k] if not first[k] else at[0]
            end = seam[k + 1] if k + 1 < len(done) and not first[k + 1] else stop[k]
            own = (at >= begin) & (at < end)
            places.append(at[own])
            tokens.append(ids[own])
        return np.concatenate(places), np.concatenate(tokens)

    def _pieces(self, data: np.ndarray, low: np.ndarray, high: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray]]:
        """The tokens of every piece, with their places in the data."""
        out = []
        begin = 0
        sizes = high - low
        while begin < len(low):
            end = max(begin + 1, int(np.searchsorted(np.cumsum(sizes[begin:]), BLOCK_BYTES, side="right")) + begin)
            n = sizes[begin:end]
            piece = np.repeat(np.arange(end - begin), n)
            shift = low[begin:end] - (np.cumsum(n) - n)
            own = np.arange(n.sum(), dtype=np.int32)
            at = own + np.repeat(shift, n)
            tokens = self.byte_token[data[at]]
            query = _LEFTMOST if n.max() <= LONG else _ALL_OF_A_RANK
            pos, ids = self._contract(query, piece, own, tokens)
            ends = np.searchsorted(pos, np.cumsum(n))
            begins = np.append(0, ends[:-1])
            out += [(int(low[begin + k]), at[pos[a:b]], ids[a:b]) for k, (a, b) in enumerate(zip(begins, ends, strict=True))]
            begin = end
        return out

    def _contract(self, query: str, word: np.ndarray, pos: np.ndarray, token: np.ndarray):
        if not len(pos):
            return pos, token
        follows = np.append(word[1:] == word[:-1], False)
        after = pa.array(np.append(token[1:], 0).astype(np.int32), mask=~follows)
        start = {"word": word.astype(np.int32), "pos": pos, "token": token, "after": after}
        self.db.register("start", pa.table(start))
        got = self.db.execute(query).fetchnumpy()
        self.db.unregister("start")
        return np.asarray(got["pos"]), np.asarray(got["token"]).astype(np.int32)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in a row, and how many each text has."""
        if len(self.newer.places) > WORDS_KEPT:
            self._forget()
        split = [self.pattern.findall(text) for text in texts]
        met, counts = len(self.newer.places), [len(words) for words in split]
        number = map(self.newer.places.__getitem__, chain.from_iterable(split))
        places = np.fromiter(number, np.int64, sum(counts))
        if len(self.newer.places) > met:
            self.newer.keep(self._ids_of(list(islice(self.newer.places, met, None))))
        ids, sizes = self.newer.gather(places)
        ends = np.concatenate([[0], np.cumsum(sizes)])
        return ids, np.diff(ends[np.cumsum([0, *counts])])

    def decode(self, ids: np.ndarray, sizes: np.ndarray) -> list[bytes]:
        """The bytes of each run of ids. Texts are decoded in blocks of whole texts."""
        out, at, ends = [], 0, np.cumsum(sizes)
        while at < len(sizes):
            begin = ends[at] - sizes[at]
            to = max(at + 1, int(np.searchsorted(ends, begin + BLOCK_TOKENS, side="right")))
            out += self._decoded(ids[begin : ends[to - 1]], sizes[at:to])
            at = to
        return out

    def _decoded(self, ids: np.ndarray, sizes: np.ndarray) -> list[bytes]:
        out = [b""] * len(sizes)
        text = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        self.db.register("ids", pa.table({"text": text, "pos": np.arange(len(ids), dtype=np.int32), "id": ids}))
        for k, whole in self.db.execute(_DECODE).fetchall():
            out[k] = whole.encode("latin-1")
        self.db.unregister("ids")
        return out


@lru_cache(maxsize=2)
def coder(ranks_path: str, pattern: str) -> Coder:
    return Coder(ranks_path, pattern)


def _blocks(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Stretches of the list that fit BATCH_CHARS, or a single longer text."""
    at, size = 0, 0
    for k, text in enumerate(texts):
        size += len(text)
        if size >= BATCH_CHARS:
            yield at, k + 1
            at, size = k + 1, 0
    if at < len(texts):
        yield at, len(texts)


def _lists(ids: np.ndarray, sizes: np.ndarray) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum(sizes)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))


def encode_texts(
    docs: DataFrame, carried: list[str], ranks_path: str, pattern: str, text: str = "text", decode: bool = False
) -> DataFrame:
    """row (a struct of the carried columns) and ids (array<int>) of every text; with `decode` also
    decoded, the bytes that those ids stand for."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(ranks_path, pattern)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for at, to in _blocks(texts):
                ids, sizes = own.encode(texts[at:to])
                out = {"row": batch.column(0).slice(at, to - at), "ids": _lists(ids, sizes)}
                if decode:
                    out["decoded"] = pa.array(own.decode(ids, sizes), pa.binary())
                yield pa.RecordBatch.from_pydict(out)

    given = docs.select(F.struct(*carried).alias("row"), whole_text(F.col(text)).alias("text"))
    schema = T.StructType([given.schema["row"], T.StructField("ids", T.ArrayType(T.IntegerType()))])
    if decode:
        schema = schema.add("decoded", T.BinaryType())
    return given.mapInArrow(task, schema)


def decode_ids(rows: DataFrame, ranks_path: str, pattern: str, ids: str = "ids") -> DataFrame:
    """row (a struct of the input's columns) and decoded: the bytes of its ids; a null list has none."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(ranks_path, pattern)
        for batch in batches:
            lists = [np.array(x or [], np.int32) for x in batch.column(1).to_pylist()]
            flat = np.concatenate([*lists, np.zeros(0, np.int32)])
            decoded = own.decode(flat, np.array([len(x) for x in lists], np.int64))
            yield pa.RecordBatch.from_pydict({"row": batch.column(0), "decoded": pa.array(decoded, pa.binary())})

    given = rows.select(F.struct("*").alias("row"), F.col(ids).alias("ids"))
    return given.mapInArrow(task, T.StructType([given.schema["row"], T.StructField("decoded", T.BinaryType())]))


def digests() -> list[Column]:
    """n_tokens and the hashes of the decimal ids, joined by one space, and of the decoded bytes."""
    return [
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    ]
