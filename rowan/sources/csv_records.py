"""Quoted CSV read in byte ranges, records with line breaks in quotes included.

Where a quote is written as two, a line break lies inside quotes if the quotes before it are odd in number. One
pass counts the quotes of every byte range of the files, prefix sums over the ranges tell on which side each of
them starts, and a second pass cuts records where the count is even. What a range begins or leaves open is put
together across ranges. Files without such records, which the first pass tells as well, go to Spark's own
reader line by line.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rowan.functions.text import quoted

# Options that change what a quote or a line is: their readers are Spark's.
_OTHER_QUOTING = ("multiline", "quote", "linesep", "encoding", "charset", "comment", "recursivefilelookup")
# So many ranges are sent to all tasks; the starts of more are joined.
_RANGES_SENT = 100_000
_WHOLE, _HEAD, _TAIL = "whole", "head", "tail"
# Place of an open header in its range.
_HEADER = 2
_PIECES = "file string, start bigint, kind string, place int, value string"


def splittable(options: Mapping[str, str]) -> bool:
    """Whether quotes are doubled and lines end as usual, so that their counts tell records apart."""
    given = {k.lower(): v for k, v in options.items()}
    return given.get("escape") == '"' and not any(k in given for k in _OTHER_QUOTING)


def _lines(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """value, file, start (of the byte range a line begins in), quotes, in the order of each range."""
    lines = spark.read.options(**options).text(path)
    value = F.col("value")
    return lines.select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        (F.octet_length(value) - F.octet_length(F.replace(value, F.lit('"'), F.lit("")))).alias("quotes"),
    )


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of every range: whole ones, the rest of one that began before it, and one it leaves open."""
    key: tuple[str, int] | None = None
    held: list[str] = []  # lines of the record that is open
    inherited = False  # whether it began in an earlier range
    odd, fresh = False, False
    out: dict[str, list] = {"file": [], "start": [], "kind": [], "place": [], "value": []}

    def tell(kind: str, lines: list[str], place: int = 0) -> None:
        for column, value in zip(out.values(), (*key, kind, place, "\n".join(lines)), strict=True):
            column.append(value)

    def told() -> pa.RecordBatch:
        types = (pa.string(), pa.int64(), pa.string(), pa.int32(), pa.string())
        arrays = [pa.array(c, t) for c, t in zip(out.values(), types, strict=True)]
        names = list(out)
        for column in out.values():
            column.clear()
        return pa.RecordBatch.from_arrays(arrays, names=names)

    def close() -> None:
        """The range is over."""
        if key is not None and held:
            tell(_HEAD if inherited else _TAIL, held, 0 if inherited else _HEADER if fresh else 1)
            held.clear()

    for batch in batches:
        if not batch.num_rows:
            continue
        files = batch.column("file").dictionary_encode()
        names, codes = files.dictionary.to_pylist(), files.indices.to_numpy()
        starts = batch.column("start").to_numpy()
        cuts = np.flatnonzero((codes[1:] != codes[:-1]) | (starts[1:] != starts[:-1])) + 1
        for at, to in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            part = batch.slice(at, to - at)
            if key != (names[codes[at]], int(starts[at])):
                close()
                key = names[codes[at]], int(starts[at])
                odd = inherited = bool(part.column("odd")[0].as_py())
                # The first record of a file is its header.
                fresh = key[1] == 0
            after = (np.cumsum(part.column("quotes").to_numpy()) + odd) % 2 == 1
            before = np.concatenate([[odd], after[:-1]])
            plain = ~before & ~after
            k = 0
            while fresh and k < len(plain) and plain[k]:
                # Blank lines before the header go as well.
                plain[k], fresh = False, not part.column("value")[k].as_py().strip()
                k += 1
            if plain.any():
                # Lines that are records need no work of their own.
                rows = part.filter(pa.array(plain))
                n = rows.num_rows
                columns = [rows.column("file"), rows.column("start"), pa.array([_WHOLE] * n),
                           pa.array(np.zeros(n, np.int32)), rows.column("value")]
                yield pa.RecordBatch.from_arrays(columns, names=list(out))
            for k in np.flatnonzero(before | after):
                held.append(part.column("value")[int(k)].as_py())
                if not after[k]:
                    if inherited:
                        tell(_HEAD, held)
                    elif not fresh:
                        tell(_WHOLE, held)
                    fresh = fresh and inherited
                    inherited = False
                    held.clear()
            odd = bool(after[-1])
            if len(out["file"]) >= 1024:
                yield told()
    close()
    yield told()


def _stitched(open_pieces: DataFrame) -> DataFrame:
    """Records that lie in several ranges: a piece left open and what the next ranges add to it."""
    order = Window.partitionBy("file").orderBy("start", "place")
    begun = F.count_if(F.col("kind") == _TAIL).over(order)
    parts = F.sort_array(F.collect_list(F.struct("start", "place", "value")))
    records = open_pieces.withColumn("record", begun).groupBy("file", "record").agg(parts.alias("parts"))
    # The header of a file whose first range does not hold it whole.
    header = (F.col("parts")[0]["start"] == 0) & (F.col("parts")[0]["place"] == _HEADER)
    return records.where(~header).select(F.array_join(F.col("parts")["value"], "\n").alias("value"))


def _strict(value: Column, sep: str) -> Column:
    """The value; an error where a record of several lines is not made of fields in quotes and fields without."""
    sep = re.escape(sep)
    field = rf'(?:"(?:[^"]++|"")*+"|[^"\n{sep}]*+)'
    one = rf"\A{field}(?:{sep}{field})*+\r?\z"
    message = F.concat(F.lit("Malformed CSV record, quotes inside a field without quotes: "), F.left(value, F.lit(200)))
    return F.when(~F.contains(value, F.lit("\n")) | value.rlike(one), value).otherwise(F.raise_error(message))


def read_csv_records(spark: SparkSession, path: str, options: Mapping[str, str]) -> DataFrame:
    """All columns as text; a scan of the files tells how to read them. ``options`` are ``splittable``."""
    own = spark.read.format("csv").options(**options)
    by_line = own.option("multiLine", "false").load(path)
    if spark.read.text(path).columns != ["value"]:
        # Columns from folder names.
        return own.option("multiLine", "true").load(path)
    odd = F.col("quotes") % 2 == 1
    if _lines(spark, path).where(odd).isEmpty():
        return by_line
    schema = own.option("multiLine", "true").load(path).schema
    lines = _lines(spark, path, lineSep="\n")
    # A row for each byte range.
    sums = lines.groupBy("file", "start").agg(F.sum("quotes").alias("n"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("file", "start", (F.coalesce(F.sum("n").over(before), F.lit(0)) % 2 == 1).alias("odd"))
    if sums.count() <= _RANGES_SENT:
        starts = spark.createDataFrame(starts.collect(), starts.schema)
        # The order of lines stays.
        marked = lines.join(F.broadcast(starts), ["file", "start"])
    else:
        at = lines.withColumn("at", F.monotonically_increasing_id())
        marked = at.join(starts, ["file", "start"]).sortWithinPartitions("file", "start", "at")
    pieces = marked.select("value", "file", "start", "quotes", "odd").mapInArrow(_pieces, _PIECES)
    whole = pieces.where(F.col("kind") == _WHOLE).select("value")
    records = whole.unionByName(_stitched(pieces.where(F.col("kind") != _WHOLE)))
    strict = _strict(F.col("value"), options.get("sep", ","))
    given = {**options, "header": "false", "multiLine": "true"}
    fields = ", ".join(f"{quoted(f.name)} string" for f in schema.fields)
    bare = F.regexp_replace(strict, r"\r\z", "")
    parsed = records.where(F.col("value").rlike(r"[^\r]")).select(F.from_csv(bare, fields, given).alias("r"))
    return parsed.select("r.*")
