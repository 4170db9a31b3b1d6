"""Line dedup: lines that many documents share go from all of them but one.

Lines are exploded under a hash of their normalised form, distinct documents are counted per hash, and
the rest is put together again by position. Only hashes, ids and positions of long lines are shuffled
for counting; a document's text moves once, to meet the positions it loses.

Defined cases: a null or empty text is one empty line; a null id counts as one document, smaller than
all others; rows that repeat an id are one document for the counts and are cut each by its own lines; an
empty table gives an empty result; further columns are carried or ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowan.llm.common import BLANKS, LEAST_ID, ascii_lower, hash_pair, let, whole_text
from rowan.sources.scratch import written

LEAST_LENGTH = 40
LEAST_DOCUMENTS = 5


def line_key(line: Column) -> Column:
    """What lines are compared by."""
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _long_line_hashes(text: Column, least_length: int) -> Column:
    def hashed(line: Column) -> Column:
        def pair(bare: Column) -> Column:
            a, b = hash_pair(ascii_lower(bare))
            return F.when(F.char_length(bare) >= least_length, F.struct(a.alias("a"), b.alias("b")))

        return let(F.btrim(line, F.lit(BLANKS)), pair)

    return F.transform(_lines(text), hashed)


def dropped_positions(
    docs: DataFrame, doc_id: str, text: str, least_length: int = LEAST_LENGTH, least_documents: int = LEAST_DOCUMENTS
) -> DataFrame:
    """id, body (hash of the text) and the sorted positions of the lines that go, where any go."""
    keyed = docs.select(
        F.coalesce(F.col(doc_id).cast("long"), F.lit(LEAST_ID)).alias("id"),
        F.xxhash64(text).alias("body"),
        _long_line_hashes(F.col(text), least_length).alias("hashes"),
    )
    # Apart from the step above, or the hash of the text would be taken anew for every line.
    # Outer, because a filter on the array's size would otherwise be inferred and take the hashes twice.
    placed = keyed.select("id", "body", F.posexplode_outer("hashes").alias("place", "line"))
    rows = placed.where("line IS NOT NULL")
    found = rows.select("id", "body", "place", "line.a", "line.b")
    counted = found.groupBy("a", "b").agg(F.countDistinct("id").alias("n"), F.max("id").alias("keeper"))
    # Written, so that the join below deals both sides out itself and may split a very common line.
    common = written(counted.where(F.col("n") >= least_documents).select("a", "b", "keeper"))
    gone = found.join(common, ["a", "b"]).where("id <> keeper")
    return gone.groupBy("id", "body").agg(F.array_sort(F.collect_set("place")).alias("places"))


def _without(lines: Column, places: Column) -> Column:
    """The lines at other positions: the stretches between neighbouring positions, joined."""
    bounds = F.concat(F.array(F.lit(-1)), places, F.array(F.size(lines)))

    def stretches(edges: Column) -> Column:
        return F.flatten(
            F.transform(
                F.sequence(F.lit(0), F.size(edges) - 2),
                lambda k: F.slice(lines, F.get(edges, k) + 2, F.get(edges, k + 1) - F.get(edges, k) - 1),
            )
        )

    return F.when(F.size(places) == 0, lines).otherwise(let(bounds, stretches))


def dedup_lines(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    least_length: int = LEAST_LENGTH,
    least_documents: int = LEAST_DOCUMENTS,
) -> DataFrame:
    """row (a struct of the input's columns), n_lines, n_dropped, kept (the remaining lines joined)."""
    bare = docs.select(F.col(doc_id).alias("doc_id"), whole_text(F.col(text)).alias("text"))
    places = dropped_positions(bare, "doc_id", "text", least_length, least_documents)
    whole = docs.select(
        F.struct("*").alias("row"),
        F.coalesce(F.col(doc_id).cast("long"), F.lit(LEAST_ID)).alias("id"),
        F.xxhash64(whole_text(F.col(text))).alias("body"),
    )
    met = whole.join(places, ["id", "body"], "left").select(
        "row",
        _lines(whole_text(F.col("row")[text])).alias("lines"),
        F.coalesce("places", F.array().cast("array<int>")).alias("places"),
    )
    return met.select(
        "row",
        F.size("lines").cast("long").alias("n_lines"),
        F.size("places").cast("long").alias("n_dropped"),
        F.array_join(_without(F.col("lines"), F.col("places")), "\n").alias("kept"),
    )


def drop_common_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **limits: int) -> DataFrame:
    """The documents with their own columns; the text of those that lost lines is what was kept."""
    done = dedup_lines(docs, doc_id, text, **limits)
    cut = F.when(F.col("n_dropped") > 0, F.col("kept")).otherwise(F.col("row")[text])
    return done.select(*(cut.alias(c) if c == text else F.col("row")[c].alias(c) for c in docs.columns))
