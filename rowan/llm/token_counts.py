"""Token counts: one exact histogram of encoded lengths answers totals, quantiles and truncated totals
for every context limit.

Texts are read once and only their lengths are kept; documents of equal length are counted before the
shuffle, and the histogram is written before its rows meet their sums. Suffix sums run inside stretches of neighbouring lengths and over the stretches' totals, so
that no window holds more than a stretch or the list of stretches, however many lengths there are.

Defined cases: a null or empty text has length zero; a null group is a group like any other; repeated
rows count each; an empty table gives an empty histogram; further columns are ignored, whatever their
names.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowan.llm.common import whole_text
from rowan.sources.scratch import written

#: Lengths in one stretch.
STRETCH = 512
BATCH_TEXTS = 256


@lru_cache(maxsize=2)
def _encoding(ranks_path: str, pattern: str):
    import tiktoken

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines)}
    return tiktoken.Encoding("given", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def token_lengths(
    docs: DataFrame, ranks_path: str, pattern: str, text: str = "text", by: Column | None = None
) -> DataFrame:
    """by (as a string) and n_tokens, the encoded length of the whole text, for every row."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoding(ranks_path, pattern).encode_ordinary
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_TEXTS):
                part = batch.slice(at, BATCH_TEXTS)
                sizes = [len(encode(t)) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_pydict({"by": part.column(0), "n_tokens": pa.array(sizes, pa.int64())})

    given = docs.select((F.lit(None) if by is None else by).cast("string").alias("by"), whole_text(F.col(text)))
    return given.mapInArrow(task, "by string, n_tokens long")


def length_histogram(lengths: DataFrame) -> DataFrame:
    """by, n_tokens, docs: how many documents have exactly that length."""
    return lengths.groupBy("by", "n_tokens").agg(F.count("*").alias("docs"))


def limit_table(histogram: DataFrame) -> DataFrame:
    """For each group and each length that occurs, taken as a context limit: docs (of that length),
    docs_over and tokens_over (of longer documents, whole), total_docs, total_tokens, and
    truncated_tokens, what is left when every document is cut at the limit; share_within, the share of
    documents no longer than the limit, so that every quantile of the lengths is a row's.

    Between two lengths that occur the truncated total is linear, so the table answers any limit.
    """
    # Read twice below; the texts behind it are encoded once.
    histogram = written(histogram)
    stretch = F.floor(F.col("n_tokens") / STRETCH)
    tokens = F.col("docs") * F.col("n_tokens")
    rows = histogram.select("by", "n_tokens", "docs", tokens.alias("tokens"), stretch.alias("stretch"))
    totals = rows.groupBy("by", "stretch").agg(F.sum("docs").alias("s_docs"), F.sum("tokens").alias("s_tokens"))
    longer = Window.partitionBy("by").orderBy(F.desc("stretch"))
    above = totals.select(
        F.col("by").alias("b"),
        F.col("stretch").alias("s"),
        (F.sum("s_docs").over(longer) - F.col("s_docs")).alias("docs_above"),
        (F.sum("s_tokens").over(longer) - F.col("s_tokens")).alias("tokens_above"),
        F.sum("s_docs").over(Window.partitionBy("by")).alias("total_docs"),
        F.sum("s_tokens").over(Window.partitionBy("by")).alias("total_tokens"),
    )
    within = Window.partitionBy("by", "stretch").orderBy(F.desc("n_tokens"))
    met = rows.join(above, rows["by"].eqNullSafe(above["b"]) & (rows["stretch"] == above["s"]))
    summed = met.select(
        "by",
        "n_tokens",
        "docs",
        (F.col("docs_above") + F.sum("docs").over(within) - F.col("docs")).alias("docs_over"),
        (F.col("tokens_above") + F.sum("tokens").over(within) - F.col("tokens")).alias("tokens_over"),
        "total_docs",
        "total_tokens",
    )
    cut = F.col("total_tokens") - F.col("tokens_over") + F.col("docs_over") * F.col("n_tokens")
    within_limit = (F.col("total_docs") - F.col("docs_over")) / F.col("total_docs")
    return summed.withColumns({"truncated_tokens": cut, "share_within": within_limit})


def truncated_totals(table: DataFrame, limits: list[int]) -> DataFrame:
    """by, context_limit and truncated_tokens for the limits asked for, from the limit table.

    The shortest length at or over a limit is on the same straight piece: below it, each document that
    reaches it loses one token with each token of the limit.
    """
    asked = table.select("*", F.explode(F.array(*(F.lit(int(x)).cast("long") for x in limits))).alias("context_limit"))
    reach = F.col("docs") + F.col("docs_over")
    at = F.col("truncated_tokens") - reach * (F.col("n_tokens") - F.col("context_limit"))
    fitting = F.col("n_tokens") >= F.col("context_limit")
    return asked.groupBy("by", "context_limit").agg(
        F.coalesce(F.min_by(F.when(fitting, at), F.when(fitting, F.col("n_tokens"))), F.max("total_tokens")).alias(
            "truncated_tokens"
        )
    )


def length_quantiles(table: DataFrame, shares: list[float]) -> DataFrame:
    """by, share and n_tokens: the least length that at least that share of the documents does not exceed."""
    asked = table.select("*", F.explode(F.array(*(F.lit(float(x)) for x in shares))).alias("share"))
    enough = F.col("total_docs") - F.col("docs_over") >= F.col("share") * F.col("total_docs")
    return asked.where(enough).groupBy("by", "share").agg(F.min("n_tokens").alias("n_tokens"))
