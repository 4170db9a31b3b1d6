"""Toxicity: a linear classifier on character n-grams, scaled by naive Bayes log-count ratios.

A text's features are the distinct hashed n-grams of its lower-cased code points. Spark counts them by
class over the labelled training rows; each feature is scaled by its log-count ratio, the strongest are
kept, and Spark ML fits a logistic regression on them. Scoring folds ratios and coefficients into one
weight for each hash value and reads every text once, whole.

The fit uses at most SAMPLE_ROWS labelled rows, the least by a hash of their id; everything that grows
with the corpus is counted or scored in place. What goes to the driver and back to the tasks is bounded:
the sample's ids and one weight for each of 2^HASH_BITS hash values.

Defined cases: a null or empty text has no features and gets the intercept's score; a null id is never
a training row and counts as held out only if it says so (it does not); several labels of one document
count as toxic if any is; without both classes among the training rows every score is their share of
toxic rows (0 without rows); repeated rows are scored each for itself; an empty table gives an empty
result; further columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowan.llm.common import whole_text
from rowan.sources.scratch import written

SIZES = (4, 5, 6)
HASH_BITS = 20
SAMPLE_ROWS = 5_000
#: Hash values that the fit may use, and in how many training rows each must occur.
FEATURES = 50_000
LEAST_ROWS = 3
FOLDS = 5
_BLOCK = 1 << 20


@dataclass(frozen=True)
class ToxicityModel:
    """A weight for each hash value used, and the intercept."""

    values: np.ndarray
    weights: np.ndarray
    intercept: float

    def dense(self) -> np.ndarray:
        table = np.zeros(1 << HASH_BITS)
        table[self.values] = self.weights
        return table


def ngram_values(text: str) -> np.ndarray:
    """The distinct hash values of the text's n-grams; blanks of any kind are alike, and border it."""
    points = np.frombuffer(f" {text} ".encode("utf-32-le"), np.uint32)
    found = []
    for at in range(0, len(points), _BLOCK):
        own = points[at : at + _BLOCK + max(SIZES) - 1].astype(np.uint64)
        own[(own >= 9) & (own <= 13)] = 32
        for n in SIZES:
            if len(own) >= n:
                h = np.full(len(own) - n + 1, n, np.uint64)
                for k in range(n):
                    h = h * np.uint64(0x9E3779B97F4A7C15) + own[k : len(own) - n + 1 + k]
                h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
                found.append((h >> np.uint64(64 - HASH_BITS)).astype(np.int32))
    if not text.strip() or not found:
        return np.zeros(0, np.int32)
    return np.unique(np.concatenate(found))


def held_out(doc_id: Column) -> Column:
    """One id in FOLDS: labels of these rows are never learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """text and toxic (0.0 or 1.0) of the labelled rows that the fit may use."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    each = known.groupBy(F.col("doc_id").cast("long").alias("id")).agg(
        F.max(F.when(F.col("toxic") > 0, 1.0).otherwise(0.0)).alias("toxic")
    )
    sample = each.orderBy(F.xxhash64("id"), "id").limit(sample_rows)
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), F.lower(whole_text(F.col("text"))).alias("text"))
    # At most sample_rows ids of 16 bytes.
    return texts.join(F.broadcast(sample), "id").select("text", "toxic")


def _valued(rows: DataFrame) -> DataFrame:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                values = [ngram_values(t) for t in part.column(0).to_pylist()]
                yield pa.RecordBatch.from_pydict(
                    {"toxic": part.column(1), "values": pa.array(values, pa.list_(pa.int32()))}
                )

    return rows.mapInArrow(task, "toxic double, values array<int>")


def _ratios(rows: DataFrame, features: int, least_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """The hash values that tell the classes apart best, and their log-count ratios."""
    counts = written(
        rows.select("toxic", F.explode("values").alias("value"))
        .groupBy("value")
        .agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good"))
    )
    total = counts.agg(F.sum("bad"), F.sum("good")).first()
    all_bad, all_good = ((x or 0.0) + (1 << HASH_BITS) for x in total)
    ratio = F.log((F.col("bad") + 1) / all_bad) - F.log((F.col("good") + 1) / all_good)
    both = counts.select("value", (F.col("bad") + F.col("good")).alias("rows"), ratio.alias("ratio"))
    strong = both.where(F.col("rows") >= least_rows).orderBy(F.desc(F.abs("ratio") * F.col("rows")), "value")
    chosen = sorted((r["value"], r["ratio"]) for r in strong.limit(features).collect())
    return np.array([v for v, _ in chosen], np.int32), np.array([r for _, r in chosen])


def _vectors(rows: DataFrame, values: np.ndarray, ratios: np.ndarray) -> DataFrame:
    """label and features: the ratios of the values that a text has."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = np.full(1 << HASH_BITS, -1, np.int32)
        place[values] = np.arange(len(values), dtype=np.int32)
        for batch in (b for b in batches if b.num_rows):
            lists = batch.column(1)
            ends = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))
            found = np.split(place[lists.flatten().to_numpy(zero_copy_only=False)], ends[:-1])
            found = [x[x >= 0] for x in found]
            parts = {
                "type": pa.array([0] * len(found), pa.int8()),
                "size": pa.array([len(values)] * len(found), pa.int32()),
                "indices": pa.array(found, pa.list_(pa.int32())),
                "values": pa.array([ratios[x] for x in found], pa.list_(pa.float64())),
            }
            features = pa.StructArray.from_arrays(list(parts.values()), list(parts))
            yield pa.RecordBatch.from_pydict({"label": batch.column(0), "features": features})

    return rows.mapInArrow(task, T.StructType().add("label", T.DoubleType()).add("features", VectorUDT()))


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    sample_rows: int = SAMPLE_ROWS,
    features: int = FEATURES,
    least_rows: int = LEAST_ROWS,
) -> ToxicityModel:
    """docs: doc_id, text. labels: doc_id, toxic. At most ``features`` hash values get a weight, each of
    them in ``least_rows`` training rows at least."""
    rows = written(_valued(training_rows(docs, labels, sample_rows)))
    n, bad = rows.agg(F.count("*"), F.sum("toxic")).first()
    values, ratios = _ratios(rows, features, least_rows)
    if not n or bad in (0, n) or not len(values):
        share = (bad or 0.0) / n if n else 0.0
        odds = math.log(share / (1 - share)) if 0 < share < 1 else math.inf if share else -math.inf
        return ToxicityModel(values[:0], ratios[:0], odds)
    learner = LogisticRegression(regParam=1e-3, standardization=False, maxIter=60)
    fitted = learner.fit(_vectors(rows, values, ratios))
    return ToxicityModel(values, fitted.coefficients.toArray() * ratios, float(fitted.intercept))


def score_toxicity(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id, held_out, score (0 to 1) and predicted of every row; one pass, no shuffle."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = model.dense()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sums = [weights[ngram_values(t)].sum() + model.intercept for t in part.column(1).to_pylist()]
                score = 1 / (1 + np.exp(-np.clip(sums, -700, 700)))
                yield pa.RecordBatch.from_pydict({"doc_id": part.column(0), "score": pa.array(score)})

    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.lower(whole_text(F.col("text"))).alias("text"))
    scored = given.mapInArrow(task, "doc_id long, score double")
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
