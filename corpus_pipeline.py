"""The corpus pipeline: raw documents to token ids, stage by stage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowan.llm.bpe import digests, encode_texts
from rowan.llm.line_dedup import drop_common_lines
from rowan.llm.mixing import mix_documents
from rowan.llm.quality_rules import keep_good
from rowan.llm.queries import labelled_languages, tokenizer
from rowan.llm.simhash import keep_one_of_each
from rowan.sources.scratch import written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the current policy keep."""
    return keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the lines that many documents share."""
    cut = drop_common_lines(docs)
    return cut.withColumn("n_chars", F.coalesce(F.char_length("text").cast("long"), F.col("n_chars")))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return keep_one_of_each(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every language's documents at a rate, so that token totals follow their sizes to the 0.7.

    The sum of tokens stays: documents of small languages are repeated, as in op1, and no language's size
    decides how much of the others is kept.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return mix_documents(docs, labelled_languages(docs, labels))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with the hash of what they decode to."""
    coded = encode_texts(docs, ["doc_id", "lang", "source"], *tokenizer(), decode=True)
    return coded.select("row.*", "ids", *digests())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("source_mixing", source_mixing),
    ("byte_bpe", byte_bpe),
]

#: Fingerprints, fitted rates and token ids are beyond SQL; the tests compare with plain loops.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written and read again before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
