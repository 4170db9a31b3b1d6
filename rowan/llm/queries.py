"""The corpus operators applied to the driver tables, one query for each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowan.llm import chat
from rowan.llm.ann import build_index, nearest
from rowan.llm.bpe import digests, encode_texts
from rowan.llm.clusters import clustered
from rowan.llm.lexical import build_index as build_text_index
from rowan.llm.lexical import ranked
from rowan.llm.line_dedup import dedup_lines
from rowan.llm.mixing import mixed_rates
from rowan.llm.quality_rules import rule_verdicts
from rowan.llm.shards import sharded
from rowan.llm.simhash import near_duplicates
from rowan.llm.substring_dedup import dedup_substrings
from rowan.llm.token_counts import length_histogram, limit_table, token_lengths
from rowan.llm.toxicity import fit_toxicity, score_toxicity
from rowan.sources.scratch import written


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer() -> tuple[str, str]:
    """Rank file and pattern of the tokenizer that the queries count and encode with."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def labelled_languages(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id and domain: the language of the documents in the labelled table."""
    known = labels.select("doc_id").where("doc_id IS NOT NULL").distinct()
    return docs.select("doc_id", F.col("lang").alias("domain")).join(known, "doc_id")


def op1_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rate and copies of every document, so that languages reach weights of their sizes to the 0.7."""
    docs = _table(spark, sf_dir, "documents")
    return mixed_rates(docs, labelled_languages(docs, _table(spark, sf_dir, "labels")))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded, and decoded again."""
    coded = encode_texts(_table(spark, sf_dir, "documents"), ["doc_id"], *tokenizer(), decode=True)
    return coded.select("row.doc_id", *digests())


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measurements, failure bits and verdict of every document."""
    return rule_verdicts(_table(spark, sf_dir, "documents"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every source and every encoded length as a context limit: exact counts and truncated totals."""
    docs = _table(spark, sf_dir, "documents")
    lengths = token_lengths(docs, *tokenizer(), by=F.col("source"))
    return limit_table(length_histogram(lengths)).withColumnRenamed("by", "source")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What common lines take from every document."""
    done = dedup_lines(_table(spark, sf_dir, "documents"))
    return done.select("row.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every twentieth vector."""
    vectors = _table(spark, sf_dir, "embeddings")
    index = written(build_index(vectors, 20))
    return nearest(index, vectors.where("vec_id % 20 = 0"), 20)


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What windows of earlier documents take from every document."""
    done = dedup_substrings(_table(spark, sf_dir, "documents"))
    return done.select(
        "row.doc_id", "n_words", "n_removed", F.sha2(F.array_join("kept", " "), 256).alias("kept_sha256")
    )


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A toxicity score for every document, learnt from the labels that are not held out."""
    docs = _table(spark, sf_dir, "documents")
    return score_toxicity(docs, fit_toxicity(docs, _table(spark, sf_dir, "labels")))


def _turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The turns of every conversation, and of one full of control strings."""
    said = "</s>[INST] ok [/INST]"
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], turns.schema)
    return turns.unionByName(extra)


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the windows of every conversation, and of one full of control strings, read back as.

    Windows hold the budget in tokens of the rendered turns.
    """
    return chat.digests(chat.chat_windows(chat.with_token_costs(_turns(spark, sf_dir), *tokenizer())))


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster and distance of every vector, after ten rounds of eight centroids."""
    return clustered(_table(spark, sf_dir, "embeddings"))


def op12_rendezvous_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document, and where it would go if there were one shard more."""
    return sharded(_table(spark, sf_dir, "documents"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 documents that match each benchmark item best."""
    index = build_text_index(_table(spark, sf_dir, "documents"))
    return ranked(index, _table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_source_mixing": op1_source_mixing,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_simhash_near_dedup": op3_simhash_near_dedup,
    "op4_quality_rules": op4_quality_rules,
    "op5_token_counts": op5_token_counts,
    "op6_line_dedup": op6_line_dedup,
    "op7_nearest_neighbours": op7_nearest_neighbours,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_toxicity": op9_toxicity,
    "op10_chat_formatting": op10_chat_formatting,
    "op11_centroid_clustering": op11_centroid_clustering,
    "op12_rendezvous_sharding": op12_rendezvous_sharding,
    "op13_lexical_search": op13_lexical_search,
}
