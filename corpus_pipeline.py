"""The corpus pipeline: documents to a deduplicated, decontaminated, mixed and sharded corpus."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from review_engine.llm import decontaminate, langid, mixing, order_minhash, sharding
from review_engine.llm.common import bounded, table, written

# A document is rejected if its language cannot be told: no letters, or no label likely.
LEAST_SCORE = 0.3

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told; columns of documents."""
    bounded(spark)
    model = langid.fit(docs, learn=langid.fold_of(F.col("doc_id")) != 0)
    marked = langid.predict(docs, model)
    return marked.where((F.col("lang_pred") != langid.UNDETERMINED) & (F.col("score") >= LEAST_SCORE)).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least id, of each group of near copies; columns of documents."""
    bounded(spark)
    return order_minhash.one_of_each(order_minhash.near_duplicates(docs)).select(*docs.columns)


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark passage is found; columns of documents."""
    bounded(spark)
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark")).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents, each as often as the mix takes it; columns of documents."""
    bounded(spark)
    return mixing.mixed_documents(docs)


def assign_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their shard; columns of documents and n_bytes, shard, depth, shard_bytes."""
    bounded(spark)
    return sharding.shard(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("decontaminate", decontaminate_benchmark),
    ("mix_sources", mix_sources),
    ("shard", assign_shards),
]

# Learned weights, alignment and latent retrieval are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's rows are written as Parquet and read again."""
    docs = table(bounded(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
