"""A training-data pipeline: toxic documents, near copies and benchmark items go, tokens come.

Each stage takes (spark, docs, sf_dir), works on all rows the stage before kept, and returns
the columns of documents; the last one adds token digests.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loanloom.llm import bpe, decontaminate, jaccard, toxicity
from loanloom.llm.common import scratch_dir
from loanloom.llm.queries import table, tokenizer_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score reaches one half go."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group linked by a Jaccard similarity of 0.8 the smallest doc_id stays."""
    return jaccard.one_of_each(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.without_benchmark(docs, table(spark, sf_dir, "benchmark"))


def add_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with n_tokens, ids_sha256 and decoded_sha256."""
    return bpe.with_digests(docs, tokenizer_path())


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("decontamination", drop_benchmark),
    ("tokens", add_tokens),
]

#: The fitted and hashed stages are beyond SQL; tests hold them against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = scratch_dir(spark, "pipeline")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
