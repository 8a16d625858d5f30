"""The training-data pipeline: each stage takes what its predecessor kept."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from veritrail.llm import mixing, packing, quality, similar, suffix_dedup
from veritrail.llm.common import shared_dir, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that pass the base limits and the learned decision list."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document of the smallest id of each group alike in five-word shingles at 0.8 or more."""
    return similar.drop_similar(docs)


def repeat_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take out of texts what occurs elsewhere at 200 bytes or more."""
    return suffix_dedup.drop_repeats(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take documents, some of them more than once, so that sources come near their target weights."""
    return mixing.mix(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place every document's words in sequences of the permitted lengths."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_dedup),
    ("suffix-array dedup", repeat_removal),
    ("source mixing", mix_sources),
    ("best-fit packing", best_fit_packing),
]
ORACLE_SQL = None  # SQL expresses neither the learned rules nor the fingerprints


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = f"{shared_dir(spark)}/pipeline-{name.replace(' ', '_')}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
