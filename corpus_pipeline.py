"""The corpus pipeline: quality rules, near duplicates, repeated passages, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns what its operator keeps of docs; all but the last keep the columns of
the documents table. run() applies them to the documents of a folder, each stage written and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from flowmart.llm import jaccard, mixing, packing, quality, substrings
from flowmart.llm.queries import tokenizer_path
from flowmart.workspace import written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the table of thresholds."""
    return quality.kept_documents(docs)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones."""
    return jaccard.deduplicated(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages of 35 words that occur elsewhere."""
    return substrings.deduplicated(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed_documents(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences."""
    return packing.packed(docs, tokenizer_path())


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", ngram_jaccard),
    ("substring dedup", substring_dedup),
    ("mixing", mix_sources),
    ("best-fit packing", best_fit_packing),
]

# Mixing solves for its rates and packing searches bins: neither has a statement in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"stage{k}")
    return docs
