"""Registered queries of the subpackage: name -> function of (session, folder of the input tables)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowmart.llm import (
    alignment,
    fingerprints,
    grading,
    jaccard,
    languages,
    licences,
    lines,
    mixing,
    negatives,
    packing,
    pages,
    quality,
    substrings,
)
from flowmart.llm.common import table


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cut = substrings.substring_table(table(spark, folder, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_table(table(spark, folder, "documents"))


def op3_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed(table(spark, folder, "documents"), tokenizer_path())


def op4_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mixed(table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


def op5_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.edit_report(table(spark, folder, "documents"))


def op6_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    classes = jaccard.similarity_classes(table(spark, folder, "documents"))
    return classes.select("doc_id", "n_shingles", "component_id")


def op7_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = grading.trained(docs, grading.ratings(table(spark, folder, "labels")))
    return grading.graded(docs, model)


def op8_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return languages.language_table(table(spark, folder, "documents"))


def op9_license_scans(spark: SparkSession, folder: str) -> DataFrame:
    return licences.licence_scan(table(spark, folder, "documents"), licences.known_digests(spark))


def op10_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return pages.extracted(table(spark, folder, "pages"))


def op11_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return lines.line_table(table(spark, folder, "documents"))


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label")
    rows = table(spark, folder, "embeddings").select("vec_id", F.col("embedding").alias("vector"), moved)
    return negatives.mined(rows, F.col("vec_id") % 50 == 0)


def op13_tokenizer_alignment(spark: SparkSession, folder: str) -> DataFrame:
    paths = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
    return alignment.aligned_documents(table(spark, folder, "documents"), *paths)


QUERIES = {
    f.__name__: f
    for f in (
        op1_substring_dedup,
        op2_quality_rules,
        op3_best_fit_packing,
        op4_mixing,
        op5_fingerprints,
        op6_ngram_jaccard,
        op7_quality_classifier,
        op8_language_id,
        op9_license_scans,
        op10_html_extraction,
        op11_line_dedup,
        op12_hard_negatives,
        op13_tokenizer_alignment,
    )
}
