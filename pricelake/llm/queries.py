"""Registered queries of the operators."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pricelake.llm import (
    alignment,
    best_fit,
    byte_bpe,
    collocations,
    kmeans_tree,
    line_chunks,
    ngram_join,
    packing,
    pii,
    pivot_dedup,
    quality,
    toxicity,
    url_filter,
)
from pricelake.llm.common import table


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(url_filter.RULES, "host string, path string, verdict string")
    return url_filter.judge(table(spark, sf_dir, "pages"), rules)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = toxicity.graded_labels(table(spark, sf_dir, "labels"))
    chain = toxicity.toxicity_chain(docs, labels, toxicity.CATEGORIES)
    return toxicity.scores(docs, chain, toxicity.CATEGORIES)


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digests(pii.detect(table(spark, sf_dir, "documents")))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_chunks.dedup_lines(table(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.PATTERN,
    )


def op7_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kmeans_tree.nearest(table(spark, sf_dir, "embeddings"), "vec_id % 50 = 0")


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = byte_bpe.encode_texts(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
        public_tokenizers.PATTERN,
        decode=True,
    )
    return byte_bpe.digests(encoded)


def op9_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = ngram_join.jaccard_components(table(spark, sf_dir, "documents"))
    return joined.drop("row", "root")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    ratings = quality.graded_ratings(table(spark, sf_dir, "labels"))
    return quality.grades(docs, quality.quality_model(docs, ratings, quality.TOP_GRADE))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit.pack(
        table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")
    )


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.PATTERN,
        public_tokenizers.path("piece_bpe_32k.model"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_embedding_near_dedup": op1_embedding_near_dedup,
    "op2_url_filter": op2_url_filter,
    "op3_toxicity": op3_toxicity,
    "op4_pii": op4_pii,
    "op5_line_dedup": op5_line_dedup,
    "op6_packing": op6_packing,
    "op7_nearest": op7_nearest,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_ngram_jaccard": op9_ngram_jaccard,
    "op10_quality": op10_quality,
    "op11_collocations": op11_collocations,
    "op12_best_fit": op12_best_fit,
    "op13_alignment": op13_alignment,
}

ORACLE: dict[str, str] = {
    "op2_url_filter": url_filter.ORACLE,
    "op11_collocations": collocations.ORACLE,
}
