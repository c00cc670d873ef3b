"""A corpus from documents to packed training sequences, one stage after the other.

Each stage gets the documents its predecessor kept, as a table on disk, and returns a
DataFrame with the columns of documents; the last returns the packed pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pricelake.llm import line_chunks, ngram_join, packing, pii, toxicity
from pricelake.llm.common import saved, table

#: No share of repeated chunks spares a document: line dedup cuts copies like all others.
COPY = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: documents that the classifier chain finds toxic go."""
    labels = toxicity.graded_labels(table(spark, sf_dir, "labels"))
    chain = toxicity.toxicity_chain(docs, labels, toxicity.CATEGORIES)
    return toxicity.without_toxic(docs, chain)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: chunks of lines that an earlier document holds are cut out of every document.

    A copy loses what the first one holds; the next stage compares what is left.
    """
    return line_chunks.dedup_lines(docs, spare=COPY)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: of each group of near duplicates one document stays."""
    return ngram_join.one_of_each_group(docs)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: personal data is replaced by the name of its kind."""
    return pii.mask(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: the documents' tokens are packed with lexical neighbours."""
    return packing.pack(
        docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("ngram_jaccard", dedup_documents),
    ("pii", mask_personal_data),
    ("packing", pack),
]

#: The classifier of the first stage and the packing of the last can't be written as SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
