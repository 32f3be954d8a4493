"""From raw documents to packed token windows, in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the last return the columns of
``documents``. ``run`` writes every stage's result and reads it again as the next stage's documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import line_dedup, mixing, ngram_join, packing, quality, tokens
from tidemark.llm.common import stage, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labels, does not reject."""
    space = quality.fit(docs, table(spark, sf_dir, "labels"), "doc_id", "text", "quality")
    return quality.keep_good(docs, space, "text")


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that a document of larger id repeats; ``n_chars`` follows the text."""
    return line_dedup.drop_lines(docs, "doc_id", "text").withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by similar word shingles."""
    return ngram_join.keep_first(docs, "doc_id", "text")


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that sources have their target shares of words."""
    return mixing.mixed_documents(docs, "doc_id", "text", "source")


def window_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's pieces and their places in token windows."""
    return packing.pack(docs, "doc_id", "text", public_tokenizers.path(tokens.BYTE_BPE))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_deduplication", line_deduplication),
    ("near_duplicates", near_duplicates),
    ("source_mix", source_mix),
    ("window_packing", window_packing),
]

#: SQL cannot express the classifier, the shingle components or the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
