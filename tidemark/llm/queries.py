"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import (
    conversations,
    fill_middle,
    forest,
    language_model,
    license_scan,
    line_dedup,
    mixing,
    near_vectors,
    ngram_join,
    packing,
    quality,
    sharding,
    sql,
    token_files,
    tokens,
)
from tidemark.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[build.__name__] = build
    if hasattr(sql, build.__name__.upper()):
        ORACLE_SQL[build.__name__] = getattr(sql, build.__name__.upper())
    return build


@query
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(table(spark, sf_dir, "documents"), "doc_id", "text")


@query
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), "doc_id", "text", public_tokenizers.path(tokens.BYTE_BPE))


@query
def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_report(table(spark, sf_dir, "documents"), "doc_id", "text", public_tokenizers.path(tokens.WORD_BPE))


@query
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), "doc_id", "text", "source")


@query
def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(table(spark, sf_dir, "documents"), "doc_id", "text")


@query
def op4_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.near_vectors(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label")


@query
def op6_forest_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.nearest(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")


@query
def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join_components(table(spark, sf_dir, "documents"), "doc_id", "text")


@query
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels"), "doc_id", "text", "quality"), "doc_id", "text")


@query
def op7_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score_texts(table(spark, sf_dir, "documents"), "doc_id", "text")


@query
def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair_report(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text")


@query
def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(table(spark, sf_dir, "documents"), "doc_id", "text")


@query
def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.digest_report(table(spark, sf_dir, "documents"), "doc_id", "text")
