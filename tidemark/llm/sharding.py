"""Shards by jump consistent hashing: the id and the shard count decide, without a ring table."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import parts

LAW, SHARDS = "key", 8
_STEP = np.uint64(2862933555777941757)


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each unsigned 64-bit key. With one more shard a key stays or moves into the new one.

    Each round jumps to the next shard count at which the key would move; the expected number of rounds
    is the logarithm of ``shards``.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    keys = keys.astype(np.uint64)
    here, ahead = np.full(len(keys), -1, np.int64), np.zeros(len(keys), np.int64)
    moving = np.arange(len(keys))
    while len(moving):
        here[moving] = ahead[moving]
        keys[moving] = keys[moving] * _STEP + np.uint64(1)
        ahead[moving] = ((here[moving] + 1) * (2.0**31 / ((keys[moving] >> np.uint64(33)) + np.uint64(1)))).astype(np.int64)
        moving = moving[ahead[moving] < shards]
    return here


def stable_key(key_hash: Column) -> Column:
    """The first 60 bits of an md5 in hex, as a long."""
    return F.conv(F.substring(key_hash, 1, 15), 16, 10).cast("long")


def shard_of(key: Column, shards: int) -> Column:
    return F.pandas_udf(lambda k: pd.Series(jump_hash(k.to_numpy(), shards)).astype("int32"), "int")(key)


def assign_shards(docs: DataFrame, id_col: str, text_col: str, shards: int = SHARDS) -> DataFrame:
    """One narrow row per document: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``.

    ``slot`` counts a shard's documents from 0 in the order of their hashed ids. Ranks are counted in
    ranges of that hash, so a shard is never sorted in one task, and do not depend on the number of
    ranges. A null id hashes as the empty text; repeated ids share a shard; null or empty texts have
    size 1. An empty table gives an empty result. Other columns are not read.
    """
    ranges = 1 << max(0, (parts(docs) - 1).bit_length())
    digits = max(1, -(-(ranges.bit_length() - 1) // 4))
    raw = F.encode(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), "UTF-8")
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), (F.octet_length(raw) + 1).cast("long").alias("size"), F.crc32(raw).alias("text_crc32"))
    rows = rows.withColumn("h", F.md5(F.encode(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "UTF-8")))
    rows = rows.withColumn("k", stable_key(F.col("h")))
    rows = rows.select("doc_id", "size", "text_crc32", "h", shard_of(F.col("k"), shards).alias("shard"), shard_of(F.col("k"), shards + 1).alias("grown_shard"))
    rows = rows.withColumn("span", F.substring("h", 1, digits))
    before = Window.partitionBy("shard").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("shard", "span").agg(F.count("*").alias("n")).select("shard", "span", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = F.row_number().over(Window.partitionBy("shard", "span").orderBy("h", "doc_id", "size", "text_crc32"))
    # at most shards x 16**digits rows: bounded by settings, not by the data
    return rows.withColumn("n", inside).join(F.broadcast(starts), ["shard", "span"]).select(
        "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", (F.col("start") + F.col("n") - 1).alias("slot"), "grown_shard"
    )


def write_shards(docs: DataFrame, id_col: str, path: str, shards: int = SHARDS) -> None:
    """All columns of the documents as Parquet, one folder per shard."""
    key = stable_key(F.md5(F.encode(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")), "UTF-8")))
    if "shard" in docs.columns:
        raise ValueError("the documents already have a column named shard")
    docs.withColumn("shard", shard_of(key, shards)).write.partitionBy("shard").parquet(path)
