"""Materialising results as tables and views.

A table is a folder with a commit log (:mod:`tidemark.sources.stored`). A run writes files of its own and names them
in one entry, so a plan never overwrites what it reads, and a job that is lost half-way leaves the table as it was.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources.stored import StoredTable


def replace_table(df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> int:
    """Make ``df`` the table's content and return the commit's number."""
    return StoredTable(df.sparkSession, table, partition_by=partition_by).replace(df)


def append_table(df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> int:
    """Add rows in one commit, creating the table when there is none; readers see all of them or none."""
    return StoredTable(df.sparkSession, table, partition_by=partition_by).append(df)


def read_table(spark: SparkSession, table: str) -> DataFrame:
    return StoredTable(spark, table).read()


def table_exists(spark: SparkSession, table: str) -> bool:
    return StoredTable(spark, table).exists()


def save_bucketed(df: DataFrame, name: str, keys: Sequence[str], buckets: int) -> None:
    """A catalog table bucketed and sorted by its merge keys, so that later merges and
    joins on them need no shuffle of the stored side."""
    df.write.mode("overwrite").bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)


def as_view(df: DataFrame, name: str) -> DataFrame:
    """Register a lazy view, recomputed on each read."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)
