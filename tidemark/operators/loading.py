"""Load dispositions as DataFrame functions: merge, append, replace."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def pick_per_key(df: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """The first row per key in the given order.

    The rank bound lets every task keep one row per key before the shuffle, so a key
    repeated in a third of the rows still costs one row per task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") == 1).drop("_rank")


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row per key by ``order``."""
    return pick_per_key(df, keys, *[F.col(c).desc() for c in order])


def merge_upsert(
    target: DataFrame, updates: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Delete-insert by key: the last update per key replaces the stored row.

    Only the key columns of the updates travel to the anti-join.
    """
    winners = latest_per_key(updates, keys, order)
    kept = target.join(updates.select(*keys).distinct(), list(keys), "left_anti")
    return kept.unionByName(winners.select(*target.columns))


def append_rows(target: DataFrame, new: DataFrame) -> DataFrame:
    """All rows of both; columns new in the batch are NULL in older rows."""
    return target.unionByName(new, allowMissingColumns=True)


def replace_rows(target: DataFrame, new: DataFrame) -> DataFrame:
    """Only the new rows, in the stored layout."""
    return new.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in target.schema.fields])
