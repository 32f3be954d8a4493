"""Sorting, top-N reports and per-day quotas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.sizing import one_task_reads
from tidemark.session import new_shared_path, shuffle_partitions


def ordered(df: DataFrame, *keys: str | Column) -> DataFrame:
    """Total order by a range shuffle; for final output only, later reads do not keep it."""
    return df.orderBy(*keys)


def top_n(df: DataFrame, n: int, *keys: str | Column) -> DataFrame:
    """The first ``n`` rows; every task keeps at most ``n``."""
    return df.orderBy(*keys).limit(n)


def quota_cap(
    requests: DataFrame,
    day: str,
    order: Sequence[str | Column],
    maximum: int,
    used: DataFrame | None = None,
    known: DataFrame | None = None,
    entity: str | None = None,
) -> DataFrame:
    """Take requests in order until each day's quota is used up.

    ``used`` holds (day, ``used``) counts of earlier successes. Requests for entities
    not in ``known`` are skipped first and cost nothing. A small bound on the rank cuts
    each day to ``maximum`` rows per task before the shuffle; beyond Spark's limit for that, and on input that
    one task would not read, days are cut by ranges of the order.
    """
    if known is not None:
        requests = requests.join(known.select(entity).distinct(), entity, "left_semi")
    if maximum > GROUP_LIMIT and not one_task_reads(requests):
        return quota_by_ranges(requests, day, order, maximum, used)
    rank = F.row_number().over(Window.partitionBy(day).orderBy(*order))
    ranked = requests.withColumn("_rank", rank).where(F.col("_rank") <= maximum)
    if used is not None:
        ranked = ranked.join(used.select(day, "used"), day, "left").where(
            F.col("_rank") <= maximum - F.coalesce(F.col("used"), F.lit(0))
        )
        ranked = ranked.drop("used")
    return ranked.drop("_rank")


#: Ranks up to which Spark keeps only the first rows of a group in each task before it shuffles.
GROUP_LIMIT = 1_000


def quota_by_ranges(requests: DataFrame, day: str, order: Sequence[str | Column], maximum: int, used: DataFrame | None = None) -> DataFrame:
    """The quota by a rank in two levels: rows are dealt out by ranges of day and order, and the ranges' rows counted.

    A running sum over a day's ranges tells which of them lie wholly within the quota; their rows are taken as they are. Only the
    one range per day in which the quota ends is ranked, so no task holds a day. Equal orders are told apart by the row's hash.
    """
    spark = requests.sparkSession
    columns = requests.columns
    ties = F.xxhash64(*[F.col(c) for c in columns])
    named = requests.withColumn("_tie", ties)
    by = [*order, "_tie"]
    path = new_shared_path(spark, "quota-ranges")
    # written once: bounds of ranges are sampled, so a second computation could draw others
    named.repartitionByRange(shuffle_partitions(spark), day, *by).withColumn("_range", F.spark_partition_id()).write.parquet(path)
    dealt = spark.read.schema(T.StructType([*named.schema.fields, T.StructField("_range", T.IntegerType())])).parquet(path)
    # a row for each range and each day in it: fewer than ranges and days together
    before = Window.partitionBy(day).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = dealt.groupBy(day, "_range").agg(F.count(F.lit(1)).alias("_n")).withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    quota = F.lit(maximum)
    if used is not None:
        ranges = ranges.join(used.select(day, "used"), day, "left")
        quota = quota - F.coalesce(F.col("used"), F.lit(0))
    ranges = ranges.select(F.col(day).alias("_day"), F.col("_range").alias("_r"), (quota - F.col("_before")).alias("_left"), "_n").where("_left > 0")
    rows = dealt.join(ranges, F.col(day).eqNullSafe(F.col("_day")) & (F.col("_range") == F.col("_r")))
    whole = rows.where("_n <= _left").select(*columns)
    ends = rows.where("_n > _left").withColumn("_rank", F.row_number().over(Window.partitionBy(day, "_range").orderBy(*by)))
    return whole.unionByName(ends.where("_rank <= _left").select(*columns))
