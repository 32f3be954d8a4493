"""Splitting of hot keys.

A key is hot when it holds more rows than an average shuffle partition. With P
shuffle partitions fewer than P keys can be hot, so a hot-key table has a size
bound that does not depend on the data. It is measured by one column-pruned,
map-side combined count before the plan is built, so that the plan for data
without hot keys is the plain one.

Joins spread the rows of a hot key over salts. Ordered windows cut a hot key
into slices of the ordering column and give each slice the few rows before it.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.keys import all_true
from tidemark.operators.sizing import one_task_reads
from tidemark.session import shuffle_partitions

ROWS_PER_SLICE = 1_000
SALT = "_salt"
SLICE = "_slice"
HALO = "_halo"


def hot_keys(
    df: DataFrame, keys: Sequence[str], *stats: Column, weight: Column | None = None
) -> DataFrame | None:
    """Keys heavier than an average shuffle partition, or None when there are none.

    ``weight`` is summed instead of counting rows. Columns: the keys, ``_salts``
    (the number of average partitions the key would fill) and ``stats``. Fewer than P
    rows come back, which become part of the plan.
    """
    spark = df.sparkSession
    parts = shuffle_partitions(spark)
    measure = (F.count(F.lit(1)) if weight is None else F.sum(weight)).cast("double")
    grouped = df.groupBy(*keys).agg(measure.alias("_weight"), *stats)
    heaviest, total = grouped.agg(F.max("_weight"), F.sum("_weight")).first()
    if heaviest is None or heaviest * parts <= total:
        return None
    hot = (
        grouped.where(F.col("_weight") * parts > total)
        .withColumn("_salts", F.ceil(F.col("_weight") * parts / total).cast("int"))
        .drop("_weight")
    )
    found = hot.toArrow()  # fewer than P rows
    return spark.createDataFrame(found, hot.schema) if found.num_rows else None


def mark_hot(df: DataFrame, hot: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` with the other columns of ``hot``; NULL where the key is not hot."""
    named = [F.col(k).alias(f"_hot_{i}") for i, k in enumerate(keys)]
    rest = [c for c in hot.columns if c not in keys]
    right = F.broadcast(hot.select(*named, *rest))  # fewer than P rows, see hot_keys
    same = all_true([F.col(k).eqNullSafe(F.col(f"_hot_{i}")) for i, k in enumerate(keys)])
    return df.join(right, same, "left").drop(*[f"_hot_{i}" for i in range(len(keys))])


def salt_rows(df: DataFrame, hot: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Give each row of a hot key one of the key's salts.

    The salt comes from the row and its input partition, so a rerun of a task repeats it,
    rows of a key that lie together spread, and so do equal rows of several partitions.
    """
    content = [F.col(f.name) for f in df.schema.fields if not re.search("map<|variant", f.dataType.simpleString())]
    place = F.spark_partition_id() + F.pmod(F.xxhash64(*content), F.col("_salts"))
    salt = F.when(F.col("_salts").isNotNull(), F.pmod(place, F.col("_salts")))
    return mark_hot(df, hot, keys).withColumn(SALT, F.coalesce(salt, F.lit(0))).drop("_salts")


def repeat_per_salt(df: DataFrame, hot: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Repeat the rows of a hot key once per salt."""
    salts = F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1)
    return mark_hot(df, hot, keys).withColumn(SALT, F.explode(salts)).drop("_salts")


def order_position(df: DataFrame, column: str) -> Column:
    """A number that never falls as ``column`` rises; whole seconds for timestamps."""
    kind, c = df.schema[column].dataType, F.col(column)
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("bigint")
    if isinstance(kind, (T.TimestampNTZType, T.TimestampType)):
        if isinstance(kind, T.TimestampType):
            return F.unix_seconds(c)
        # Taken field by field, because a cast to an instant would follow the session zone.
        return F.unix_date(c.cast("date")).cast("bigint") * 86_400 + F.hour(c) * 3600 + F.minute(c) * 60 + F.second(c)
    if isinstance(kind, T.IntegralType):
        return c.cast("bigint")
    # NaN and values beyond a bigint share the outermost positions
    return F.floor(F.least(F.greatest(c.cast("double"), F.lit(-9e18)), F.lit(9e18))).cast("bigint")


def slice_hot_keys(
    df: DataFrame, keys: Sequence[str], order: str, rows_per_slice: int = ROWS_PER_SLICE
) -> DataFrame | None:
    """Add ``_slice``, a rising range number on ``order`` for hot keys and NULL for others.

    None when no key is hot, one task could read the rows, or ``order`` is neither a number
    nor a date or time. Slice widths come from the key's count, minimum and maximum.
    NULL comes before all else and is slice -1.
    """
    sliced = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)
    if one_task_reads(df) or not isinstance(df.schema[order].dataType, sliced):
        return None
    position = order_position(df, order)
    n, lo, hi = F.count(F.lit(1)), F.min(position), F.max(position)
    slices = F.ceil(n / F.lit(rows_per_slice))
    width = F.greatest(F.lit(1.0), (hi.cast("double") - lo.cast("double") + 1) / slices)
    hot = hot_keys(df, keys, lo.alias("_lo"), width.alias("_width"))
    if hot is None:
        return None
    number = F.floor((position.cast("double") - F.col("_lo").cast("double")) / F.col("_width")).cast("bigint")
    number = F.when(F.col("_width").isNotNull(), F.coalesce(number, F.lit(-1)))
    return mark_hot(df, hot.drop("_salts"), keys).withColumn(SLICE, number).drop("_lo", "_width")


def with_halo(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    values: Sequence[str],
    halo: int,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame | None:
    """Slice hot keys and prepend to each slice the ``halo`` rows before it.

    A window over keys and ``_slice`` that looks back at most ``halo`` rows then
    gives the result of the window over the keys alone. Halo rows carry
    ``_halo = true`` and only the ``values``; drop them afterwards. None when no key
    is hot or the rows are few.

    The rows that may precede a later slice are the last ``halo`` of each slice.
    Those are cut down before their shuffle, to ``halo`` rows per slice.
    """
    rows = slice_hot_keys(df, keys, order[0], rows_per_slice)
    if rows is None:
        return None
    newest_first = Window.partitionBy(*keys, SLICE).orderBy(*[F.col(c).desc() for c in order])
    carried = list(dict.fromkeys([*order, *values]))
    tails = (
        rows.where(F.col(SLICE).isNotNull())
        .select(*keys, SLICE, *[c for c in carried if c not in keys])
        .withColumn("_rank", F.row_number().over(newest_first))
        .where(F.col("_rank") <= halo)
    )
    in_order = Window.partitionBy(*keys).orderBy(*order)
    before = F.collect_list(F.struct(*carried)).over(in_order.rowsBetween(-halo, -1))
    halo_rows = (
        tails.withColumn("_before", before)
        .withColumn("_slice_before", F.lag(SLICE).over(in_order))
        .where(F.col("_slice_before") != F.col(SLICE))
        .select(*keys, SLICE, F.explode("_before").alias("_row"))
        .select(*keys, SLICE, *[F.col(f"_row.{c}").alias(c) for c in carried if c not in keys])
        .withColumn(HALO, F.lit(True))
    )
    return rows.withColumn(HALO, F.lit(False)).unionByName(halo_rows, allowMissingColumns=True)
