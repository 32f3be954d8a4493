"""Slowly changing dimensions of type 2.

History has the business columns followed by ``dbt_scd_id``, ``dbt_updated_at``,
``dbt_valid_from`` and ``dbt_valid_to``; a row is open while ``dbt_valid_to`` is NULL.
Keys are unique among open rows and in the current extract, so the join that
compares them has one row per key on either side. Closed rows pass by unshuffled.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.keys import any_true, scd_row_id

SCD_COLUMNS = ("dbt_scd_id", "dbt_updated_at", "dbt_valid_from", "dbt_valid_to")


def instant(value: dt.datetime) -> Column:
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def open_rows(history: DataFrame) -> DataFrame:
    return history.where(F.col("dbt_valid_to").isNull())


def first_snapshot(current: DataFrame, keys: Sequence[str], updated_at: Column) -> DataFrame:
    """History after the first run: every row open since its change time."""
    return _opened(current, keys, updated_at)


def scd2_check(
    history: DataFrame,
    current: DataFrame,
    keys: Sequence[str],
    check_cols: Sequence[str],
    now: dt.datetime,
    hard_deletes: bool = True,
) -> DataFrame:
    """A row changes when any checked column differs, NULLs being equal."""
    changed = any_true([~F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}")) for c in check_cols])
    return _merge(history, current, keys, changed, instant(now), instant(now), hard_deletes)


def scd2_timestamp(
    history: DataFrame,
    current: DataFrame,
    keys: Sequence[str],
    updated_at: str,
    now: dt.datetime,
    hard_deletes: bool = False,
) -> DataFrame:
    """A row changes when its update time is later than the open row's start."""
    changed = F.col("old.dbt_valid_from") < F.col(f"new.{updated_at}")
    return _merge(history, current, keys, changed, F.col(updated_at), instant(now), hard_deletes)


def _opened(rows: DataFrame, keys: Sequence[str], updated_at: Column) -> DataFrame:
    return rows.select(
        "*",
        scd_row_id(list(keys), updated_at).alias("dbt_scd_id"),
        updated_at.alias("dbt_updated_at"),
        updated_at.alias("dbt_valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("dbt_valid_to"),
    )


def _pairs(old: DataFrame | None, current: DataFrame, keys: Sequence[str], updated_at: Column) -> DataFrame:
    """Open rows (``old``) and rows that would be opened (``new``), one full outer join on unique keys."""
    new = _opened(current, keys, updated_at).withColumn("_found", F.lit(True)).alias("new")
    if old is None:
        old = current.sparkSession.createDataFrame([], new.drop("_found").schema)
    old = old.withColumn("_stored", F.lit(True)).alias("old")
    same = [F.col(f"old.{k}").eqNullSafe(F.col(f"new.{k}")) for k in keys]
    return old.join(new, same, "full_outer")


def _records(pairs: DataFrame, columns: Sequence[str], changed: Column, now: Column, hard_deletes: bool, only_changes: bool) -> DataFrame:
    """Each pair's stored row, closed or kept, and the row it opens; of kept rows none if only changes are wanted."""
    stored, found = F.col("old._stored").isNotNull(), F.col("new._found").isNotNull()
    is_change = stored & found & F.coalesce(changed, F.lit(False))
    end = F.when(is_change, F.col("new.dbt_valid_from"))
    if hard_deletes:
        end = end.when(stored & ~found, now)

    def record(side: str, valid_to: Column) -> Column:
        fields = [F.col(f"{side}.{c}").alias(c) for c in (*columns, *SCD_COLUMNS[:-1])]
        return F.struct(*fields, valid_to.cast("timestamp_ntz").alias("dbt_valid_to"))

    kept = F.when(stored & end.isNotNull() if only_changes else stored, record("old", end))
    opened = F.when(found & (is_change | ~stored), record("new", F.lit(None)))
    return pairs.select(F.explode(F.array_compact(F.array(kept, opened))).alias("_row")).select("_row.*")


def _merge(
    history: DataFrame,
    current: DataFrame,
    keys: Sequence[str],
    changed: Column,
    updated_at: Column,
    now: Column,
    hard_deletes: bool,
) -> DataFrame:
    """One full outer join, whose pairs emit the kept or closed row and the opened one."""
    rows = _records(_pairs(open_rows(history), current, keys, updated_at), current.columns, changed, now, hard_deletes, False)
    closed = history.where(F.col("dbt_valid_to").isNotNull()).select(*current.columns, *SCD_COLUMNS)
    return closed.unionByName(rows)


def scd2_changes(
    opened: DataFrame | None,
    current: DataFrame,
    keys: Sequence[str],
    changed: Column,
    updated_at: Column,
    now: Column,
    hard_deletes: bool,
) -> DataFrame:
    """Only what a run changes in the open rows: rows it closes (``dbt_valid_to`` set) and rows it opens."""
    return _records(_pairs(opened, current, keys, updated_at), current.columns, changed, now, hard_deletes, True)


def as_of(history: DataFrame, when: dt.datetime) -> DataFrame:
    """The rows valid at one moment."""
    t = instant(when)
    return history.where(
        (F.col("dbt_valid_from") <= t) & (F.col("dbt_valid_to").isNull() | (F.col("dbt_valid_to") > t))
    )
