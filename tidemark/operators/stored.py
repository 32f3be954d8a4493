"""Merges and histories on stored tables that rewrite only what changes.

A run stages its changes, looks up the buckets of the changed keys and writes those anew; files of other
buckets stay in the table as they are. A history keeps closed rows in files of their own, which no later
run reads or writes.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.keys import all_true, any_true
from tidemark.operators.history import SCD_COLUMNS, instant, scd2_changes
from tidemark.operators.loading import latest_per_key
from tidemark.session import new_shared_path
from tidemark.sources.stored import BUCKET, State, StoredTable, nullable

OPEN, CLOSED = "open", "closed"


def stage_changes(table: StoredTable, state: State, changes: DataFrame) -> tuple[DataFrame, list[int]]:
    """The changes as a written table, so that they are computed once, and the buckets of their keys."""
    path = new_shared_path(table.spark, "changes")
    changes.withColumn(BUCKET, table.bucket_of(state)).write.parquet(path)
    staged = table.spark.read.parquet(path)
    touched = sorted(row[0] for row in staged.select(BUCKET).distinct().collect())  # at most one for each bucket
    return staged.drop(BUCKET), touched


def without_keys(rows: DataFrame, gone: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not among ``gone``; a NULL key equals a NULL key."""
    named = gone.select(*[F.col(k).alias(f"_gone_{k}") for k in keys])
    return rows.join(named, all_true([F.col(k).eqNullSafe(F.col(f"_gone_{k}")) for k in keys]), "left_anti")


def merge_stored(table: StoredTable, updates: DataFrame, order: Sequence[str]) -> list[int]:
    """The last update per key replaces the stored row. Returns the buckets rewritten.

    The first merge gives the table the columns of its updates; later updates are cast to those, and other
    columns serve the order only.
    """
    state = table.state()
    if not state.keys:
        raise ValueError("only a table with keys can be merged")
    names = state.struct().names if state.schema else updates.columns
    schema = state.struct() if state.schema else nullable(updates.schema)
    winners = latest_per_key(updates, state.keys, order).select(*[F.col(c).cast(schema[c].dataType).alias(c) for c in names])
    staged, touched = stage_changes(table, state, winners)
    if not touched and state.version:
        return touched
    rows, removed = staged, []
    if state.version:
        rows = without_keys(table.read(buckets=touched, state=state), staged, state.keys).unionByName(staged)
        removed = [f.path for f in state.files.values() if f.bucket in set(touched)]
    table.commit(state, schema, table.write(rows, state), removed)
    return touched


def scd2_check_stored(table: StoredTable, current: DataFrame, check_cols: Sequence[str], now: dt.datetime, hard_deletes: bool = True) -> list[int]:
    """A history run in which a row changes when any checked column differs. Returns the buckets rewritten."""
    changed = any_true([~F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}")) for c in check_cols])
    return _run(table, current, changed, instant(now), instant(now), hard_deletes)


def scd2_timestamp_stored(table: StoredTable, current: DataFrame, updated_at: str, now: dt.datetime, hard_deletes: bool = False) -> list[int]:
    """A history run in which a row changes when its update time is later than the open row's start."""
    changed = F.col("old.dbt_valid_from") < F.col(f"new.{updated_at}")
    return _run(table, current, changed, F.col(updated_at), instant(now), hard_deletes)


def _run(table: StoredTable, current: DataFrame, changed: Column, updated_at: Column, now: Column, hard_deletes: bool) -> list[int]:
    state = table.state()
    if not state.keys:
        raise ValueError("a history needs a table with keys")
    if state.schema:
        current = current.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in state.struct().fields if f.name not in SCD_COLUMNS])
    stored = table.read(tags=[OPEN], state=state) if state.version else None
    staged, touched = stage_changes(table, state, scd2_changes(stored, current, state.keys, changed, updated_at, now, hard_deletes))
    if not touched and state.version:
        return touched
    opened, closed = staged.where("dbt_valid_to IS NULL"), staged.where("dbt_valid_to IS NOT NULL")
    add, removed = [], []
    if state.version:
        kept = without_keys(table.read(tags=[OPEN], buckets=touched, state=state), closed, state.keys)
        opened = kept.unionByName(opened)
        add = table.write(closed, state, CLOSED)
        removed = [f.path for f in state.files.values() if f.tag == OPEN and f.bucket in set(touched)]
    table.commit(state, nullable(staged.schema), [*add, *table.write(opened, state, OPEN)], removed)
    return touched
