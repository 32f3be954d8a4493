"""Lookup and spine joins; star and hierarchy combinations come from :mod:`tidemark.operators.combinations`."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import explode_days
from tidemark.functions.keys import all_true
from tidemark.operators.combinations import hierarchy, star_fanout
from tidemark.operators.relations import inline_rows
from tidemark.operators.sizing import fits_broadcast, one_task_reads
from tidemark.operators.skew import SALT, hot_keys, repeat_per_salt, salt_rows

__all__ = [
    "aggregate_lookup", "constant_lookup", "date_spine_join", "fanout_report", "hierarchy", "join_child", "lookup_join", "missing_rows", "star_fanout",
]

LOOKUP_JOINS = ("left", "inner", "left_semi", "left_anti")


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    on: Sequence[tuple[str, str]],
    how: str = "left",
    keys_from: DataFrame | None = None,
) -> DataFrame:
    """Equi-join from many rows to a lookup, with hot row keys spread over salts.

    ``on`` pairs a column of ``rows`` with one of ``lookup``. The lookup's key columns
    are dropped and its other names must differ from those of ``rows``. NULL keys
    match nothing, yet are spread like any other hot key. Several lookup rows per
    key multiply the result.

    Rows that one task could read are joined as they are. Else a lookup whose size is
    within the broadcast limit is broadcast, so the rows are not shuffled. Failing that,
    hot keys are counted first, on ``keys_from`` if ``rows`` is costly and some earlier
    table has the same keys.
    """
    if how not in LOOKUP_JOINS:
        raise ValueError(f"lookup_join keeps to {', '.join(LOOKUP_JOINS)}; rows of the lookup are repeated per salt")
    row_keys, lookup_keys = [a for a, _ in on], [b for _, b in on]
    names = {b: f"_lookup_{i}" for i, b in enumerate(lookup_keys)}
    same = all_true([F.col(a) == F.col(names[b]) for a, b in on])
    measured, hot = rows if keys_from is None else keys_from, None
    if not one_task_reads(rows):
        if fits_broadcast(lookup, rows):
            small = F.broadcast(lookup.withColumnsRenamed(names))
            return rows.join(small, same, how).drop(*names.values())
        hot = hot_keys(measured, row_keys)
    if hot is None:
        return rows.join(lookup.withColumnsRenamed(names), same, how).drop(*names.values())
    hot_lookup = hot.select(*[F.col(a).alias(b) for a, b in on], "_salts")
    left = salt_rows(rows, hot, row_keys)
    right = repeat_per_salt(lookup, hot_lookup, lookup_keys).withColumnsRenamed({**names, SALT: "_salt_r"})
    return left.join(right, same & (F.col(SALT) == F.col("_salt_r")), how).drop(SALT, "_salt_r", *names.values())


def join_child(child: DataFrame, root: DataFrame, root_key: str, natural_key: str, to: str) -> DataFrame:
    """Child rows with the natural key of their root as ``to``; orphans are dropped."""
    keys = root.select(F.col(root_key).alias("_root_key"), F.col(natural_key).alias(to)).where(F.col(to).isNotNull())
    return lookup_join(child, keys, [("_dlt_root_id", "_root_key")], "inner").drop("_dlt_root_id")


def aggregate_lookup(left: DataFrame, right: DataFrame, key: str, right_key: str, *aggs: Column) -> DataFrame:
    """Left join to per-key aggregates of ``right``; NULL where a key has no rows."""
    grouped = right.groupBy(F.col(right_key).alias("_group_key")).agg(*aggs)
    return left.join(grouped, left[key] == grouped["_group_key"], "left").drop("_group_key")


def constant_lookup(df: DataFrame, constants: Sequence[tuple], schema: str, on: tuple[str, str]) -> DataFrame:
    """Inner join to a relation written in the code; rows without a match are skipped."""
    values = inline_rows(df.sparkSession, constants, schema)
    return df.join(F.broadcast(values), df[on[0]] == values[on[1]], "inner").drop(values[on[1]])


def date_spine_join(entities: DataFrame, start, end, name: str = "date_col") -> DataFrame:
    """Every entity with every day of a range, generated in place per entity."""
    return explode_days(entities, start, end, name)


def missing_rows(wanted: DataFrame, present: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``wanted`` whose keys ``present`` lacks.

    The keys present are reduced to distinct ones before they are shuffled, so a
    key with many rows costs one row.
    """
    return wanted.join(present.select(*keys).distinct(), list(keys), "left_anti")


def fanout_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys with more than one row, to be read before a join that would multiply."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)
