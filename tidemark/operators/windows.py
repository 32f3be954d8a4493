"""Partition statistics, trailing averages and differences between neighbours.

Whole-partition values come from grouped aggregates joined back, running ones
from windows over slices, so that no task has to hold all rows of a hot key.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from tidemark.functions.keys import all_true
from tidemark.functions.numbers import round_ieee
from tidemark.operators.joins import lookup_join
from tidemark.operators.sizing import groups_fit_broadcast, one_task_reads
from tidemark.operators.skew import HALO, ROWS_PER_SLICE, SLICE, with_halo

FORTNIGHT = 13  # rows before the current one


def partition_values(df: DataFrame, keys: Sequence[str], **aggs: Column) -> DataFrame:
    """Add aggregates over all rows with the same keys: ``agg OVER (PARTITION BY keys)``.

    The number of keys is estimated by a sketch before the join, so that the aggregates of few keys are broadcast
    and the rows are not shuffled.
    """
    grouped = df.groupBy(*[F.col(k).alias(f"_of_{k}") for k in keys]).agg(*[c.alias(n) for n, c in aggs.items()])
    if not one_task_reads(df) and groups_fit_broadcast(df, keys, grouped):
        grouped = F.broadcast(grouped)
        return df.join(grouped, all_true([F.col(k) == F.col(f"_of_{k}") for k in keys]), "left").drop(*[f"_of_{k}" for k in keys])
    return lookup_join(df, grouped, [(k, f"_of_{k}") for k in keys])


def first_value(value: str, order: Sequence[str]) -> Column:
    """Value of the first row by ``order``; as an aggregate, so it combines before the shuffle."""
    return F.min_by(value, F.struct(*order))


def last_value(value: str, order: Sequence[str]) -> Column:
    return F.max_by(value, F.struct(*order))


def with_peer_last(df: DataFrame, name: str, value: str, keys: Sequence[str], time: str, tie: str) -> DataFrame:
    """Add the running ``LAST`` with the default frame: the last row at the current row's time.

    The peers' last row comes from an aggregate, which combines before its shuffle, and is joined back with salts,
    so an instant with a third of all rows fills no task. Keys and times may be NULL: they are compared as one struct.
    """
    peers = df.withColumn("_peers", F.struct(*keys, time))
    last = peers.groupBy(F.col("_peers").alias("_last_of")).agg(F.max_by(value, tie).alias(name))
    return lookup_join(peers, last, [("_peers", "_last_of")]).drop("_peers")


def price_movements(df: DataFrame, keys: Sequence[str], value: str, time: str, tie: str) -> DataFrame:
    """Spread, movement since the first row, total movement and row count per partition."""
    order = [time, tie]
    with_totals = partition_values(
        df,
        keys,
        _spread=F.max(value) - F.min(value),
        _first=first_value(value, order),
        _last=last_value(value, order),
        _entries=F.count(tie),
    )
    return (
        with_peer_last(with_totals, "_running", value, keys, time, tie)
        .withColumn("price_spread", round_ieee("_spread"))
        .withColumn("relative_price_movement", round_ieee(F.col("_running") - F.col("_first")))
        .withColumn("abs_price_movement", round_ieee(F.col("_last") - F.col("_first")))
        .withColumnRenamed("_entries", "num_stock_entries")
        .drop("_spread", "_first", "_last", "_running")
    )


def over_previous(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    values: Sequence[str],
    preceding: int,
    exprs: Mapping[str, Callable[[WindowSpec], Column]],
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Add expressions that look back at most ``preceding`` rows in key order.

    Each entry of ``exprs`` is a function from the ordered window to a column that
    reads only ``values``. ``order`` must be unique within the keys.
    """
    rows = with_halo(df, keys, order, values, preceding, rows_per_slice)
    if rows is None:
        window = Window.partitionBy(*keys).orderBy(*order)
        return df.withColumns({name: make(window) for name, make in exprs.items()})
    window = Window.partitionBy(*keys, SLICE).orderBy(*order)
    built = {name: make(window) for name, make in exprs.items()}
    return rows.withColumns(built).where(~F.col(HALO)).drop(HALO, SLICE)


def trailing_mean(column: str | Column, preceding: int = FORTNIGHT):
    """Mean of the current row and up to ``preceding`` rows before it; counts rows, not days."""
    return lambda window: F.avg(column).over(window.rowsBetween(-preceding, 0))


def trailing_anomaly(column: str, preceding: int = FORTNIGHT):
    """Value minus its trailing mean."""
    return lambda window: F.col(column) - F.avg(column).over(window.rowsBetween(-preceding, 0))


def lag_difference(column: str):
    """Value minus the one before; NULL on the first row."""
    return lambda window: F.col(column) - F.lag(column).over(window)


def lagged(column: str):
    return lambda window: F.lag(column).over(window)
