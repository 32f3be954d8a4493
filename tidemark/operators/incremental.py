"""Incremental loading: gates, change detection, gap planning and suppression.

Each operator is a function of state and new data. State tables and decisions
stay DataFrames; single values reach a filter as scalar subqueries.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import day_span
from tidemark.functions.keys import as_col
from tidemark.functions.numbers import DEFAULT_TOLERANCE, distance, within_tolerance
from tidemark.operators.history import instant
from tidemark.operators.joins import date_spine_join, missing_rows
from tidemark.operators.ordering import top_n

# Limits of the incremental loads.
WATERMARK_BUFFER = "30 minutes"
DAILY_REQUESTS = 50
MISSING_BATCH = 50
FRESH_HOURS = 72

WATERMARK_STATE = (
    "latest_ts timestamp_ntz, last_run timestamp_ntz, processed_records bigint, last_run_status string"
)


def watermark_gate(
    batch: DataFrame, state: DataFrame, ts: str, now: dt.datetime, buffer: str = WATERMARK_BUFFER
) -> tuple[DataFrame, DataFrame]:
    """Load the whole batch only if its newest time passes the stored one by more than ``buffer``.

    Returns the accepted rows (all or none) and the new one-row state.
    """
    newest = batch.agg(F.max(ts)).scalar()
    stored = state.agg(F.max("latest_ts")).scalar()
    stored_count = state.agg(F.max("processed_records")).scalar()
    passes = stored.isNull() | (newest > stored + F.expr(f"interval {buffer}"))
    accepted = batch.where(passes)

    summary = batch.agg(F.max(ts).alias("_newest"), F.count(F.lit(1)).alias("_n"))
    empty = F.col("_n") == 0
    load = ~empty & (stored.isNull() | (F.col("_newest") > stored + F.expr(f"interval {buffer}")))
    new_state = summary.select(
        F.when(load, F.col("_newest")).otherwise(stored).alias("latest_ts"),
        instant(now).alias("last_run"),
        F.when(load, F.col("_n")).otherwise(F.coalesce(stored_count, F.lit(0))).alias("processed_records"),
        F.when(empty, F.lit("skipped_empty_data"))
        .when(load, F.lit("success"))
        .otherwise(F.lit("skipped_no_new_data"))
        .alias("last_run_status"),
    )
    return accepted, new_state


def required_columns_gate(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """One row (status, row_count): empty data, a missing column, or ready."""
    missing = [c for c in required if c not in df.columns]
    n = F.count(F.lit(1))
    absent = F.lit(f"skipped_missing_{missing[0].lower()}") if missing else F.lit("ready")
    return df.agg(F.when(n == 0, F.lit("skipped_empty_data")).otherwise(absent).alias("status"), n.alias("row_count"))


def filter_unseen(batch: DataFrame, seen: DataFrame, key: str, target: DataFrame | None = None) -> DataFrame:
    """Rows whose key was not seen before; everything passes while ``target`` is empty."""
    if target is not None:
        seen = seen.where(target.agg(F.count(F.lit(1))).scalar() > 0)
    return missing_rows(batch, seen, [key])


def change_status(api: Column, previous: Column, table: Column, variant: str) -> Column:
    """``reload``, ``skip``, ``load`` or ``failed`` from three counts.

    - ``dropped``: reload when the table lost rows, skip when the source count is unchanged;
    - ``dropped_or_empty``: as above, an empty table also reloads;
    - ``growth``: reload when the source grew, skip when unchanged and the table has rows;
    - ``both_equal``: skip only when source and table equal the previous count, fail on no records.
    """
    reload, skip, load = F.lit("reload"), F.lit("skip"), F.lit("load")
    variants = {
        "dropped": F.when(table < previous, reload).when(api == previous, skip).otherwise(load),
        "dropped_or_empty": F.when((table < previous) | (table == 0), reload)
        .when(api == previous, skip)
        .otherwise(load),
        "growth": F.when(previous < api, reload).when((table > 0) & (api == previous), skip).otherwise(load),
        "both_equal": F.when((api == previous) & (table == previous), skip)
        .when(api == 0, F.lit("failed"))
        .otherwise(load),
    }
    return variants[variant]


def change_plan(
    source: DataFrame, previous: DataFrame, table: DataFrame, key: str, variant: str
) -> DataFrame:
    """Compare per-key counts of source, last run and table.

    Each input has (key, ``n``). Keys of the source decide; counts missing elsewhere are 0.
    """
    joined = (
        source.select(key, F.col("n").alias("api_count"))
        .join(previous.select(key, F.col("n").alias("previous_count")), key, "left")
        .join(table.select(key, F.col("n").alias("table_count")), key, "left")
        .na.fill(0, ["previous_count", "table_count"])
    )
    status = change_status(F.col("api_count"), F.col("previous_count"), F.col("table_count"), variant)
    return joined.withColumn("status", status)


def gap_plan(
    entities: DataFrame, loaded: DataFrame, entity: str, day: str, start: dt.date, end: dt.date
) -> DataFrame:
    """The date range each entity still needs: (entity, status, start_date, end_date).

    ``skipped`` when the span is complete or nothing is left before ``end``, ``new`` when
    the entity has no rows, else ``update`` from the day after its last one. Spans are
    judged by first and last day, so holes inside are not seen.
    """
    first_day, last_day = F.lit(start), F.lit(end)
    coverage = loaded.groupBy(entity).agg(F.min(day).alias("_min"), F.max(day).alias("_max"))
    complete = (day_span("_min", "_max") >= day_span(first_day, last_day)) & (F.col("_max") >= last_day)
    begin = F.when(F.col("_max").isNull(), first_day).otherwise(F.greatest(F.date_add("_max", 1), first_day))
    return (
        entities.select(entity)
        .join(coverage, entity, "left")
        .withColumn("_start", begin)
        .withColumn(
            "status",
            F.when(F.coalesce(complete, F.lit(False)) | (F.col("_start") > last_day), F.lit("skipped"))
            .when(F.col("_max").isNull(), F.lit("new"))
            .otherwise(F.lit("update")),
        )
        .select(
            entity,
            "status",
            F.when(F.col("status") != "skipped", F.col("_start")).alias("start_date"),
            F.when(F.col("status") != "skipped", last_day).alias("end_date"),
        )
    )


def missing_pairs(
    entities: DataFrame,
    loaded: DataFrame,
    entity: str,
    day: str,
    start: Column | dt.date,
    end: Column | dt.date,
    batch: int = MISSING_BATCH,
) -> DataFrame:
    """The newest (day, entity) pairs not loaded yet, the next requests to make."""
    first = F.lit(start) if isinstance(start, dt.date) else start
    last = F.lit(end) if isinstance(end, dt.date) else end
    wanted = date_spine_join(entities.select(entity), first, last, day)
    missing = missing_rows(wanted, loaded, [day, entity]).select(day, entity)
    return top_n(missing, batch, F.col(day).desc(), F.col(entity).asc())


def suppress_unchanged(
    current: DataFrame,
    state: DataFrame,
    key: str,
    coordinates: Sequence[str],
    failed: Column | None = None,
    tolerance: float = DEFAULT_TOLERANCE,
) -> DataFrame:
    """Status and distance of each record against the stored position of its key.

    ``firstrun`` without a stored position, ``skipped`` when every coordinate is within
    the tolerance, ``failed`` where the condition holds, else ``success``. Both inputs have
    one row per key. Keep ``success`` and ``firstrun`` rows to load and to refresh the state.
    """
    before = state.select(key, *[F.col(c).alias(f"_before_{c}") for c in coordinates], F.lit(True).alias("_stored"))
    pairs = [(c, f"_before_{c}") for c in coordinates]
    bad = F.lit(False) if failed is None else failed
    status = (
        F.when(bad, F.lit("failed"))
        .when(F.col("_stored").isNull(), F.lit("firstrun"))
        .when(within_tolerance(pairs, tolerance), F.lit("skipped"))
        .otherwise(F.lit("success"))
    )
    return (
        current.join(before, key, "left")
        .withColumn("status", status)
        .withColumn("distance_km", F.when(F.col("status") == "success", distance(pairs)))
        .drop("_stored", *[b for _, b in pairs])
    )


def accepted(df: DataFrame) -> DataFrame:
    """Records to load after :func:`suppress_unchanged`."""
    return df.where(F.col("status").isin("success", "firstrun"))


def fresh_rows(df: DataFrame, modified: str, as_of: dt.datetime, hours: int = FRESH_HOURS) -> DataFrame:
    """Rows younger than the limit at ``as_of``."""
    return df.where(as_col(modified) > instant(as_of - dt.timedelta(hours=hours)))


def daily_usage(requests: DataFrame, day: str, today: dt.date | None = None) -> DataFrame:
    """(day, ``used``) counts; with ``today``, only that day is kept."""
    kept = requests if today is None else requests.where(F.col(day) == F.lit(today))
    return kept.groupBy(day).agg(F.count(F.lit(1)).alias("used"))
