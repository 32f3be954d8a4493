"""Satellite positions: change suppression and history."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import to_zone
from tidemark.operators import history
from tidemark.operators.aggregates import last_values
from tidemark.operators.incremental import accepted, suppress_unchanged

COORDINATES = ["x_km", "y_km", "z_km"]


def positions(element_sets: DataFrame, computed: DataFrame) -> DataFrame:
    """Element sets with computed coordinates: satellite_id, x_km, y_km, z_km, timestamp, error_code."""
    return element_sets.join(computed, "satellite_id")


def load(current: DataFrame, stored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that replace the table, all rows with their status).

    Compared with the last known position per satellite; failed and unmoved ones are dropped.
    """
    known = last_values(stored, ["satellite_id"], ["timestamp"], COORDINATES)
    judged = suppress_unchanged(current, known, "satellite_id", COORDINATES, F.col("error_code") != 0)
    columns = ["satellite_id", "satellite_name", "timestamp", "tle_line1", "tle_line2", *COORDINATES, "distance_km"]
    return accepted(judged).select(*columns), judged.select("satellite_id", "status")


def snapshot_records(satellite_positions: DataFrame) -> DataFrame:
    return satellite_positions.select(
        "satellite_id",
        "satellite_name",
        to_zone("timestamp").alias("sat_timestamp"),
        "tle_line1",
        "tle_line2",
        *COORDINATES,
        "distance_km",
    )


def satellite_positions_snapshot(stored: DataFrame | None, satellite_positions: DataFrame, now: dt.datetime) -> DataFrame:
    current, key = snapshot_records(satellite_positions), ["satellite_id"]
    if stored is None:
        return history.first_snapshot(current, key, F.col("sat_timestamp"))
    return history.scd2_timestamp(stored, current, key, "sat_timestamp", now)
