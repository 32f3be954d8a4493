"""UV index: the missing (day, city) pairs drive the next requests."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.dates import CALENDAR_START, noon_utc_iso
from tidemark.operators.incremental import DAILY_REQUESTS, daily_usage, missing_pairs
from tidemark.operators.joins import constant_lookup
from tidemark.operators.ordering import quota_cap
from tidemark.operators.relations import inline_rows

# The cities requested, with latitude and longitude.
CITIES = [
    ("Sydney", -33.8688, 151.2093),
    ("Melbourne", -37.8136, 144.9631),
    ("Brisbane", -27.4698, 153.0251),
    ("Perth", -31.9505, 115.8605),
    ("Adelaide", -34.9285, 138.6007),
    ("Canberra", -35.2809, 149.1300),
    ("Hobart", -42.8821, 147.3272),
    ("Darwin", -12.4634, 130.8456),
]


def base_uv(uv_index: DataFrame) -> DataFrame:
    return uv_index.select(
        F.col("uv_time").cast("date").alias("uv_date"),
        "uv",
        "uv_max",
        "uv_time",
        "ozone",
        "city",
        "location__lat",
        "location__lng",
    )


def staging_uv_data_dates(spark: SparkSession, base: DataFrame, as_of: dt.date, cities: DataFrame | None = None) -> DataFrame:
    """The fifty newest (date_col, city) pairs without data up to the day before ``as_of``."""
    if cities is None:
        cities = inline_rows(spark, [(name,) for name, _, _ in CITIES], "city string")
    present = base.select(F.col("uv_date").alias("date_col"), "city")
    return missing_pairs(cities, present, "city", "date_col", CALENDAR_START, as_of - dt.timedelta(days=1))


def requests(missing: DataFrame, log: DataFrame, today: dt.date) -> DataFrame:
    """Requests to send today: known cities only, newest day first, within the daily quota.

    ``log`` has a ``run_day`` per successful request.
    """
    known = constant_lookup(missing, CITIES, "name string, lat double, lng double", ("city", "name"))
    todays = known.withColumn("run_day", F.lit(today)).withColumn("dt", noon_utc_iso("date_col"))
    used = daily_usage(log, "run_day", today)
    return quota_cap(todays, "run_day", [F.desc("date_col"), F.asc("city")], DAILY_REQUESTS, used)
