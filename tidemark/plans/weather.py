"""Daily weather: from column-oriented answers to the weather fact."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import explode_year_chunks
from tidemark.operators import windows
from tidemark.operators.incremental import gap_plan
from tidemark.operators.joins import lookup_join
from tidemark.operators.loading import merge_upsert
from tidemark.operators.shaping import arrays_to_rows, flatten_structs

# First day wanted, days the source lags behind, and its metric names.
FIRST_DAY = dt.date(2021, 1, 1)
SOURCE_LAG_DAYS = 2
METRICS = {
    "temperature_max": "temperature_2m_max",
    "temperature_min": "temperature_2m_min",
    "temperature_mean": "temperature_2m_mean",
    "precipitation_sum": "precipitation_sum",
    "windspeed_max": "windspeed_10m_max",
    "windgusts_max": "windgusts_10m_max",
    "sunshine_duration": "sunshine_duration",
    "uv_index_max": "uv_index_max",
}


def request_chunks(cities: DataFrame, stored: DataFrame, today: dt.date) -> DataFrame:
    """The (city, chunk_start, chunk_end) ranges to fetch, cut at calendar years."""
    plan = gap_plan(cities, stored, "city", "date", FIRST_DAY, today - dt.timedelta(days=SOURCE_LAG_DAYS))
    chunks = explode_year_chunks(plan.where(F.col("status") != "skipped"), "start_date", "end_date")
    return chunks.select("city", "chunk_start", "chunk_end")


def daily_records(payload: DataFrame) -> DataFrame:
    """One row per city and day from (city, location, timestamp, daily struct of arrays)."""
    flat = payload.select("city", "location", "timestamp", "daily.*")
    rows = arrays_to_rows(flat, ["city", "location", "timestamp"], {"date": "time", **METRICS})
    return flatten_structs(rows.drop("position").withColumn("date", F.col("date").cast("date")))


def merge_daily(stored: DataFrame, records: DataFrame) -> DataFrame:
    return merge_upsert(stored, records, ["date", "city"], ["timestamp"])


def base_weather(daily_weather: DataFrame) -> DataFrame:
    return daily_weather.select(
        F.col("date").cast("date").alias("weather_date"),
        "city",
        "temperature_max",
        "temperature_min",
        "temperature_mean",
        "precipitation_sum",
        "windspeed_max",
        "windgusts_max",
        "sunshine_duration",
        F.col("location__lat").alias("latitude"),
        F.col("location__lng").alias("longitude"),
    )


def staging_weather(base: DataFrame) -> DataFrame:
    """Range, trailing means over fourteen rows and the day-to-day change per city."""
    series = {
        "precipitation_fortnightly_anomaly": windows.trailing_anomaly("precipitation_sum"),
        "mean_temp_fortnightly_anomaly": windows.trailing_anomaly("temperature_mean"),
        "mean_temp_fortnightly_avg": windows.trailing_mean("temperature_mean"),
        "mean_temp_moving_avg": windows.lag_difference("temperature_mean"),
    }
    values = ["precipitation_sum", "temperature_mean"]
    rows = windows.over_previous(base, ["city"], ["weather_date"], values, windows.FORTNIGHT, series)
    spread = (F.col("temperature_max") - F.col("temperature_min")).alias("temperature_range")
    return rows.select(*base.columns, spread, *series)


def fact_weather(staging: DataFrame, staging_geo: DataFrame) -> DataFrame:
    """Facts with the city key. A name shared by several cities multiplies its facts."""
    facts = staging.select(
        "weather_date",
        "city",
        "temperature_max",
        "temperature_min",
        "temperature_range",
        "temperature_mean",
        "precipitation_sum",
        "precipitation_fortnightly_anomaly",
        "windspeed_max",
        "windgusts_max",
        "sunshine_duration",
        "mean_temp_fortnightly_anomaly",
        "mean_temp_fortnightly_avg",
        "mean_temp_moving_avg",
    )
    keys = staging_geo.select(F.col("city").alias("geo_city"), "city_sk")
    return lookup_join(facts, keys, [("city", "geo_city")])
