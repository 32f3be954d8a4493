"""Cities and countries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.keys import surrogate_key
from tidemark.functions.text import first_filled
from tidemark.operators.aggregates import dimension, group_size
from tidemark.operators.incremental import change_plan

# Countries kept.
COUNTRIES = ["New Zealand", "United Kingdom", "Australia", "Canada"]


def city_records(cities: DataFrame, details: DataFrame) -> DataFrame:
    """City records with the country taken from the details, else from the city itself.

    ``cities``: geoname_id, name, lat, lng, country_name, country_code; ``details``:
    geoname_id, country_name, admin_name, admin_code, continent_code.
    """
    d = details.select(
        "geoname_id",
        F.col("country_name").alias("detail_country"),
        F.col("admin_name").alias("region"),
        F.col("admin_code").alias("region_code"),
        F.col("continent_code").alias("continent"),
    )
    return cities.join(d, "geoname_id", "left").select(
        F.col("geoname_id").alias("city_id"),
        F.col("name").alias("city"),
        F.col("lat").cast("double").alias("latitude"),
        F.col("lng").cast("double").alias("longitude"),
        first_filled("detail_country", "country_name").alias("country"),
        "country_code",
        "region",
        "region_code",
        "continent",
    )


def load_plan(cities: DataFrame, previous: DataFrame, stored: DataFrame) -> DataFrame:
    """Which countries to load, from counts of the extract, the last run and the table."""
    counted = group_size(cities, "country_code", "n")
    return change_plan(counted, previous, group_size(stored, "country_code", "n"), "country_code", "dropped_or_empty")


def base_geo(geo_cities: DataFrame) -> DataFrame:
    columns = ["city_id", "city", "latitude", "longitude", "country_code", "country", "region", "continent"]
    return geo_cities.where(F.col("country").isin(*COUNTRIES)).select(*columns)


def staging_geo(base: DataFrame) -> DataFrame:
    return base.select(
        "city_id",
        "city",
        "latitude",
        "longitude",
        "country_code",
        "country",
        "region",
        surrogate_key("city", "country").alias("city_sk"),
        surrogate_key("country").alias("country_sk"),
    )


def dim_city(staging: DataFrame) -> DataFrame:
    return dimension(staging, "city", "latitude", "longitude", "region", "city_sk", "country_sk")


def dim_country(staging: DataFrame) -> DataFrame:
    return dimension(staging, "country_code", "country", "country_sk")
