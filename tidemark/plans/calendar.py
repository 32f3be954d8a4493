"""The date dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.dates import CALENDAR_END, CALENDAR_START, calendar_columns, explode_days


def dim_date(spark: SparkSession) -> DataFrame:
    days = explode_days(spark.range(1), F.lit(CALENDAR_START), F.lit(CALENDAR_END))
    return days.select("date_col", *calendar_columns("date_col"))
