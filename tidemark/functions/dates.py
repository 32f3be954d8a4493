"""Calendar, time-zone and date-range expressions.

All timestamps are ``timestamp_ntz`` holding UTC unless a name says otherwise.
An instant-typed TIMESTAMP would shift the other way in the zone helpers.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.keys import as_col

# Default zones, trading hours and calendar limits.
HOME_ZONE = "Australia/Melbourne"
MARKET_ZONE = "Australia/Sydney"
MARKET_OPEN = dt.time(10, 0)
MARKET_CLOSE = dt.time(16, 0)
CALENDAR_START = dt.date(2000, 1, 1)
CALENDAR_END = dt.date(2029, 12, 31)


def to_zone(ts: Column | str, zone: str = HOME_ZONE) -> Column:
    """Wall-clock time in ``zone`` for a UTC ``timestamp_ntz``."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), as_col(ts))


def zone_date(ts: Column | str, zone: str = HOME_ZONE) -> Column:
    return to_zone(ts, zone).cast("date")


def noon_utc_iso(day: Column | str, zone: str = MARKET_ZONE) -> Column:
    """Local noon of a day as a UTC text such as ``2024-01-01T01:00:00Z``."""
    noon = as_col(day).cast("date").cast("timestamp_ntz") + F.expr("interval 12 hours")
    utc = F.convert_timezone(F.lit(zone), F.lit("UTC"), noon)
    return F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def iso_utc(ts: Column | str) -> Column:
    """ISO text of a naive timestamp taken as UTC, whole seconds."""
    return F.date_format(as_col(ts), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")


def second_of_day(ts: Column) -> Column:
    """Seconds since midnight with microseconds, as a decimal."""
    return F.hour(ts) * 3600 + F.minute(ts) * 60 + F.date_part(F.lit("SECOND"), ts)


def market_hours(ts: Column | str, zone: str = MARKET_ZONE) -> Column:
    """True Monday to Friday between opening and closing time, both inclusive."""
    local = to_zone(ts, zone)
    opening = MARKET_OPEN.hour * 3600 + MARKET_OPEN.minute * 60
    closing = MARKET_CLOSE.hour * 3600 + MARKET_CLOSE.minute * 60
    return (F.weekday(local) < 5) & second_of_day(local).between(opening, closing)


def parse_long_date(text: Column | str) -> Column:
    """``December 2, 2013`` as a timestamp at midnight."""
    return F.to_timestamp_ntz(as_col(text), F.lit("MMMM d, yyyy"))


def day_of_week(day: Column | str) -> Column:
    """0 for Sunday to 6 for Saturday."""
    return (F.dayofweek(as_col(day)) - 1).cast("bigint")


def calendar_columns(day: Column | str) -> list[Column]:
    """The attributes of the date dimension for one date column."""
    d = as_col(day)
    return [
        F.year(d).cast("bigint").alias("year_col"),
        F.month(d).cast("bigint").alias("month_col"),
        F.dayofmonth(d).cast("bigint").alias("day_col"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "EEEE").alias("weekday_name"),
        day_of_week(d).alias("day_of_week"),
        F.coalesce(day_of_week(d).isin(0, 6), F.lit(False)).alias("is_weekend"),
        F.dayofyear(d).cast("bigint").alias("day_of_year"),
        F.weekofyear(d).cast("bigint").alias("week_of_year"),
        F.quarter(d).cast("bigint").alias("quarter_col"),
    ]


def explode_days(df: DataFrame, start: Column | str, end: Column | str, name: str = "date_col") -> DataFrame:
    """One row per input row and calendar day of its inclusive range.

    A generator inside the row's own task: no join, no recursion. Ranges that
    end before they start yield no rows.
    """
    first, last = as_col(start).cast("date"), as_col(end).cast("date")
    days = F.when(first <= last, F.sequence(first, last, F.expr("interval 1 day")))
    return df.withColumn(name, F.explode(days))


def explode_year_chunks(df: DataFrame, start: Column | str, end: Column | str) -> DataFrame:
    """Split each row's inclusive date range at calendar years.

    Adds ``chunk_start`` and ``chunk_end``; an empty range yields no rows.
    """
    first, last = as_col(start).cast("date"), as_col(end).cast("date")
    years = F.when(first <= last, F.sequence(F.year(first), F.year(last)))
    return (
        df.withColumn("_year", F.explode(years))
        .withColumn("chunk_start", F.greatest(first, F.make_date("_year", F.lit(1), F.lit(1))))
        .withColumn("chunk_end", F.least(last, F.make_date("_year", F.lit(12), F.lit(31))))
        .drop("_year")
    )


def day_span(first: Column | str, last: Column | str) -> Column:
    """Number of days in an inclusive range."""
    return F.datediff(as_col(last), as_col(first)) + 1
