"""Column expressions against values worked out by hand."""

import datetime as dt
import hashlib
import re

import pytest
from pyspark.sql import functions as F

from tidemark.functions import dates, keys, numbers, text
from tidemark.operators import incremental
from tidemark.plans import calendar, characters


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


def at(value):
    return F.lit(value).cast("timestamp_ntz")


@pytest.mark.parametrize(
    "utc, expected",
    [
        ("2024-06-08 02:00:00", False),  # Saturday noon in Sydney
        ("2024-06-10 01:00:00", True),  # Monday 11:00
        ("2024-06-10 00:00:00", True),  # 10:00:00
        ("2024-06-10 06:00:00", True),  # 16:00:00
        ("2024-06-10 06:00:01", False),
        ("2024-06-10 06:00:00.000001", False),
        ("2024-06-09 23:59:59.999999", False),
        ("2024-01-14 23:00:00", True),  # Monday 10:00 in daylight-saving time
    ],
)
def test_market_hours(spark, utc, expected):
    assert one(spark, dates.market_hours(at(utc))) is expected


def test_zone_shift_and_noon(spark):
    assert one(spark, dates.to_zone(at("2024-01-01 13:30:00"))) == dt.datetime(2024, 1, 2, 0, 30)
    assert one(spark, dates.zone_date(at("2024-07-01 13:59:59"))) == dt.date(2024, 7, 1)
    assert one(spark, dates.noon_utc_iso(F.lit("2024-01-05").cast("date"))) == "2024-01-05T01:00:00Z"
    assert one(spark, dates.noon_utc_iso(F.lit("2024-07-05").cast("date"))) == "2024-07-05T02:00:00Z"
    assert one(spark, dates.iso_utc(at("2024-01-05 01:02:03.5"))) == "2024-01-05T01:02:03+00:00"


@pytest.mark.parametrize("written", ["December 2, 2013", "December 02, 2013"])
def test_parse_long_date(spark, written):
    assert one(spark, dates.parse_long_date(F.lit(written))) == dt.datetime(2013, 12, 2)


def test_year_chunks(spark, rows):
    d = dt.date
    ranges = [("a", d(2021, 1, 1), d(2023, 3, 5)), ("b", d(2022, 12, 31), d(2022, 12, 31)), ("c", d(2022, 2, 1), d(2022, 1, 1))]
    df = spark.createDataFrame(ranges, "k string, s date, e date")
    got = rows(dates.explode_year_chunks(df, "s", "e"), "k", "chunk_start", "chunk_end")
    assert got == [
        ("a", d(2021, 1, 1), d(2021, 12, 31)),
        ("a", d(2022, 1, 1), d(2022, 12, 31)),
        ("a", d(2023, 1, 1), d(2023, 3, 5)),
        ("b", d(2022, 12, 31), d(2022, 12, 31)),
    ]


def test_date_dimension(spark):
    dim = calendar.dim_date(spark)
    assert dim.count() == 10_958
    row = dim.where("date_col = date '2023-01-01'").first()
    assert (row.weekday_name, row.day_of_week, row.is_weekend, row.week_of_year) == ("Sunday", 0, True, 52)
    assert dict(dim.dtypes)["year_col"] == "bigint"


def test_surrogate_key(spark):
    def md5(s):
        return hashlib.md5(s.encode()).hexdigest()

    assert one(spark, keys.surrogate_key(F.lit("a"), F.lit(None).cast("string"))) == md5("a-_dbt_utils_surrogate_key_null_")
    assert one(spark, keys.surrogate_key(F.lit(5))) == md5("5")


def test_composite_key(spark):
    assert one(spark, keys.composite_key(F.lit("u1"), F.lit("NA"), F.lit(None).cast("string"))) == "u1|na|"


@pytest.mark.parametrize("name", ["Rum & Coke", "Café au lait", " a\tb\x1cc ", "x-1_2.json", "日本", "a/b:c*d"])
def test_sanitize_name(spark, name):
    joined = "".join(name.split()).encode("ascii", errors="ignore").decode()
    assert one(spark, keys.sanitize_name(F.lit(name))) == re.sub(r"[^A-Za-z0-9_.\-]", "_", joined)


@pytest.mark.parametrize(
    "url, number",
    [("https://x/api/episode/28", 28), ("https://x/api/episode/", None), ("none", None), ("17", 17), ("a/b/7c", None), (None, None), ("x/99999999999", None)],
)
def test_numeric_tail(spark, url, number):
    assert one(spark, text.numeric_tail(F.lit(url).cast("string"))) == number


@pytest.mark.parametrize("value, rounded", [(1.005, 1.0), (2.675, 2.68), (-2.5, -2.5), (0.125, 0.13), (-0.125, -0.13), (1e17, 1e17), (None, None)])
def test_round_ieee(spark, value, rounded):
    assert one(spark, numbers.round_ieee(F.lit(value).cast("double"))) == rounded


def test_distance_and_pages(spark):
    assert one(spark, numbers.distance([(F.lit(3.0), F.lit(0.0)), (F.lit(4.0), F.lit(0.0))])) == 5.0
    assert [one(spark, numbers.pages_needed(F.lit(n), 50)) for n in (0, 1, 50, 51)] == [0, 1, 1, 2]


@pytest.mark.parametrize("name, group", [("rick sanchez", "Rick"), ("Ricky", "Other"), ("Morty Smith", "Morty"), ("Evil Rick", "Other"), (None, "Other")])
def test_character_groups(spark, name, group):
    assert one(spark, text.classify_regex(F.lit(name).cast("string"), characters.CHARACTER_GROUPS)) == group


@pytest.mark.parametrize(
    "name, group",
    [
        ("Pickle Rick", "Rick-Focused"),
        ("Mortynight Run", "Morty-Focused"),
        ("Rick & Mortal", "Morty-Focused"),
        ("Rixty Minutes", "Interdimensional Cable"),
        ("Total Rickall", "Other"),
        ("Anatomy Park", "Pop Culture Reference"),
        (None, "Other"),
    ],
)
def test_episode_groups(spark, name, group):
    assert one(spark, text.classify_like(F.lit(name).cast("string"), characters.EPISODE_FIRST)) == group


@pytest.mark.parametrize(
    "kind, category", [("PLANET", "Celestial Body"), ("Spa", "Location Type"), ("Quadrant", "Quadrant/Zone"), ("Moon", "Unknown"), (None, "Unknown")]
)
def test_location_types(spark, kind, category):
    assert one(spark, text.classify_members(F.lit(kind).cast("string"), characters.LOCATION_TYPES)) == category


@pytest.mark.parametrize(
    "name, group",
    [
        ("unknown", "Unclassified"),
        ("Dimension C-137", "Standard Format"),
        ("Fascist Shrimp Dimension", "Fascist Variant"),
        ("Dimension 5-126", "Other"),
        ("PIZZA Dimension", "Thematic"),
        ("Cronenberg Dimension", "Canonical Named"),
        (None, "Other"),
    ],
)
def test_dimension_groups(spark, name, group):
    df = spark.createDataFrame([(name,)], "d string")
    assert df.select(characters.dimension_group("d")).first()[0] == group


@pytest.mark.parametrize(
    "variant, counts, status",
    [
        ("dropped", (10, 10, 8), "reload"),
        ("dropped", (10, 10, 10), "skip"),
        ("dropped", (12, 10, 11), "load"),
        ("dropped", (0, 0, 0), "skip"),
        ("dropped_or_empty", (0, 0, 0), "reload"),
        ("dropped_or_empty", (10, 10, 10), "skip"),
        ("growth", (12, 10, 10), "reload"),
        ("growth", (10, 10, 0), "load"),
        ("growth", (10, 10, 3), "skip"),
        ("both_equal", (10, 10, 10), "skip"),
        ("both_equal", (10, 10, 9), "load"),
        ("both_equal", (0, 10, 10), "failed"),
    ],
)
def test_change_status(spark, variant, counts, status):
    assert one(spark, incremental.change_status(*[F.lit(n) for n in counts], variant)) == status
