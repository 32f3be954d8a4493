"""Domain models on small fixtures with the edge cases that matter to them."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark import catalog
from tidemark.operators import quality
from tidemark.plans import beverages, characters, checks, geo, library, uv, wanted, weather
from tidemark.sources.layouts import CONTRACTS, layout, source_layout
from tidemark.sources.readers import Tables

D = dt.date


def table(spark, source, name, *records):
    schema = source_layout(source, name)
    return spark.createDataFrame([[r.get(f.name) for f in schema.fields] for r in records], schema)


def child(spark, name, *owners):
    """One row per owner given, with positions counted per owner."""
    seen, records = {}, []
    for owner in owners:
        seen[owner] = seen.get(owner, -1) + 1
        records.append({"value": f"v{seen[owner]}", "_dlt_list_idx": seen[owner], "_dlt_id": f"{name}-{owner}-{seen[owner]}", "_dlt_root_id": owner})
    return table(spark, "fbi", name, *records)


def test_star_of_two_aliases_and_three_images(spark, rows):
    people = table(spark, "fbi", "wanted", {"uid": "p1", "_dlt_id": "r1"}, {"uid": "p2", "_dlt_id": "r2"})
    owners = {"wanted__aliases": ["r1", "r1", "gone"], "wanted__images": ["r1", "r1", "r1"]}
    children = {m: wanted.base_child(m, child(spark, t, *owners.get(t, [])), people) for m, (t, *_) in wanted.CHILDREN.items()}
    assert children["base_fbi_aliases"].count() == 2  # the row without a root is dropped
    fact = wanted.staging_fbi_wanted_fact(wanted.base_fbi_wanted(people), children)
    assert fact.columns == ["wanted_id", *[c[3] for c in wanted.CHILDREN.values()]]
    assert fact.where("wanted_id = 'p1'").count() == 6
    assert rows(fact.where("wanted_id = 'p2'"))[0] == ("p2", *[None] * 10)
    assert fact.where("wanted_id = 'p1' and wanted_subject_sk is null").count() == 6


@pytest.mark.parametrize(
    "model, column, value",
    [("base_fbi_files", "language_name", "cast(month(o_orderdate) as string)"), ("base_fbi_occupations", "occupations", "o_orderstatus")],
)
def test_a_list_read_alone_has_every_value_of_a_persons_orders(spark, rows, model, column, value):
    t = Tables(spark, "/root/testdata/sf0.001")
    got = catalog.load()[f"model_{model}"].build(t)
    want = t("orders").join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).selectExpr("'W' || c_custkey", value).distinct()
    assert rows(got, "wanted_id", column) == rows(want)


def test_person_without_alcohol_type_gets_a_key(spark):
    drinks = table(spark, "beverages", "beverages_table", {"id_drink": "1", "str_drink": "A", "source_beverage_type": "Shot"})
    base = beverages.base_beverages(drinks, table(spark, "beverages", "alcoholic_table"))
    row = base.first()
    assert row.alcoholic_type is None and len(row.beverage_category_sk) == 32


def test_consumption_sees_only_the_open_glass(spark, rows):
    before = table(spark, "beverages", "glass_table", {"id_drink": "1", "source_glass": "Mug"})
    after = table(spark, "beverages", "glass_table", {"id_drink": "1", "source_glass": "Cup"})
    history = beverages.glass_type_snapshot(beverages.glass_type_snapshot(None, before, dt.datetime(2024, 1, 1)), after, dt.datetime(2024, 2, 1))
    drinks = table(spark, "beverages", "beverages_table", {"id_drink": "1", "str_drink": "A", "source_beverage_type": "Shot"})
    lookup = beverages.staging_beverage_lookup(beverages.base_beverages(drinks, table(spark, "beverages", "alcoholic_table")))
    drunk = table(spark, "beverages", "consumption", {"id_drink": "1", "date_modified": dt.datetime(2024, 1, 1, 13)}, {"id_drink": "2"})
    staging = beverages.staging_beverage_consumption(beverages.base_beverage_consumption(drunk), history, lookup)
    fact = beverages.fact_beverage_consumption(staging)
    cup = beverages.glass_records(after).first().glass_type_sk
    assert rows(fact, "beverage_id", "glass_type_sk", "beverage_type", "date_melbourne") == [("1", cup, "Shot", D(2024, 1, 2)), ("2", None, None, None)]
    assert beverages.dim_beverage_glass_type(history).count() == 2


def series(spark, city, values, skip=()):
    days = [D(2024, 1, 1) + dt.timedelta(days=i) for i in range(len(values) + len(skip)) if i not in skip]
    return table(
        spark, "weather", "daily_weather",
        *[{"date": d, "city": city, "temperature_max": 20.0, "temperature_min": 12.5, "temperature_mean": v, "precipitation_sum": v} for d, v in zip(days, values)],
    )


def test_weather_windows_count_rows_not_days(spark):
    values = [float(i) if i != 3 else None for i in range(20)]
    rows = weather.staging_weather(weather.base_weather(series(spark, "Perth", values, skip=(5,)))).orderBy("weather_date").collect()
    assert rows[0].mean_temp_moving_avg is None and rows[0].mean_temp_fortnightly_avg == 0.0
    assert rows[2].mean_temp_fortnightly_avg == 1.0
    assert rows[3].mean_temp_fortnightly_avg == 1.0 and rows[3].mean_temp_fortnightly_anomaly is None
    last = [v for v in values[6:20] if v is not None]
    assert rows[19].mean_temp_fortnightly_avg == sum(last) / len(last)
    assert rows[19].temperature_range == 7.5 and rows[19].mean_temp_moving_avg == 1.0


def test_shared_city_name_doubles_the_fact(spark):
    cities = table(
        spark, "geo", "geo_cities",
        {"city_id": 1, "city": "Perth", "country": "Australia"}, {"city_id": 2, "city": "Perth", "country": "United Kingdom"},
        {"city_id": 3, "city": "Paris", "country": "France"},
    )
    staging = geo.staging_geo(geo.base_geo(cities))
    facts = weather.fact_weather(weather.staging_weather(weather.base_weather(series(spark, "Perth", [1.0, 2.0]).union(series(spark, "Paris", [3.0])))), staging)
    assert facts.where("city = 'Perth'").count() == 4
    assert facts.where("city = 'Paris' and city_sk is null").count() == 1
    assert geo.dim_country(staging).count() == 2


def test_weather_payload(spark, rows):
    ddl = "city string, location struct<lat:double,lng:double>, timestamp string, daily struct<time:array<date>, " + ", ".join(
        f"{m}:array<double>" for m in weather.METRICS.values()
    ) + ">"
    day = D(2024, 1, 1)
    payload = spark.createDataFrame([("Perth", (1.0, 2.0), "t", ([day, day + dt.timedelta(days=1)], *[[1.0, None]] * 8))], ddl)
    got = weather.daily_records(payload)
    assert rows(got, "date", "city", "temperature_max", "location__lat", "location__lng") == [(day, "Perth", 1.0, 1.0, 2.0), (D(2024, 1, 2), "Perth", None, 1.0, 2.0)]
    assert set(got.columns) == {"date", "city", "timestamp", "location__lat", "location__lng", *weather.METRICS}
    merged = weather.merge_daily(got, got.withColumn("temperature_max", F.lit(9.0)))
    assert rows(merged, "temperature_max") == [(9.0,), (9.0,)]


def test_uv_feedback_loop(spark):
    known = table(spark, "uv", "uv_index", *[{"uv_time": dt.datetime(2024, 1, 30, 2), "city": c} for c, *_ in uv.CITIES[:5]])
    today = D(2024, 1, 31)
    missing = uv.staging_uv_data_dates(spark, uv.base_uv(known), today)
    assert missing.count() == 50
    assert missing.where("date_col = date '2024-01-30'").count() == 3
    log = spark.createDataFrame([(today,)] * 47 + [(D(2024, 1, 30),)] * 9, "run_day date")
    sent = uv.requests(missing, log, today).collect()
    assert [(r.date_col, r.city) for r in sent] == [(D(2024, 1, 30), c) for c in ("Canberra", "Darwin", "Hobart")]
    assert sent[0].dt == "2024-01-30T01:00:00Z" and sent[0].lat == -35.2809


def test_locations_meet_their_contract(spark):
    location = table(spark, "rick_and_morty", "location", {"id": 1, "name": "Earth", "created": dt.datetime(2024, 1, 1)})
    base = characters.base_rm_locations(location)
    assert quality.schema_contract(base, layout(CONTRACTS["base_rm_locations"])).count() == 0
    wrong = quality.schema_contract(base.drop("location_url").withColumn("location_id", F.lit("x")), layout(CONTRACTS["base_rm_locations"]))
    assert {r.column_name for r in wrong.collect()} == {"location_url", "location_id"}
    staged = characters.staging_rm_locations(base, characters.base_rm_location_residents(table(spark, "rick_and_morty", "location__residents")))
    assert staged.first().num_characters is None and staged.first().location_categories == "Unknown"


def test_books(spark, rows):
    ddl = "search_term string, key string, title string, ebook_access string, first_publish_year bigint, has_fulltext boolean, author_name array<string>, language array<string>"
    docs = spark.createDataFrame([("SQL", "/works/1", "T", None, 1999, None, ["A", "B"], None), ("SQL", "/works/2", "U", None, None, True, None, ["eng"])], ddl)
    books = library.book_records(docs)
    authors, languages = library.child_tables(books)
    assert rows(library.base_openlibrary_authors(authors)) == [("A", "/works/1"), ("B", "/works/1")]
    assert rows(library.base_openlibrary_languages(languages)) == [("eng", "/works/2")]
    assert rows(library.base_openlibrary_books(books), "book_key", "has_fulltext") == [("/works/1", False), ("/works/2", True)]
    plan = library.load_plan(spark.createDataFrame([("SQL", 5)], "search_term string, n bigint"), spark.createDataFrame([], "search_term string, n bigint"), docs)
    assert plan.first().status == "reload"


def test_geo_load_plan(spark):
    cities = table(spark, "geo", "geo_cities", {"city_id": 1, "country_code": "AU"}, {"city_id": 2, "country_code": "NZ"})
    previous = spark.createDataFrame([("AU", 1), ("NZ", 1)], "country_code string, n bigint")
    plan = {r.country_code: r.status for r in geo.load_plan(cities, previous, cities.where("country_code = 'AU'")).collect()}
    assert plan == {"AU": "skip", "NZ": "reload"}


def test_declared_checks(spark):
    assert sum(len(c) for c in checks.DECLARED.values()) == 59
    links = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), (None, 2), (None, 2)], "character_dlt_id string, episode_id int")
    people = spark.createDataFrame([("x",), ("x",), (None,)], "pk string")
    owned = spark.createDataFrame([("x", "s1"), ("y", "s1"), (None, None)], "wanted_id string, wanted_occupations_sk string")
    results = checks.check_models({"base_rm_character_episode": links, "base_fbi_wanted": people, "base_fbi_occupations": owned}, D(2024, 1, 1))
    found = {(r.model, r.check_name): (r.severity, r.failures) for r in results.collect()}
    assert found == {
        ("base_rm_character_episode", "unique_combination:character_dlt_id"): ("error", 2),
        ("base_fbi_wanted", "not_null:pk"): ("error", 1),
        ("base_fbi_wanted", "unique:pk"): ("error", 1),
        ("base_fbi_occupations", "relationships:wanted_id"): ("error", 1),
        ("base_fbi_occupations", "unique_warn:wanted_occupations_sk"): ("warn", 1),
    }


@pytest.mark.parametrize("days, status", [(1, "pass"), (3, "warn"), (6, "error"), (None, "error")])
def test_freshness(spark, days, status):
    now = dt.datetime(2024, 1, 10)
    newest = now - dt.timedelta(days=days) if days else None
    df = spark.createDataFrame([(newest,)], "timestamp timestamp_ntz")
    column, warn, error = checks.FRESHNESS["daily_weather"]
    assert quality.freshness(df, column, now, warn, error).first().status == status
