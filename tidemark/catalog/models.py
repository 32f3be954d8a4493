"""The domain models end to end, over source tables derived from the measured ones."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from tidemark.catalog import query
from tidemark.catalog.domain_tables import CHILD_RULES, DOMAIN_TABLES, FULL_LISTS, with_tables
from tidemark.catalog.expressions import CALENDAR_SQL
from tidemark.operators.joins import aggregate_lookup
from tidemark.plans import beverages, calendar, characters, checks, finance, geo, library, satellite, universities, uv, wanted, weather

NULL_KEY = "'_dbt_utils_surrogate_key_null_'"
KEPT_COUNTRIES = "('New Zealand', 'United Kingdom', 'Australia', 'Canada')"
BEFORE, AFTER = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1)
TODAY = dt.date(2024, 1, 31)


def key(*columns: str) -> str:
    return "md5(" + " || '-' || ".join(f"COALESCE({c}, {NULL_KEY})" for c in columns) + ")"


def source(t, name: str):
    return t.sql(DOMAIN_TABLES[name])


# Calendar ---------------------------------------------------------------------------------


@query(
    "model_dim_date",
    f"""
    SELECT d AS date_col, {CALENDAR_SQL}, n_orders FROM (
        SELECT CAST(day AS DATE) AS d FROM generate_series(DATE '2000-01-01', DATE '2029-12-31', INTERVAL 1 DAY) s(day))
    LEFT JOIN (SELECT CAST(o_orderdate AS DATE) AS o, COUNT(*) AS n_orders FROM orders GROUP BY o) ON d = o
    """,
)
def dim_date(t):
    orders = t("orders").select(F.col("o_orderdate").cast("date").alias("day"))
    return aggregate_lookup(calendar.dim_date(t.spark), orders, "date_col", "day", F.count(F.lit(1)).alias("n_orders"))


# Geography and weather --------------------------------------------------------------------

GEO_SQL = f"""
    geo AS (SELECT city_id, city, latitude, longitude, country_code, country, region,
                {key("city", "country")} AS city_sk, {key("country")} AS country_sk
            FROM geo_cities WHERE country IN {KEPT_COUNTRIES})
"""


def staging_geo(t):
    return geo.staging_geo(geo.base_geo(source(t, "geo_cities")))


@query("model_staging_geo", f"{with_tables('geo_cities')}, {GEO_SQL} SELECT * FROM geo")
def model_staging_geo(t):
    return staging_geo(t)


@query(
    "model_dim_city",
    f"{with_tables('geo_cities')}, {GEO_SQL} SELECT DISTINCT city, latitude, longitude, region, city_sk, country_sk FROM geo",
)
def dim_city(t):
    return geo.dim_city(staging_geo(t))


@query("model_dim_country", f"{with_tables('geo_cities')}, {GEO_SQL} SELECT DISTINCT country_code, country, country_sk FROM geo")
def dim_country(t):
    return geo.dim_country(staging_geo(t))


WEATHER_SQL = """
    SELECT "date" AS weather_date, city, temperature_max, temperature_min, temperature_mean, precipitation_sum, windspeed_max,
        windgusts_max, sunshine_duration, location__lat AS latitude, location__lng AS longitude,
        temperature_max - temperature_min AS temperature_range,
        precipitation_sum - AVG(precipitation_sum) OVER w AS precipitation_fortnightly_anomaly,
        temperature_mean - AVG(temperature_mean) OVER w AS mean_temp_fortnightly_anomaly,
        AVG(temperature_mean) OVER w AS mean_temp_fortnightly_avg,
        temperature_mean - LAG(temperature_mean) OVER (PARTITION BY city ORDER BY "date") AS mean_temp_moving_avg
    FROM daily_weather WINDOW w AS (PARTITION BY city ORDER BY "date" ROWS BETWEEN 13 PRECEDING AND CURRENT ROW)
"""


@query("model_staging_weather", f"{with_tables('daily_weather')} {WEATHER_SQL}")
def staging_weather(t):
    return weather.staging_weather(weather.base_weather(source(t, "daily_weather")))


@query(
    "model_fact_weather",
    f"""
    {with_tables("daily_weather", "geo_cities")}, {GEO_SQL}, s AS ({WEATHER_SQL})
    SELECT s.* EXCLUDE (latitude, longitude), geo.city_sk FROM s LEFT JOIN geo ON s.city = geo.city
    """,
)
def fact_weather(t):
    return weather.fact_weather(staging_weather(t), staging_geo(t))


@query(
    "model_weather_payload",
    """
    SELECT CAST(ts AS DATE) AS date, 'City ' || user_id AS city, value AS temperature_max, value - 1 AS temperature_min,
        value AS temperature_mean, value AS precipitation_sum, value AS windspeed_max, value AS windgusts_max,
        value AS sunshine_duration, value AS uv_index_max, CAST(user_id AS DOUBLE) AS location__lat,
        CAST(-user_id AS DOUBLE) AS location__lng, ts AS timestamp FROM events
    UNION ALL
    SELECT CAST(ts AS DATE) + 1, 'City ' || user_id, value + 1, value, value + 1, value + 1, value + 1, value + 1,
        value + 1, value + 1, CAST(user_id AS DOUBLE), CAST(-user_id AS DOUBLE), ts FROM events
    """,
)
def weather_payload(t):
    value, day = F.col("value"), F.col("ts").cast("date")
    arrays = [F.array(value, value + 1).alias(name) for name in weather.METRICS.values() if name != "temperature_2m_min"]
    low = F.array(value - 1, value).alias("temperature_2m_min")
    location = F.struct(F.col("user_id").cast("double").alias("lat"), (-F.col("user_id")).cast("double").alias("lng"))
    payload = t("events").select(
        F.concat(F.lit("City "), "user_id").alias("city"),
        location.alias("location"),
        F.col("ts").alias("timestamp"),
        F.struct(F.array(day, F.date_add(day, 1)).alias("time"), low, *arrays).alias("daily"),
    )
    return weather.daily_records(payload)


@query(
    "model_weather_requests",
    f"""
    {with_tables("daily_weather")}, c AS (
        SELECT 'City ' || c_custkey AS city, MIN(d."date") AS lo, MAX(d."date") AS hi FROM customer
        LEFT JOIN daily_weather d ON d.city = 'City ' || c_custkey GROUP BY c_custkey),
    r AS (SELECT city, COALESCE(greatest(hi + 1, DATE '2021-01-01'), DATE '2021-01-01') AS lo FROM c)
    SELECT city, greatest(lo, make_date(y, 1, 1)) AS chunk_start, least(DATE '2024-01-29', make_date(y, 12, 31)) AS chunk_end
    FROM r, LATERAL (SELECT unnest(range(EXTRACT(YEAR FROM lo), 2025)) AS y) WHERE lo <= DATE '2024-01-29'
    """,
)
def weather_requests(t):
    cities = t("customer").select(F.concat(F.lit("City "), "c_custkey").alias("city"))
    return weather.request_chunks(cities, source(t, "daily_weather").select("city", "date"), TODAY)


# UV index ---------------------------------------------------------------------------------

UV_MISSING_SQL = """
    missing AS (
        SELECT d.date_col, c.city FROM (
            SELECT CAST(day AS DATE) AS date_col FROM generate_series(DATE '2000-01-01', DATE '2024-01-30', INTERVAL 1 DAY) s(day)) d
        CROSS JOIN (VALUES ('Sydney', -33.8688, 151.2093), ('Melbourne', -37.8136, 144.9631), ('Brisbane', -27.4698, 153.0251),
            ('Perth', -31.9505, 115.8605), ('Adelaide', -34.9285, 138.6007), ('Canberra', -35.2809, 149.1300),
            ('Hobart', -42.8821, 147.3272), ('Darwin', -12.4634, 130.8456)) c(city, lat, lng)
        WHERE NOT EXISTS (SELECT 1 FROM uv_index u WHERE u.city = c.city AND CAST(u.uv_time AS DATE) = d.date_col)
        ORDER BY d.date_col DESC, c.city ASC LIMIT 50)
"""


@query("model_staging_uv_data_dates", f"{with_tables('uv_index')}, {UV_MISSING_SQL} SELECT * FROM missing")
def staging_uv_data_dates(t):
    return uv.staging_uv_data_dates(t.spark, uv.base_uv(source(t, "uv_index")), TODAY)


@query(
    "model_uv_requests",
    f"""
    {with_tables("uv_index")}, {UV_MISSING_SQL}
    SELECT date_col, city, DATE '2024-01-31' AS run_day, strftime((CAST(date_col AS TIMESTAMP) + INTERVAL 12 HOUR)
        AT TIME ZONE 'Australia/Sydney' AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%SZ') AS dt
    FROM missing ORDER BY date_col DESC, city ASC LIMIT (SELECT 50 - COUNT(DISTINCT event_type) * 4 FROM events)
    """,
)
def uv_requests(t):
    kinds = t("events").select("event_type").distinct()
    log = kinds.select(F.explode(F.array_repeat(F.lit(TODAY), 4)).alias("run_day"))
    return uv.requests(staging_uv_data_dates(t), log, TODAY).select("date_col", "city", "run_day", "dt")


# Share prices -----------------------------------------------------------------------------


@query(
    "model_base_gsheets_finance",
    f"""
    {with_tables("gsheets_finance")}
    SELECT id, stock, CAST(price AS DECIMAL(18,3)) AS price,
        (date_time AT TIME ZONE 'UTC' AT TIME ZONE 'Australia/Melbourne')::TIMESTAMP AS date_time,
        ROUND(MAX(price) OVER p - MIN(price) OVER p, 2) AS price_spread,
        ROUND(arg_max(price, id) OVER (PARTITION BY stock, date_time) - first_value(price) OVER o, 2) AS relative_price_movement,
        ROUND(last_value(price) OVER o - first_value(price) OVER o, 2) AS abs_price_movement, COUNT(id) OVER p AS num_stock_entries
    FROM gsheets_finance WINDOW p AS (PARTITION BY stock),
        o AS (PARTITION BY stock ORDER BY date_time, id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
    """,
)
def base_gsheets_finance(t):
    return finance.base_gsheets_finance(source(t, "gsheets_finance"))


# Beverages --------------------------------------------------------------------------------

LOOKUP_SQL = f"""
    lookup AS (SELECT b.str_drink AS beverage_name, b.id_drink AS beverage_id, b.source_beverage_type AS beverage_type,
                   {key("b.source_beverage_type")} AS beverage_type_sk,
                   {key("b.source_beverage_type", "a.source_alcohol_type")} AS beverage_category_sk,
                   a.source_alcohol_type AS alcoholic_type, {key("a.source_alcohol_type")} AS alcoholic_type_sk
               FROM beverages_table b LEFT JOIN alcoholic_table a ON b.id_drink = a.id_drink)
"""
GLASS_SQL = f"""
    glasses AS (
        SELECT b.id_drink AS beverage_id, b.source_glass AS glass_type, {key("b.source_glass")} AS glass_type_sk,
            TIMESTAMP '2024-01-01' AS dbt_valid_from,
            CASE WHEN g.id_drink IS NULL OR g.source_glass <> b.source_glass THEN TIMESTAMP '2024-02-01' END AS dbt_valid_to
        FROM glass_table_before b LEFT JOIN glass_table g ON b.id_drink = g.id_drink
        UNION ALL
        SELECT g.id_drink, g.source_glass, {key("g.source_glass")}, TIMESTAMP '2024-02-01', NULL
        FROM glass_table g LEFT JOIN glass_table_before b ON b.id_drink = g.id_drink
        WHERE b.id_drink IS NULL OR g.source_glass <> b.source_glass)
"""
BEVERAGE_TABLES = with_tables("beverages_table", "alcoholic_table")
GLASS_TABLES = with_tables("glass_table_before", "glass_table")


def beverage_lookup(t):
    base = beverages.base_beverages(source(t, "beverages_table"), source(t, "alcoholic_table"))
    return beverages.staging_beverage_lookup(base)


def glass_history(t):
    before = beverages.glass_type_snapshot(None, source(t, "glass_table_before"), BEFORE)
    return beverages.glass_type_snapshot(before, source(t, "glass_table"), AFTER)


@query(
    "model_base_beverages",
    f"""
    {BEVERAGE_TABLES}, {LOOKUP_SQL}
    SELECT beverage_name, beverage_id, beverage_type, beverage_category_sk, alcoholic_type FROM lookup
    """,
)
def base_beverages(t):
    return beverages.base_beverages(source(t, "beverages_table"), source(t, "alcoholic_table"))


@query("model_staging_beverage_lookup", f"{BEVERAGE_TABLES}, {LOOKUP_SQL} SELECT * FROM lookup")
def staging_beverage_lookup(t):
    return beverage_lookup(t)


@query("model_dim_alcoholic_type", f"{BEVERAGE_TABLES}, {LOOKUP_SQL} SELECT DISTINCT alcoholic_type, alcoholic_type_sk FROM lookup")
def dim_alcoholic_type(t):
    return beverages.dim_alcoholic_type(beverage_lookup(t))


@query(
    "model_dim_beverage_type",
    f"""
    {BEVERAGE_TABLES}, {LOOKUP_SQL}
    SELECT DISTINCT beverage_type, alcoholic_type, beverage_category_sk, alcoholic_type_sk FROM lookup
    """,
)
def dim_beverage_type(t):
    return beverages.dim_beverage_type(beverage_lookup(t))


@query(
    "model_glass_type_snapshot",
    f"""
    {GLASS_TABLES}, {GLASS_SQL}
    SELECT *, dbt_valid_from AS dbt_updated_at, md5(beverage_id || '|' || CAST(dbt_valid_from AS VARCHAR)) AS dbt_scd_id FROM glasses
    """,
)
def glass_type_snapshot(t):
    return glass_history(t)


@query("model_dim_beverage_glass_type", f"{GLASS_TABLES}, {GLASS_SQL} SELECT DISTINCT glass_type, glass_type_sk FROM glasses")
def dim_beverage_glass_type(t):
    return beverages.dim_beverage_glass_type(glass_history(t))


@query(
    "model_dim_beverage_ingredient_jointable",
    f"{with_tables('ingredients_table')} SELECT DISTINCT id_drink AS beverage_id FROM ingredients_table WHERE id_drink IS NOT NULL",
)
def dim_beverage_ingredient_jointable(t):
    return beverages.dim_beverage_ingredient_jointable(source(t, "ingredients_table"))


def _hierarchy_sql() -> str:
    joins = []
    for level in range(2, 8):
        earlier = ", ".join(f"i{k}.source_ingredient" for k in range(1, level))
        joins.append(
            f"LEFT JOIN ingredients_table i{level} ON i1.id_drink = i{level}.id_drink "
            f"AND i{level}.source_ingredient NOT IN ({earlier})"
        )
    levels = ", ".join(f"i{k}.source_ingredient AS ingredient{k}" for k in range(2, 8))
    return (
        f"SELECT i1.source_ingredient AS ingredient, i1.id_drink AS beverage_id, i1.str_drink AS beverage_name, {levels} "
        f"FROM ingredients_table i1 {' '.join(joins)}"
    )


@query("model_dim_beverage_ingredient_hierarchy", f"{with_tables('ingredients_table')} {_hierarchy_sql()}")
def dim_beverage_ingredient_hierarchy(t):
    lookup = beverages.base_beverage_ingredients_lookup(source(t, "ingredients_table"))
    return beverages.dim_beverage_ingredient_hierarchy(lookup)


@query(
    "model_fact_beverage_consumption",
    f"""
    {with_tables("beverages_table", "alcoholic_table", "glass_table_before", "glass_table", "consumption")}, {LOOKUP_SQL}, {GLASS_SQL}
    SELECT c.id_drink AS beverage_id, c.str_drink AS beverage_name, g.glass_type_sk, l.beverage_category_sk, l.beverage_type_sk,
        l.alcoholic_type_sk, l.beverage_type, l.alcoholic_type, c.str_instructions AS beverage_instructions,
        c.str_drink_thumb AS beverage_url, c.str_glass AS glass_type,
        (c.date_modified AT TIME ZONE 'UTC' AT TIME ZONE 'Australia/Melbourne')::DATE AS date_melbourne,
        {", ".join(f"c.str_ingredient{i}" for i in range(1, 9))}
    FROM consumption c LEFT JOIN (SELECT * FROM glasses WHERE dbt_valid_to IS NULL) g ON c.id_drink = g.beverage_id
    LEFT JOIN lookup l ON c.id_drink = l.beverage_id
    """,
)
def fact_beverage_consumption(t):
    base = beverages.base_beverage_consumption(source(t, "consumption"))
    staging = beverages.staging_beverage_consumption(base, glass_history(t), beverage_lookup(t))
    return beverages.fact_beverage_consumption(staging)


# Wanted persons ---------------------------------------------------------------------------


def children(t):
    people = source(t, "wanted")
    return {m: wanted.base_child(m, source(t, wanted.CHILDREN[m][0]), people) for m in wanted.CHILDREN}


@query(
    "model_base_fbi_wanted",
    f"{with_tables('wanted')} SELECT * EXCLUDE (_dlt_id, url, uid, weight), url AS urllink, uid AS pk, weight AS bodyweight FROM wanted",
)
def base_fbi_wanted(t):
    return wanted.base_fbi_wanted(source(t, "wanted"))


@query(
    "model_staging_fbi_wanted_lookup",
    f"""
    {with_tables("wanted")} SELECT * EXCLUDE (_dlt_id, url, uid, weight, status, poster_classification), url AS urllink, uid AS pk,
        weight AS bodyweight FROM wanted
    """,
)
def staging_fbi_wanted_lookup(t):
    return wanted.staging_fbi_wanted_lookup(base_fbi_wanted(t))


def _list_alone(model: str) -> str:
    table = wanted.CHILDREN[model][0]
    return f"{table}__full" if table in FULL_LISTS else table


def _child_sql(model: str) -> str:
    _, values, order, row_key = wanted.CHILDREN[model]
    table = _list_alone(model)
    fields = ", ".join(f"c.{a} AS {b}" for a, b in values.items())
    return (
        f"{with_tables('wanted', table)} SELECT {fields}, w.uid AS wanted_id, c._dlt_list_idx AS {order}, c._dlt_id AS {row_key} "
        f"FROM {table} c JOIN wanted w ON c._dlt_root_id = w._dlt_id"
    )


def _register_child(model: str) -> None:
    @query(f"model_{model}", _child_sql(model))
    def base_child(t):
        return wanted.base_child(model, source(t, _list_alone(model)), source(t, "wanted"))


for _model in wanted.CHILDREN:
    _register_child(_model)


def _star_sql() -> str:
    joins, fields = [], []
    for i, (table, _, _, row_key) in enumerate(wanted.CHILDREN.values()):
        joins.append(f"LEFT JOIN {table} c{i} ON w._dlt_id = c{i}._dlt_root_id")
        fields.append(f"c{i}._dlt_id AS {row_key}")
    return f"{with_tables('wanted', *CHILD_RULES)} SELECT w.uid AS wanted_id, {', '.join(fields)} FROM wanted w {' '.join(joins)}"


@query("model_staging_fbi_wanted_fact", _star_sql())
def staging_fbi_wanted_fact(t):
    return wanted.staging_fbi_wanted_fact(base_fbi_wanted(t), children(t))


def _person_history_sql(column: str, alias: str, later: str) -> str:
    return f"""
    {with_tables("wanted")}, v2 AS (SELECT uid AS pk, {later} AS v FROM wanted WHERE sex = 'Male' OR reward_min > 5000),
    v1 AS (SELECT uid AS pk, {column} AS v FROM wanted)
    SELECT v1.pk, v1.v AS {alias}, TIMESTAMP '2024-01-01' AS dbt_valid_from, TIMESTAMP '2024-01-01' AS dbt_updated_at,
        CASE WHEN v2.pk IS NULL OR v2.v IS DISTINCT FROM v1.v THEN TIMESTAMP '2024-02-01' END AS dbt_valid_to,
        md5(v1.pk || '|2024-01-01 00:00:00') AS dbt_scd_id FROM v1 LEFT JOIN v2 ON v1.pk = v2.pk
    UNION ALL SELECT v2.pk, v2.v, TIMESTAMP '2024-02-01', TIMESTAMP '2024-02-01', NULL, md5(v2.pk || '|2024-02-01 00:00:00')
    FROM v2 LEFT JOIN v1 ON v1.pk = v2.pk WHERE v2.v IS DISTINCT FROM v1.v
    """


def _people_later(t):
    base = base_fbi_wanted(t)
    caught = F.when(F.col("bodyweight") == "3", F.lit("captured")).otherwise(F.col("status"))
    role = F.when(F.col("bodyweight") == "3", F.lit(None)).otherwise(F.col("person_classification"))
    kept = base.where((F.col("sex") == "Male") | (F.col("reward_min") > 5000))
    return kept.withColumn("status", caught).withColumn("person_classification", role)


@query(
    "model_fbi_status_snapshot",
    _person_history_sql("status", "fbi_status", "CASE WHEN weight = '3' THEN 'captured' ELSE status END"),
)
def fbi_status_snapshot(t):
    first = wanted.fbi_status_snapshot(None, base_fbi_wanted(t), BEFORE)
    return wanted.fbi_status_snapshot(first, _people_later(t), AFTER)


@query(
    "model_fbi_classification_snapshot",
    _person_history_sql(
        "person_classification", "person_classification", "CASE WHEN weight = '3' THEN NULL ELSE person_classification END"
    ),
)
def fbi_classification_snapshot(t):
    first = wanted.fbi_classification_snapshot(None, base_fbi_wanted(t), BEFORE)
    return wanted.fbi_classification_snapshot(first, _people_later(t), AFTER)


# Characters, episodes, locations ----------------------------------------------------------

LOCAL = "(created AT TIME ZONE 'UTC' AT TIME ZONE 'Australia/Melbourne')::TIMESTAMP"
TAIL = r"TRY_CAST(regexp_replace(value, '.*/(\d+)$', '\1') AS INTEGER)"


@query(
    "model_base_rm_characters",
    f"""
    {with_tables("character")} SELECT id AS character_id, name AS character_name, status AS character_status,
        species AS character_species, gender AS character_gender, origin__name AS character_origin,
        location__name AS character_first_location, location__url AS character_first_location_url, image AS character_image,
        url AS character_url, _dlt_id AS character_dlt_id, {LOCAL} AS character_created FROM "character"
    """,
)
def base_rm_characters(t):
    return characters.base_rm_characters(source(t, "character"))


@query(
    "model_base_rm_character_episode",
    f"{with_tables('character__episode')} SELECT _dlt_root_id AS character_dlt_id, {TAIL} AS episode_id FROM character__episode",
)
def base_rm_character_episode(t):
    return characters.base_rm_character_episode(source(t, "character__episode"))


@query(
    "model_staging_rm_characters",
    rf"""
    {with_tables("character", "character__episode")}
    SELECT id AS character_id, name AS character_name, status AS character_status, species AS character_species,
        gender AS character_gender, origin__name AS character_origin, image AS character_image, {LOCAL} AS character_created,
        _dlt_id AS character_dlt_id, n.num_episodes, CASE lower(regexp_extract(name, '^(rick|morty|summer|beth|jerry)\b', 1, 'i'))
            WHEN 'rick' THEN 'Rick' WHEN 'morty' THEN 'Morty' WHEN 'summer' THEN 'Summer' WHEN 'beth' THEN 'Beth'
            WHEN 'jerry' THEN 'Jerry' ELSE 'Other' END AS character_group
    FROM "character" c LEFT JOIN (SELECT _dlt_root_id AS r, COUNT({TAIL}) AS num_episodes FROM character__episode GROUP BY r) n
        ON c._dlt_id = n.r ORDER BY id
    """,
)
def staging_rm_characters(t):
    return characters.staging_rm_characters(base_rm_characters(t), base_rm_character_episode(t))


@query(
    "model_staging_rm_episodes",
    f"""
    {with_tables("episode", "episode__characters")}
    SELECT id AS episode_id, name AS episode_name, strptime(air_date, '%B %d, %Y')::TIMESTAMP AS episode_air_date, episode,
        _dlt_id AS episode_dlt_id, n.num_characters, CASE WHEN name ILIKE '%pickle rick%' THEN 'Rick-Focused'
            WHEN name ILIKE '%mort%' THEN 'Morty-Focused' WHEN name ILIKE '%park%' THEN 'Pop Culture Reference'
            ELSE 'Other' END AS episode_group,
        CAST(episode[2:3] AS INTEGER) AS season_num, CAST(episode[5:6] AS INTEGER) AS episode_num
    FROM episode e LEFT JOIN (SELECT _dlt_root_id AS r, COUNT({TAIL}) AS num_characters FROM episode__characters GROUP BY r) n
        ON e._dlt_id = n.r
    """,
)
def staging_rm_episodes(t):
    links = characters.base_rm_episode_character(source(t, "episode__characters"))
    return characters.staging_rm_episodes(characters.base_rm_episodes(source(t, "episode")), links)


@query(
    "model_staging_rm_locations",
    f"""
    {with_tables("location", "location__residents")}
    SELECT id AS location_id, name AS location_name, type AS location_type, dimension AS location_dimension,
        {LOCAL} AS location_created, _dlt_id AS location_dlt_id, n.num_characters, COALESCE(k.category, 'Unknown') AS location_categories,
        CASE WHEN dimension = 'unknown' THEN 'Unclassified' WHEN dimension = 'Dimension C-137' THEN 'Standard Format'
            WHEN dimension LIKE 'Fascist%' THEN 'Fascist Variant' WHEN dimension LIKE 'pizza%' THEN 'Thematic'
            WHEN dimension LIKE 'Replacement%' THEN 'Canonical Named' ELSE 'Other' END AS dimension_group
    FROM location l LEFT JOIN (SELECT _dlt_root_id AS r, COUNT({TAIL}) AS num_characters FROM location__residents GROUP BY r) n
        ON l._dlt_id = n.r
    LEFT JOIN (VALUES ('planet', 'Celestial Body'), ('box', 'Artificial World'), ('tv', 'Virtual/Simulated'),
        ('space station', 'Location Type'), ('hell', 'Abstract Realm'), ('country', 'Social Structure'),
        ('quadrant', 'Quadrant/Zone')) k(word, category) ON lower(l.type) = k.word
    """,
)
def staging_rm_locations(t):
    links = characters.base_rm_location_residents(source(t, "location__residents"))
    return characters.staging_rm_locations(characters.base_rm_locations(source(t, "location")), links)


# Library ----------------------------------------------------------------------------------


def _search_results(t):
    authors = F.when(F.col("n_chars") > 200, F.array("source", "lang"))
    return t("documents").select(
        F.col("lang").alias("search_term"),
        F.concat(F.lit("/works/OL"), "doc_id", F.lit("W")).alias("key"),
        F.col("source").alias("title"),
        F.lit("public").alias("ebook_access"),
        (F.col("n_chars") + 1000).alias("first_publish_year"),
        F.when(F.col("n_chars") > 500, F.lit(True)).alias("has_fulltext"),
        authors.alias("author_name"),
        F.array("lang").alias("language"),
    )


@query(
    "model_base_openlibrary_books",
    """
    SELECT lang AS search_term, '/works/OL' || doc_id || 'W' AS book_key, source AS title, 'public' AS ebook_access,
        n_chars + 1000 AS first_publish_year, n_chars > 500 AS has_fulltext FROM documents
    """,
)
def base_openlibrary_books(t):
    return library.base_openlibrary_books(library.book_records(_search_results(t)))


@query(
    "model_base_openlibrary_authors",
    """
    SELECT unnest([source, lang]) AS author_name, '/works/OL' || doc_id || 'W' AS book_key FROM documents WHERE n_chars > 200
    """,
)
def base_openlibrary_authors(t):
    return library.base_openlibrary_authors(library.child_tables(library.book_records(_search_results(t)))[0])


@query("model_base_openlibrary_languages", "SELECT lang AS code, '/works/OL' || doc_id || 'W' AS book_key FROM documents")
def base_openlibrary_languages(t):
    return library.base_openlibrary_languages(library.child_tables(library.book_records(_search_results(t)))[1])


@query(
    "model_openlibrary_subjects",
    """
    SELECT DISTINCT 'OL' || page_id || 'W' AS work_id, subject FROM (
        SELECT page_id, unnest(string_split(url, '/')) AS subject FROM pages WHERE starts_with(url, 'https')) WHERE subject <> ''
    """,
)
def openlibrary_subjects(t):
    error = F.when(~F.col("url").startswith("https"), F.lit("not found"))
    works = t("pages").select(
        F.concat(F.lit("/works/OL"), "page_id", F.lit("W")).alias("key"), F.split("url", "/").alias("subjects"), error.alias("error")
    )
    return library.subjects(works)[0]


# Satellites and universities --------------------------------------------------------------

SATELLITE_TABLES = with_tables("satellite_before", "satellite_positions")


@query(
    "model_satellite_positions_snapshot",
    f"""
    {SATELLITE_TABLES}, p AS (
        SELECT b.timestamp AS t1, s.timestamp AS t2, b.x_km AS x1, b.y_km AS y1, s.* FROM satellite_positions s
        LEFT JOIN satellite_before b ON s.satellite_id = b.satellite_id),
    h AS (
        SELECT satellite_id, satellite_name, tle_line1, tle_line2, x1 AS x_km, y1 AS y_km, z_km, distance_km, t1 AS t,
               CASE WHEN t2 > t1 THEN t2 END AS u FROM p WHERE t1 IS NOT NULL
        UNION ALL SELECT satellite_id, satellite_name, tle_line1, tle_line2, x_km, y_km, z_km, distance_km, t2, NULL
        FROM p WHERE t1 IS NULL OR t2 > t1)
    SELECT * EXCLUDE (t, u), {LOCAL.replace("created", "t")} AS sat_timestamp, {LOCAL.replace("created", "t")} AS dbt_valid_from,
        {LOCAL.replace("created", "t")} AS dbt_updated_at, {LOCAL.replace("created", "u")} AS dbt_valid_to FROM h
    """,
)
def satellite_positions_snapshot(t):
    first = satellite.satellite_positions_snapshot(None, source(t, "satellite_before"), BEFORE)
    merged = satellite.satellite_positions_snapshot(first, source(t, "satellite_positions"), AFTER)
    # The id hashes the text of a time with microseconds, which engines write differently.
    return merged.drop("dbt_scd_id")


@query(
    "model_satellite_load",
    f"""
    {SATELLITE_TABLES}
    SELECT s.* EXCLUDE (distance_km), CASE WHEN b.satellite_id IS NOT NULL
        THEN sqrt((s.x_km - b.x_km) * (s.x_km - b.x_km) + (s.y_km - b.y_km) * (s.y_km - b.y_km) + 0) END AS distance_km
    FROM satellite_positions s LEFT JOIN satellite_before b ON s.satellite_id = b.satellite_id
    WHERE s.x_km <= 100 AND (b.satellite_id IS NULL OR NOT (abs(s.x_km - b.x_km) < 1e-6 AND abs(s.y_km - b.y_km) < 1e-6))
    """,
)
def satellite_load(t):
    failed = F.when(F.col("x_km") > 100, F.lit(1)).otherwise(F.lit(0))
    current = source(t, "satellite_positions").withColumn("error_code", failed)
    return satellite.load(current, source(t, "satellite_before"))[0]


@query(
    "model_universities",
    """
    SELECT c_name AS name, c_nationkey AS nation FROM customer UNION ALL SELECT s_name, s_nationkey FROM supplier
    """,
)
def model_universities(t):
    extracts = {
        "Canada": t("customer").select(F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation")),
        "Australia": t("supplier").select(F.col("s_name").alias("name"), F.col("s_nationkey").alias("nation")),
        "New Zealand": None,
    }
    return universities.load(t.spark, extracts)[0]


# Checks -----------------------------------------------------------------------------------


@query(
    "model_checks",
    f"""
    {with_tables("daily_weather", "geo_cities", "beverages_table", "alcoholic_table", "consumption")}, {GEO_SQL}, {LOOKUP_SQL}
    SELECT 'base_geo' AS model, 'not_null:city_id' AS check_name, 'error' AS severity, COUNT(*) FILTER (WHERE city_id IS NULL) AS failures FROM geo
    UNION ALL SELECT 'base_geo', 'between:latitude', 'error', COUNT(*) FILTER (WHERE latitude NOT BETWEEN -90 AND 90) FROM geo
    UNION ALL SELECT 'base_geo', 'between:longitude', 'error', COUNT(*) FILTER (WHERE longitude NOT BETWEEN -180 AND 180) FROM geo
    UNION ALL SELECT 'base_geo', 'unique:city_id', 'error', COUNT(city_id) - COUNT(DISTINCT city_id) FROM geo
    UNION ALL SELECT 'base_geo', 'accepted_values:country_code', 'error', COUNT(DISTINCT country_code) FILTER (WHERE country_code NOT IN ('AU', 'NZ', 'CA', 'GB')) FROM geo
    UNION ALL SELECT 'base_geo', 'contract', 'error', 0
    UNION ALL SELECT 'base_weather', 'between:latitude', 'error', COUNT(*) FILTER (WHERE location__lat NOT BETWEEN -90 AND 90) FROM daily_weather
    UNION ALL SELECT 'base_weather', 'between:longitude', 'error', COUNT(*) FILTER (WHERE location__lng NOT BETWEEN -180 AND 180) FROM daily_weather
    UNION ALL SELECT 'base_weather', 'unique_combination:weather_date', 'error', 0
    UNION ALL SELECT 'base_weather', 'relationships:city', 'error', COUNT(*) FROM daily_weather WHERE city NOT IN (SELECT city FROM geo)
    UNION ALL SELECT 'base_beverages', 'not_null:beverage_name', 'error', COUNT(*) FILTER (WHERE beverage_name IS NULL) FROM lookup
    UNION ALL SELECT 'base_beverages', 'not_null:beverage_id', 'error', COUNT(*) FILTER (WHERE beverage_id IS NULL) FROM lookup
    UNION ALL SELECT 'base_beverages', 'unique:beverage_name', 'error', COUNT(beverage_name) - COUNT(DISTINCT beverage_name) FROM lookup
    UNION ALL SELECT 'base_beverages', 'unique:beverage_id', 'error', COUNT(beverage_id) - COUNT(DISTINCT beverage_id) FROM lookup
    UNION ALL SELECT 'base_beverages', 'accepted_values:alcoholic_type', 'error', COUNT(DISTINCT alcoholic_type) FILTER (WHERE alcoholic_type = 'Unclear') FROM lookup
    UNION ALL SELECT 'base_beverage_consumption', 'not_null:id_drink', 'error', COUNT(*) FILTER (WHERE id_drink IS NULL) FROM consumption
    UNION ALL SELECT 'base_beverage_consumption', 'relationships:id_drink', 'error', COUNT(*) FROM consumption WHERE id_drink NOT IN (SELECT beverage_id FROM lookup)
    """,
)
def model_checks(t):
    models = {
        "base_geo": geo.base_geo(source(t, "geo_cities")),
        "base_weather": weather.base_weather(source(t, "daily_weather")),
        "base_beverages": base_beverages(t),
        "base_beverage_consumption": beverages.base_beverage_consumption(source(t, "consumption")),
    }
    return checks.check_models(models, TODAY)
