"""Column layouts of the tables that are read. Declared, so no scan infers them."""

from __future__ import annotations

from pyspark.sql import types as T

# The measured tables.
BENCH_TABLES: dict[str, str] = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}

_CHILD = "_dlt_list_idx bigint, _dlt_id string, _dlt_root_id string"
_SCALAR_CHILD = f"value string, {_CHILD}"
_LINK_CHILD = "_dlt_root_id string, value string"

# The raw tables of each data source as (schema, table) and their columns.
SOURCE_TABLES: dict[str, dict[str, str]] = {
    "beverages": {
        "beverages_table": "id_drink string, str_drink string, source_beverage_type string",
        "alcoholic_table": "id_drink string, source_alcohol_type string",
        "glass_table": "id_drink string, source_glass string",
        "ingredients_table": "id_drink string, source_ingredient string, str_drink string",
        "consumption": "id_drink string, str_drink string, str_category string, str_alcoholic string, "
        "str_glass string, str_instructions string, str_drink_thumb string, date_modified timestamp_ntz, "
        + ", ".join(f"str_ingredient{i} string" for i in range(1, 9)),
    },
    "fbi": {
        "wanted": "uid string, _dlt_id string, poster_classification string, hair string, race_raw string, url string, "
        "remarks string, eyes_raw string, race string, place_of_birth string, modified timestamp_ntz, "
        "hair_raw string, status string, publication timestamp_ntz, reward_min double, sex string, caution string, "
        "eyes string, title string, reward_max double, person_classification string, description string, "
        "path_id string, warning_message string, reward_text string, details string, age_max double, "
        "weight_min double, weight_max double, height_min double, weight string, height_max double, "
        "age_min double, age_range string, nationality string, scars_and_marks string, ncic string, build string, "
        "complexion string",
        "wanted__aliases": _SCALAR_CHILD,
        "wanted__dates_of_birth_used": _SCALAR_CHILD,
        "wanted__field_offices": _SCALAR_CHILD,
        "wanted__languages": _SCALAR_CHILD,
        "wanted__occupations": _SCALAR_CHILD,
        "wanted__possible_countries": _SCALAR_CHILD,
        "wanted__possible_states": _SCALAR_CHILD,
        "wanted__subjects": _SCALAR_CHILD,
        "wanted__files": f"url string, name string, {_CHILD}",
        "wanted__images": f"large string, thumb string, original string, caption string, {_CHILD}",
    },
    "geo": {
        "geo_cities": "city_id bigint, city string, latitude double, longitude double, country_code string, "
        "country string, region string, region_code string, continent string",
    },
    "gsheets": {"gsheets_finance": "id bigint, stock string, price double, date_time timestamp_ntz"},
    "openlibrary": {
        "books": "search_term string, key string, title string, ebook_access string, first_publish_year bigint, "
        "has_fulltext boolean",
        "books__authors": f"name string, book_key string, {_CHILD}",
        "books__languages": f"code string, book_key string, {_CHILD}",
        "subjects": "work_id string, subject string, error string",
    },
    "rick_and_morty": {
        "character": "id bigint, name string, status string, species string, gender string, origin__name string, "
        "location__name string, location__url string, image string, url string, created timestamp_ntz, "
        "_dlt_id string",
        "episode": "id bigint, name string, episode string, url string, air_date string, created timestamp_ntz, "
        "_dlt_id string",
        "location": "id bigint, name string, type string, dimension string, url string, created timestamp_ntz, "
        "_dlt_id string",
        "character__episode": _LINK_CHILD,
        "episode__characters": _LINK_CHILD,
        "location__residents": _LINK_CHILD,
    },
    "satellite": {
        "satellite_positions": "satellite_id bigint, satellite_name string, timestamp timestamp_ntz, "
        "tle_line1 string, tle_line2 string, x_km double, y_km double, z_km double, distance_km double",
    },
    "uv": {
        "uv_index": "uv double, uv_max double, uv_time timestamp_ntz, ozone double, city string, "
        "location__lat double, location__lng double, timestamp timestamp_ntz",
    },
    "weather": {
        "daily_weather": "date date, city string, temperature_max double, temperature_min double, "
        "temperature_mean double, precipitation_sum double, windspeed_max double, windgusts_max double, "
        "sunshine_duration double, uv_index_max double, location__lat double, location__lng double, "
        "timestamp timestamp_ntz",
    },
}

# Columns and types the two contracted tables must have.
CONTRACTS: dict[str, str] = {
    "base_geo": "city_id bigint, city string, latitude double, longitude double, country_code string, "
    "country string, region string, continent string",
    "base_rm_locations": "location_id bigint, location_name string, location_type string, "
    "location_dimension string, location_url string, location_created timestamp_ntz, location_dlt_id string",
}


def layout(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def source_layout(source: str, table: str) -> T.StructType:
    try:
        return layout(SOURCE_TABLES[source][table])
    except KeyError:
        raise KeyError(f"no declared source table {source}.{table}") from None
