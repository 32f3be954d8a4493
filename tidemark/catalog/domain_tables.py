"""Source tables of the domain models, derived from the measured tables.

The text is SQL that Spark and the oracle both run, with table names in braces.
"""

from __future__ import annotations

import re

from tidemark.sources.layouts import SOURCE_TABLES

_WANTED_FIELDS = {
    "uid": "'W' || CAST(c.c_custkey AS STRING)",
    "_dlt_id": "md5('W' || CAST(c.c_custkey AS STRING))",
    "status": "CASE c.c_mktsegment WHEN 'BUILDING' THEN 'captured' WHEN 'MACHINERY' THEN NULL ELSE 'na' END",
    "poster_classification": "lower(c.c_mktsegment)",
    "person_classification": "CASE WHEN c.c_nationkey < 12 THEN 'Main' ELSE 'Victim' END",
    "title": "c.c_name",
    "url": "'https://example.com/' || CAST(c.c_custkey AS STRING)",
    "sex": "CASE WHEN c.c_acctbal > 4000 THEN 'Female' ELSE 'Male' END",
    "reward_min": "c.c_acctbal",
    "weight": "CAST(c.c_nationkey AS STRING)",
    "modified": "o.latest",
    "publication": "o.earliest",
}


def _wanted() -> str:
    declared = [column.split(" ") for column in SOURCE_TABLES["fbi"]["wanted"].split(", ")]
    fields = [f"{_WANTED_FIELDS.get(name) or f'CAST(NULL AS {kind})'} AS {name}" for name, kind in declared]
    return (
        f"SELECT {', '.join(fields)} FROM {{customer}} c LEFT JOIN (SELECT o_custkey, MAX(o_orderdate) AS latest, "
        "MIN(o_orderdate) AS earliest FROM {orders} GROUP BY o_custkey) o ON c.c_custkey = o.o_custkey"
    )


# Value of each child list over the orders of a customer; coarse ones, as lists multiply each other.
CHILD_RULES = {
    "wanted__aliases": "o_orderstatus",
    "wanted__dates_of_birth_used": "substr(CAST(year(o_orderdate) AS STRING), 1, 1) || '000'",
    "wanted__field_offices": "CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'north' ELSE 'south' END",
    "wanted__files": "CAST(month(o_orderdate) * 0 AS STRING)",
    "wanted__images": "CASE WHEN day(o_orderdate) < 32 THEN 'I' END",
    "wanted__languages": "CASE o_orderstatus WHEN 'P' THEN 'P' ELSE 'other' END",
    "wanted__occupations": "substr(o_orderpriority, 2, 1)",
    "wanted__possible_countries": "CASE WHEN o_totalprice IS NOT NULL THEN 'C' END",
    "wanted__possible_states": "CASE WHEN o_totalprice > 250000 THEN 'upper' ELSE 'lower' END",
    "wanted__subjects": "CASE WHEN o_totalprice < 50000 THEN 'small' ELSE 'large' END",
}

# Values of lists that are read alone, each value an order has.
FULL_LISTS = {"wanted__files": "CAST(month(o_orderdate) AS STRING)", "wanted__occupations": "o_orderstatus"}


def _child(name: str, value: str) -> str:
    fields = {
        "wanted__files": "'https://example.com/' || value AS url, value AS name",
        "wanted__images": "'L' || value AS large, 'T' || value AS thumb, 'O' || value AS original, value AS caption",
    }.get(name, "value")
    return (
        f"SELECT {fields}, CAST(length(value) AS BIGINT) AS _dlt_list_idx, md5('{name}' || k || '|' || value) AS _dlt_id, "
        f"md5('W' || k) AS _dlt_root_id FROM (SELECT DISTINCT CAST(o_custkey AS STRING) AS k, {value} AS value "
        "FROM {orders}) x"
    )


DOMAIN_TABLES: dict[str, str] = {
    "daily_weather": """
        SELECT CAST(ts AS DATE) AS date, 'City ' || CAST(user_id AS STRING) AS city, MAX(value) AS temperature_max,
            MIN(value) AS temperature_min, max_by(value, (ts, event_id)) AS temperature_mean,
            min_by(value, (ts, event_id)) AS precipitation_sum, CAST(MAX(length(props)) AS DOUBLE) AS windspeed_max,
            CAST(MIN(length(props)) AS DOUBLE) AS windgusts_max, CAST(COUNT(*) AS DOUBLE) AS sunshine_duration,
            MAX(value) AS uv_index_max, CAST(user_id AS DOUBLE) AS location__lat, CAST(-user_id AS DOUBLE) AS location__lng,
            MAX(ts) AS timestamp
        FROM {events} GROUP BY user_id, CAST(ts AS DATE)""",
    "geo_cities": """
        SELECT c.c_custkey AS city_id, 'City ' || CAST(c.c_nationkey AS STRING) AS city, c.c_acctbal / 200 AS latitude,
            c.c_acctbal / 50 AS longitude, CASE n.n_regionkey WHEN 0 THEN 'NZ' WHEN 1 THEN 'GB' WHEN 2 THEN 'AU'
            WHEN 3 THEN 'CA' ELSE 'FJ' END AS country_code, CASE n.n_regionkey WHEN 0 THEN 'New Zealand'
            WHEN 1 THEN 'United Kingdom' WHEN 2 THEN 'Australia' WHEN 3 THEN 'Canada' ELSE 'Fiji' END AS country,
            c.c_mktsegment AS region, substr(c.c_mktsegment, 1, 2) AS region_code, 'OC' AS continent
        FROM {customer} c JOIN {nation} n ON c.c_nationkey = n.n_nationkey""",
    "gsheets_finance": "SELECT event_id AS id, event_type AS stock, value AS price, ts AS date_time FROM {events}",
    "uv_index": """
        SELECT value AS uv, value * 2 AS uv_max, ts AS uv_time, CAST(user_id AS DOUBLE) AS ozone,
            CASE event_type WHEN 'click' THEN 'Sydney' WHEN 'view' THEN 'Melbourne' WHEN 'error' THEN 'Perth'
            WHEN 'purchase' THEN 'Hobart' ELSE 'Darwin' END AS city, CAST(user_id AS DOUBLE) AS location__lat,
            CAST(-user_id AS DOUBLE) AS location__lng, ts AS timestamp FROM {events}""",
    "beverages_table": """
        SELECT CAST(p_partkey AS STRING) AS id_drink, p_name || ' ' || CAST(p_partkey AS STRING) AS str_drink,
            p_brand AS source_beverage_type FROM {part}""",
    "alcoholic_table": """
        SELECT CAST(p_partkey AS STRING) AS id_drink, CASE p_type WHEN 'ECONOMY' THEN 'Alcoholic'
            WHEN 'SMALL' THEN 'Non alcoholic' WHEN 'PROMO' THEN 'Unclear' ELSE 'Optional alcohol' END AS source_alcohol_type
        FROM {part} WHERE p_size <= 40""",
    "glass_table_before": """
        SELECT CAST(p_partkey AS STRING) AS id_drink, p_type AS source_glass FROM {part} WHERE p_size > 3""",
    "glass_table": """
        SELECT CAST(p_partkey AS STRING) AS id_drink, CASE WHEN p_brand IN ('Brand#1', 'Brand#2') THEN 'Mug' ELSE p_type END
            AS source_glass FROM {part} WHERE p_size < 48""",
    "ingredients_table": """
        SELECT DISTINCT CAST(o_custkey AS STRING) AS id_drink, o_orderpriority AS source_ingredient,
            'Drink ' || CAST(o_custkey AS STRING) AS str_drink FROM {orders}""",
    "consumption": """
        SELECT CAST(l_partkey AS STRING) AS id_drink, 'Drink ' || CAST(l_partkey AS STRING) AS str_drink,
            l_returnflag AS str_category, l_linestatus AS str_alcoholic, 'Jar' AS str_glass,
            CAST(l_orderkey AS STRING) AS str_instructions, CAST(NULL AS STRING) AS str_drink_thumb,
            l_shipdate AS date_modified, CAST(l_suppkey AS STRING) AS str_ingredient1,
            CAST(l_linenumber AS STRING) AS str_ingredient2, CAST(NULL AS STRING) AS str_ingredient3,
            CAST(NULL AS STRING) AS str_ingredient4, CAST(NULL AS STRING) AS str_ingredient5,
            CAST(NULL AS STRING) AS str_ingredient6, CAST(NULL AS STRING) AS str_ingredient7,
            CAST(NULL AS STRING) AS str_ingredient8 FROM {lineitem}""",
    "wanted": _wanted(),
    **{name: _child(name, value) for name, value in CHILD_RULES.items()},
    **{f"{name}__full": _child(name, value) for name, value in FULL_LISTS.items()},
    "character": """
        SELECT p_partkey AS id, replace(replace(p_name, 'red ', 'Rick '), 'blue ', 'MORTY ') AS name,
            CASE WHEN p_size < 20 THEN 'Alive' WHEN p_size < 40 THEN 'Dead' ELSE 'unknown' END AS status, p_type AS species,
            CASE WHEN p_size < 25 THEN 'Male' ELSE 'Female' END AS gender, p_brand AS origin__name, p_brand AS location__name,
            'https://example.com/location/' || CAST(p_size AS STRING) AS location__url, p_name AS image,
            'https://example.com/character/' || CAST(p_partkey AS STRING) AS url, l.created,
            md5('C' || CAST(p_partkey AS STRING)) AS _dlt_id
        FROM {part} p JOIN (SELECT l_partkey, MIN(l_shipdate) AS created FROM {lineitem} GROUP BY l_partkey) l
            ON p.p_partkey = l.l_partkey""",
    "character__episode": """
        SELECT md5('C' || CAST(l_partkey AS STRING)) AS _dlt_root_id, CASE WHEN l_linenumber = 7 THEN 'none'
            ELSE 'https://example.com/episode/' || CAST(l_orderkey AS STRING) END AS value
        FROM {lineitem}""",
    "episode": """
        SELECT p_partkey AS id, replace(replace(replace(p_name, 'bolt', 'Pickle RICK'), 'ring', 'Mortynight'), 'gear',
            'Jurassic Park') AS name, 'S' || lpad(CAST(p_size AS STRING), 2, '0') || 'E' ||
            lpad(CAST(length(p_name) AS STRING), 2, '0') AS episode, 'https://example.com/' || p_name AS url,
            CASE WHEN p_size < 10 THEN 'December 2, 2013' WHEN p_size < 30 THEN 'May 12, 2014'
            ELSE 'September 30, 2017' END AS air_date, l.created, md5('E' || CAST(p_partkey AS STRING)) AS _dlt_id
        FROM {part} p JOIN (SELECT l_partkey, MAX(l_shipdate) AS created FROM {lineitem} GROUP BY l_partkey) l
            ON p.p_partkey = l.l_partkey""",
    "episode__characters": """
        SELECT md5('E' || CAST(l_partkey AS STRING)) AS _dlt_root_id,
            'https://example.com/character/' || CAST(l_suppkey AS STRING) AS value FROM {lineitem}""",
    "location": """
        SELECT s_suppkey AS id, s_name AS name, CASE WHEN s_nationkey < 4 THEN 'Planet' WHEN s_nationkey < 7 THEN 'Space station'
            WHEN s_nationkey < 10 THEN 'TV' WHEN s_nationkey < 13 THEN 'box' WHEN s_nationkey < 15 THEN 'Country'
            WHEN s_nationkey < 17 THEN 'Hell' WHEN s_nationkey < 19 THEN 'Quadrant' WHEN s_nationkey < 22 THEN 'Moon' END AS type,
            CASE WHEN s_acctbal < 500 THEN 'unknown' WHEN s_acctbal < 2000 THEN 'Dimension C-137' WHEN s_acctbal < 3000 THEN
            'Fascist Teddy Bear' WHEN s_acctbal < 5000 THEN 'pizza dimension' WHEN s_acctbal < 7000 THEN 'Replacement Dimension'
            WHEN s_acctbal < 9000 THEN 'Dimension 5-126' END AS dimension, 'https://example.com/' || s_name AS url, l.created,
            md5('L' || CAST(s_suppkey AS STRING)) AS _dlt_id
        FROM {supplier} s JOIN (SELECT l_suppkey, MIN(l_shipdate) AS created FROM {lineitem} GROUP BY l_suppkey) l
            ON s.s_suppkey = l.l_suppkey""",
    "location__residents": """
        SELECT DISTINCT md5('L' || CAST(l_suppkey AS STRING)) AS _dlt_root_id,
            'https://example.com/character/' || CAST(l_partkey AS STRING) AS value FROM {lineitem}""",
    "satellite_before": """
        SELECT user_id AS satellite_id, 'SAT ' || CAST(user_id AS STRING) AS satellite_name, MAX(ts) AS timestamp,
            '1 ' AS tle_line1, '2 ' AS tle_line2, max_by(value, (ts, event_id)) AS x_km, CAST(MIN(length(props)) AS DOUBLE) AS y_km,
            CAST(0 AS DOUBLE) AS z_km, CAST(NULL AS DOUBLE) AS distance_km
        FROM {events} WHERE CAST(ts AS DATE) <= DATE '2024-01-28' GROUP BY user_id""",
    "satellite_positions": """
        SELECT user_id AS satellite_id, 'SAT ' || CAST(user_id AS STRING) AS satellite_name, MAX(ts) AS timestamp,
            '1 ' AS tle_line1, '2 ' AS tle_line2, max_by(value, (ts, event_id)) AS x_km, CAST(MIN(length(props)) AS DOUBLE) AS y_km,
            CAST(0 AS DOUBLE) AS z_km, CAST(NULL AS DOUBLE) AS distance_km
        FROM {events} GROUP BY user_id""",
}


def with_tables(*names: str) -> str:
    """A WITH clause that defines the named tables for the oracle."""
    plain = {n: re.sub(r"\{(\w+)\}", r"\1", DOMAIN_TABLES[n]) for n in names}
    return "WITH " + ",\n".join(f'"{n}" AS ({text})' for n, text in plain.items())
