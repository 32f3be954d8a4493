"""The declared checks of the models."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import quality
from tidemark.operators.quality import RowCheck, TableCheck, UniqueCheck
from tidemark.sources.layouts import CONTRACTS, layout

# The checks of each model. A kind is followed by its arguments.
DECLARED: dict[str, list[tuple]] = {
    "gsheets_finance": [("not_null", "id"), ("unique", "id")],
    "base_beverage_consumption": [
        ("not_null", "id_drink"),
        ("relationships", "id_drink", "base_beverages", "beverage_id"),
    ],
    "base_beverage_ingredients_lookup": [("unique_combination", "ingredient", "beverage_id")],
    "base_beverages": [
        ("not_null", "beverage_name"),
        ("unique", "beverage_name"),
        ("not_null", "beverage_id"),
        ("unique", "beverage_id"),
        ("accepted_values", "alcoholic_type", "Non alcoholic", "Optional alcohol", "Alcoholic"),
    ],
    "base_fbi_aliases": [("unique_warn", "wanted_aliases_sk")],
    "base_fbi_dates_of_birth_used": [("unique_warn", "wanted_dob_sk")],
    "base_fbi_field_offices": [("unique_warn", "wanted_field_offices_sk")],
    "base_fbi_files": [("unique_warn", "wanted_files_sk")],
    "base_fbi_images": [("unique_warn", "wanted_images_sk")],
    "base_fbi_languages": [("unique_warn", "wanted_languages_sk")],
    "base_fbi_occupations": [
        ("relationships", "wanted_id", "base_fbi_wanted", "pk"),
        ("unique_warn", "wanted_occupations_sk"),
    ],
    "base_fbi_possible_countries": [("unique_warn", "wanted_countries_sk")],
    "base_fbi_possible_states": [
        ("relationships", "wanted_id", "base_fbi_wanted", "pk"),
        ("unique_warn", "wanted_states_sk"),
    ],
    "base_fbi_subject": [("relationships", "wanted_id", "base_fbi_wanted", "pk"), ("unique", "wanted_subject_sk")],
    "base_fbi_wanted": [("not_null", "pk"), ("unique", "pk")],
    "base_geo": [
        ("not_null", "city_id"),
        ("unique", "city_id"),
        ("between", "latitude", -90, 90),
        ("between", "longitude", -180, 180),
        ("accepted_values", "country_code", "AU", "NZ", "CA", "GB"),
    ],
    "base_gsheets_finance": [("not_null", "id"), ("unique", "id")],
    "base_rm_character_episode": [("unique_combination", "character_dlt_id", "episode_id")],
    "base_rm_characters": [
        ("unique", "character_id"),
        ("not_null", "character_id"),
        ("accepted_values", "character_status", "Alive", "unknown", "Dead"),
        ("accepted_values", "character_gender", "Genderless", "Male", "Female", "unknown"),
    ],
    "base_rm_episode_character": [("unique_combination", "episode_dlt_id", "character_id")],
    "base_rm_episodes": [("unique", "episode_id"), ("not_null", "episode_id")],
    "base_rm_location_residents": [("unique_combination", "location_dlt_id", "character_id")],
    "base_rm_locations": [("unique", "location_id"), ("not_null", "location_id")],
    "base_uv": [
        ("unique_combination", "uv_time", "city"),
        ("relationships", "city", "base_geo", "city"),
        ("between", "location__lat", -90, 90),
        ("between", "location__lng", -180, 180),
    ],
    "base_weather": [
        ("unique_combination", "weather_date", "city"),
        ("relationships", "city", "base_geo", "city"),
        ("between", "latitude", -90, 90),
        ("between", "longitude", -180, 180),
    ],
    "dim_alcoholic_type": [("unique", "alcoholic_type_sk")],
    "dim_date": [("unique", "date_col"), ("not_null", "date_col")],
    "fact_weather": [("before_today", "weather_date"), ("relationships", "city_sk", "dim_city", "city_sk")],
    "glass_type_snapshot": [("not_null", "beverage_id"), ("unique", "beverage_id")],
    "dim_beverage_ingredient_hierarchy": [
        ("row_distinct", "ingredient", *[f"ingredient{i}" for i in range(2, 8)]),
    ],
}

# Days after which loaded data is warned about or fails, and the column of its age.
FRESHNESS = {
    "gsheets_finance": ("date_time", 2, 5),
    "uv_index": ("timestamp", 3, 9),
    "daily_weather": ("timestamp", 2, 5),
}


def check_model(name: str, models: Mapping[str, DataFrame], as_of) -> DataFrame:
    """Results of the declared checks of one model: (model, check_name, severity, failures)."""
    df, rows, tables, uniques = models[name], [], [], []
    for kind, column, *rest in DECLARED[name]:
        label = f"{kind}:{column}"
        if kind == "not_null":
            rows.append(RowCheck(label, quality.null_in(column)))
        elif kind == "between":
            rows.append(RowCheck(label, quality.outside(column, *rest)))
        elif kind == "before_today":
            rows.append(RowCheck(label, quality.not_true(F.col(column) < F.lit(as_of))))
        elif kind == "row_distinct":
            rows.append(RowCheck(label, quality.has_repeats([column, *rest])))
        elif kind in ("unique", "unique_warn"):
            uniques.append(UniqueCheck(label, (column,), "warn" if kind.endswith("warn") else "error", ignore_nulls=True))
        elif kind == "unique_combination":
            uniques.append(UniqueCheck(label, (column, *rest)))
        elif kind == "accepted_values":
            tables.append(TableCheck(label, quality.accepted_values(df, column, rest)))
        elif kind == "relationships":
            parent, field = rest
            tables.append(TableCheck(label, quality.relationships(df, column, models[parent], field)))
        else:
            raise ValueError(f"unknown check {kind}")
    if name in CONTRACTS:
        tables.append(TableCheck("contract", quality.schema_contract(df, layout(CONTRACTS[name]))))
    return quality.run_checks(df, rows, tables, uniques).select(F.lit(name).alias("model"), "check_name", "severity", "failures")


def check_models(models: Mapping[str, DataFrame], as_of) -> DataFrame:
    """All declared checks of the models given."""
    return reduce(DataFrame.unionByName, [check_model(n, models, as_of) for n in DECLARED if n in models])
