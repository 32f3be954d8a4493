"""Beverages: dimensions, ingredient hierarchy, glass history and consumption facts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import zone_date
from tidemark.functions.keys import surrogate_key
from tidemark.operators import history
from tidemark.operators.aggregates import dimension
from tidemark.operators.joins import hierarchy, lookup_join
from tidemark.operators.loading import append_rows, merge_upsert
from tidemark.operators.relations import union_tagged

# The loaded dimensions, their tag column and their merge key.
DIMENSIONS = {
    "ingredients_table": ("source_ingredient", ["id_drink", "source_ingredient"]),
    "alcoholic_table": ("source_alcohol_type", ["id_drink"]),
    "beverages_table": ("source_beverage_type", ["id_drink"]),
    "glass_table": ("source_glass", ["id_drink"]),
}
INGREDIENTS = [f"str_ingredient{i}" for i in range(1, 9)]


def load_dimension(table: str, extracts: Mapping[str, DataFrame], stored: DataFrame) -> DataFrame:
    """Merge the records requested per dimension value, each tagged with its value."""
    tag, keys = DIMENSIONS[table]
    records = [f.name for f in stored.schema.fields if f.name != tag]
    tagged = union_tagged({v: df.select(*records) for v, df in extracts.items()}, tag)
    return merge_upsert(stored, tagged, keys, [tag])


def append_consumption(stored: DataFrame, drinks: DataFrame) -> DataFrame:
    return append_rows(stored, drinks)


def base_beverages(beverages_table: DataFrame, alcoholic_table: DataFrame) -> DataFrame:
    kinds = alcoholic_table.select(F.col("id_drink").alias("alcoholic_id"), "source_alcohol_type")
    return lookup_join(beverages_table, kinds, [("id_drink", "alcoholic_id")]).select(
        F.col("str_drink").alias("beverage_name"),
        F.col("id_drink").alias("beverage_id"),
        F.col("source_beverage_type").alias("beverage_type"),
        surrogate_key("source_beverage_type", "source_alcohol_type").alias("beverage_category_sk"),
        F.col("source_alcohol_type").alias("alcoholic_type"),
    )


def base_beverage_ingredients_lookup(ingredients_table: DataFrame) -> DataFrame:
    return ingredients_table.where(F.col("id_drink").isNotNull()).select(
        F.col("source_ingredient").alias("ingredient"),
        F.col("id_drink").alias("beverage_id"),
        F.col("str_drink").alias("beverage_name"),
    )


def base_beverage_consumption(consumption: DataFrame) -> DataFrame:
    return consumption.select(
        "id_drink",
        "str_drink",
        "str_category",
        "str_alcoholic",
        "str_glass",
        "str_instructions",
        "str_drink_thumb",
        zone_date("date_modified").alias("date_melbourne"),
        *INGREDIENTS,
    )


def staging_beverage_lookup(base: DataFrame) -> DataFrame:
    return base.select(
        "beverage_name",
        "beverage_id",
        "beverage_type",
        surrogate_key("beverage_type").alias("beverage_type_sk"),
        surrogate_key("beverage_type", "alcoholic_type").alias("beverage_category_sk"),
        "alcoholic_type",
        surrogate_key("alcoholic_type").alias("alcoholic_type_sk"),
    )


def glass_records(glass_table: DataFrame) -> DataFrame:
    """The rows the glass history follows."""
    return glass_table.select(
        F.col("id_drink").alias("beverage_id"),
        F.col("source_glass").alias("glass_type"),
        surrogate_key("source_glass").alias("glass_type_sk"),
    )


def glass_type_snapshot(stored: DataFrame | None, glass_table: DataFrame, now: dt.datetime) -> DataFrame:
    current, key = glass_records(glass_table), ["beverage_id"]
    if stored is None:
        return history.first_snapshot(current, key, history.instant(now))
    return history.scd2_check(stored, current, key, ["glass_type", "glass_type_sk"], now)


def staging_beverage_consumption(base: DataFrame, glass_history: DataFrame, lookup: DataFrame) -> DataFrame:
    """Consumption with the glass now in use and the beverage keys."""
    glasses = history.open_rows(glass_history).select(F.col("beverage_id").alias("glass_id"), "glass_type_sk")
    kinds = lookup.select(
        F.col("beverage_id").alias("lookup_id"),
        "beverage_category_sk",
        "beverage_type_sk",
        "beverage_type",
        "alcoholic_type_sk",
        "alcoholic_type",
    )
    with_glass = lookup_join(base, glasses, [("id_drink", "glass_id")])
    joined = lookup_join(with_glass, kinds, [("id_drink", "lookup_id")], keys_from=base)
    return joined.select(
        F.col("id_drink").alias("beverage_id"),
        F.col("str_drink").alias("beverage_name"),
        "beverage_category_sk",
        F.col("str_glass").alias("glass_type"),
        "beverage_type_sk",
        "beverage_type",
        "alcoholic_type_sk",
        "alcoholic_type",
        "str_category",
        "str_alcoholic",
        "glass_type_sk",
        F.col("str_instructions").alias("beverage_instructions"),
        F.col("str_drink_thumb").alias("beverage_url"),
        "date_melbourne",
        *INGREDIENTS,
    )


def fact_beverage_consumption(staging: DataFrame) -> DataFrame:
    return staging.select(
        "beverage_id",
        "beverage_name",
        "glass_type_sk",
        "beverage_category_sk",
        "beverage_type_sk",
        "alcoholic_type_sk",
        "beverage_type",
        "alcoholic_type",
        "beverage_instructions",
        "beverage_url",
        "glass_type",
        "date_melbourne",
        *INGREDIENTS,
    )


def dim_alcoholic_type(lookup: DataFrame) -> DataFrame:
    return dimension(lookup, "alcoholic_type", "alcoholic_type_sk")


def dim_beverage_type(lookup: DataFrame) -> DataFrame:
    return dimension(lookup, "beverage_type", "alcoholic_type", "beverage_category_sk", "alcoholic_type_sk")


def dim_beverage_glass_type(glass_history: DataFrame) -> DataFrame:
    """Every glass type ever used, retired ones included."""
    return dimension(glass_history, "glass_type", "glass_type_sk")


def dim_beverage_ingredient_jointable(ingredients_table: DataFrame) -> DataFrame:
    return dimension(ingredients_table.where(F.col("id_drink").isNotNull()), F.col("id_drink").alias("beverage_id"))


def dim_beverage_ingredient_hierarchy(lookup: DataFrame) -> DataFrame:
    levels = hierarchy(lookup, "beverage_id", "ingredient", depth=7, carry=["beverage_name"])
    return levels.select("ingredient", "beverage_id", "beverage_name", *[f"ingredient{i}" for i in range(2, 8)])
