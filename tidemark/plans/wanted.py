"""Wanted persons: child tables, star of their keys and status history."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.keys import composite_key
from tidemark.operators import history
from tidemark.operators.incremental import filter_unseen
from tidemark.operators.joins import join_child, star_fanout
from tidemark.operators.loading import merge_upsert
from tidemark.operators.relations import union_keys

# The columns of the base table, renamed where a new name is given.
RENAMED = {"url": "urllink", "uid": "pk", "weight": "bodyweight"}
COLUMNS = [
    "poster_classification", "hair", "race_raw", "url", "uid", "remarks", "eyes_raw", "race", "place_of_birth",
    "modified", "hair_raw", "status", "publication", "reward_min", "sex", "caution", "eyes", "title", "reward_max",
    "person_classification", "description", "path_id", "warning_message", "reward_text", "details", "age_max",
    "weight_min", "weight_max", "height_min", "weight", "height_max", "age_min", "age_range", "nationality",
    "scars_and_marks", "ncic", "build", "complexion",
]
NOT_IN_LOOKUP = ("poster_classification", "status")

# Child table, its value columns, and the names of order and key, per base model.
CHILDREN: dict[str, tuple[str, dict[str, str], str, str]] = {
    "base_fbi_aliases": ("wanted__aliases", {"value": "aliases"}, "aliases_order", "wanted_aliases_sk"),
    "base_fbi_dates_of_birth_used": ("wanted__dates_of_birth_used", {"value": "dob"}, "dob_order", "wanted_dob_sk"),
    "base_fbi_field_offices": (
        "wanted__field_offices", {"value": "field_office"}, "field_office_order", "wanted_field_offices_sk",
    ),
    "base_fbi_files": (
        "wanted__files", {"url": "url_link", "name": "language_name"}, "file_order", "wanted_files_sk",
    ),
    "base_fbi_images": (
        "wanted__images",
        {"large": "large_image", "thumb": "thumb_image", "original": "original_image", "caption": "caption"},
        "image_order",
        "wanted_images_sk",
    ),
    "base_fbi_languages": ("wanted__languages", {"value": "wanted_language"}, "language_order", "wanted_languages_sk"),
    "base_fbi_occupations": ("wanted__occupations", {"value": "occupations"}, "occupations_order", "wanted_occupations_sk"),
    "base_fbi_possible_countries": (
        "wanted__possible_countries", {"value": "country"}, "country_order", "wanted_countries_sk",
    ),
    "base_fbi_possible_states": ("wanted__possible_states", {"value": "wanted_state"}, "state_order", "wanted_states_sk"),
    "base_fbi_subject": ("wanted__subjects", {"value": "wanted_subject"}, "subject_order", "wanted_subject_sk"),
}


def seen_key():
    return composite_key("uid", "status", "poster_classification")


def load(batch: DataFrame, seen: DataFrame, stored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Merge records with an unseen (uid, status, poster) key; returns table and seen keys."""
    keyed = batch.withColumn("seen_key", seen_key())
    new = filter_unseen(keyed, seen, "seen_key", stored)
    table = merge_upsert(stored, new.drop("seen_key"), ["uid"], ["modified"])
    return table, union_keys(seen, new.select("seen_key"))


def base_fbi_wanted(wanted: DataFrame) -> DataFrame:
    return wanted.select(*[F.col(c).alias(RENAMED.get(c, c)) for c in COLUMNS])


def base_child(model: str, child: DataFrame, wanted: DataFrame) -> DataFrame:
    """One of the ten child models: values, owner, list position and key."""
    _, values, order, key = CHILDREN[model]
    return join_child(child, wanted, "_dlt_id", "uid", "wanted_id").select(
        *[F.col(source).alias(name) for source, name in values.items()],
        "wanted_id",
        F.col("_dlt_list_idx").alias(order),
        F.col("_dlt_id").alias(key),
    )


def staging_fbi_wanted_lookup(base: DataFrame) -> DataFrame:
    return base.drop(*NOT_IN_LOOKUP)


def staging_fbi_wanted_fact(base: DataFrame, children: Mapping[str, DataFrame]) -> DataFrame:
    """All combinations of child keys per person; ``children`` by base model name."""
    sides = {CHILDREN[m][3]: (children[m], "wanted_id", CHILDREN[m][3]) for m in CHILDREN}
    return star_fanout(base, "pk", sides).withColumnRenamed("pk", "wanted_id")


def status_records(base: DataFrame) -> DataFrame:
    return base.select(F.col("status").alias("fbi_status"), "pk").distinct()


def classification_records(base: DataFrame) -> DataFrame:
    return base.select("person_classification", "pk").distinct()


def fbi_status_snapshot(stored: DataFrame | None, base: DataFrame, now: dt.datetime) -> DataFrame:
    return _snapshot(stored, status_records(base), ["fbi_status"], now)


def fbi_classification_snapshot(stored: DataFrame | None, base: DataFrame, now: dt.datetime) -> DataFrame:
    return _snapshot(stored, classification_records(base), ["person_classification"], now)


def _snapshot(stored: DataFrame | None, current: DataFrame, checked: list[str], now: dt.datetime) -> DataFrame:
    if stored is None:
        return history.first_snapshot(current, ["pk"], history.instant(now))
    return history.scd2_check(stored, current, ["pk"], checked, now)
