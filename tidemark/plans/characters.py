"""Series characters, episodes and locations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import parse_long_date, to_zone
from tidemark.functions.text import classify_like, classify_members, classify_regex, code_part, first_match, numeric_tail
from tidemark.operators.joins import aggregate_lookup
from tidemark.operators.ordering import ordered

# The classification rules, in the order they apply.
CHARACTER_GROUPS = [
    ("Rick", r"^Rick\b"),
    ("Morty", r"^Morty\b"),
    ("Summer", r"^Summer\b"),
    ("Beth", r"^Beth\b"),
    ("Jerry", r"^Jerry\b"),
]
EPISODE_FIRST = [
    ("Rick-Focused", ["%ricklantis%", "%rickmurai%", "%pickle rick%", "%rickternal%"]),
    ("Morty-Focused", ["%morty%", "%mort%"]),
    ("Interdimensional Cable", ["%interdimensional cable%", "%rixty minutes%"]),
    # The label for names with both words cannot apply: the second rule takes them first.
    ("Pop Culture Reference", ["%park%", "%shaym%", "%recall%", "%galactica%", "%jack%", "%tomorty%", "%spotless%"]),
]
LOCATION_TYPES = [
    ("Celestial Body", ["planet", "asteroid", "quasar", "mount", "elemental rings", "dwarf planet (celestial dwarf)"]),
    (
        "Artificial World",
        ["teenyverse", "miniverse", "microverse", "diegesis", "non-diegetic alternative reality", "box", "machine"],
    ),
    ("Virtual/Simulated", ["game", "dream", "memory", "tv", "consciousness", "nightmare", "fantasy town"]),
    (
        "Location Type",
        ["space station", "resort", "spa", "base", "police department", "customs", "daycare", "spacecraft", "arcade"],
    ),
    ("Abstract Realm", ["hell", "reality", "liquid", "death star", "artificially generated world"]),
    ("Social Structure", ["country", "cluster", "menagerie", "convention"]),
    ("Quadrant/Zone", ["quadrant"]),
]
THEMES = [
    "Magic", "Fantasy", "Post-Apocalyptic", "Merged", "Evil Rick", "Testicle", "Eric Stoltz", "Wasp", "Phone",
    "Spider", "Pizza", "Chair", "Tusk", "Cromulon",
]
NAMED_DIMENSIONS = ["Replacement", "Cronenberg"]


def dimension_group(column: str):
    name = F.col(column)

    def mentions(words):
        found = name.ilike(f"%{words[0]}%")
        for word in words[1:]:
            found = found | name.ilike(f"%{word}%")
        return found

    rules = [
        ("Unclassified", name.ilike("%unknown%")),
        ("Standard Format", F.lower(name).like("dimension c%")),
        ("Fascist Variant", name.ilike("%Fascist%")),
        ("Thematic", mentions(THEMES)),
        ("Canonical Named", mentions(NAMED_DIMENSIONS)),
    ]
    return first_match(rules, "Other")


def base_rm_characters(character: DataFrame) -> DataFrame:
    return character.select(
        F.col("id").alias("character_id"),
        F.col("name").alias("character_name"),
        F.col("status").alias("character_status"),
        F.col("species").alias("character_species"),
        F.col("gender").alias("character_gender"),
        F.col("origin__name").alias("character_origin"),
        F.col("location__name").alias("character_first_location"),
        F.col("location__url").alias("character_first_location_url"),
        F.col("image").alias("character_image"),
        F.col("url").alias("character_url"),
        F.col("_dlt_id").alias("character_dlt_id"),
        to_zone("created").alias("character_created"),
    )


def base_rm_episodes(episode: DataFrame) -> DataFrame:
    return episode.select(
        F.col("id").alias("episode_id"),
        F.col("name").alias("episode_name"),
        "episode",
        F.col("url").alias("episode_url"),
        F.col("_dlt_id").alias("episode_dlt_id"),
        parse_long_date("air_date").alias("episode_air_date"),
        to_zone("created").alias("episode_created"),
    )


def base_rm_locations(location: DataFrame) -> DataFrame:
    return location.select(
        F.col("id").alias("location_id"),
        F.col("name").alias("location_name"),
        F.col("type").alias("location_type"),
        F.col("dimension").alias("location_dimension"),
        F.col("url").alias("location_url"),
        to_zone("created").alias("location_created"),
        F.col("_dlt_id").alias("location_dlt_id"),
    )


def link_table(links: DataFrame, owner: str, target: str) -> DataFrame:
    """(owner row id, number at the end of the linked URL)."""
    return links.select(F.col("_dlt_root_id").alias(owner), numeric_tail("value").alias(target))


def base_rm_character_episode(links: DataFrame) -> DataFrame:
    return link_table(links, "character_dlt_id", "episode_id")


def base_rm_episode_character(links: DataFrame) -> DataFrame:
    return link_table(links, "episode_dlt_id", "character_id")


def base_rm_location_residents(links: DataFrame) -> DataFrame:
    return link_table(links, "location_dlt_id", "character_id")


def staging_rm_characters(base: DataFrame, character_episode: DataFrame) -> DataFrame:
    counted = F.count("episode_id").alias("num_episodes")
    joined = aggregate_lookup(base, character_episode, "character_dlt_id", "character_dlt_id", counted)
    rows = joined.select(
        "character_id",
        "character_name",
        "character_status",
        "character_species",
        "character_gender",
        "character_origin",
        "character_image",
        "character_created",
        "character_dlt_id",
        "num_episodes",
        classify_regex("character_name", CHARACTER_GROUPS).alias("character_group"),
    )
    return ordered(rows, "character_id")


def staging_rm_episodes(base: DataFrame, episode_character: DataFrame) -> DataFrame:
    counted = F.count("character_id").alias("num_characters")
    joined = aggregate_lookup(base, episode_character, "episode_dlt_id", "episode_dlt_id", counted)
    return joined.select(
        "episode_id",
        "episode_name",
        "episode_air_date",
        "episode",
        "episode_dlt_id",
        "num_characters",
        classify_like("episode_name", EPISODE_FIRST).alias("episode_group"),
        code_part("episode", 2, 2).alias("season_num"),
        code_part("episode", 5, 2).alias("episode_num"),
    )


def staging_rm_locations(base: DataFrame, location_residents: DataFrame) -> DataFrame:
    counted = F.count("character_id").alias("num_characters")
    joined = aggregate_lookup(base, location_residents, "location_dlt_id", "location_dlt_id", counted)
    return joined.select(
        "location_id",
        "location_name",
        "location_type",
        "location_dimension",
        "location_created",
        "location_dlt_id",
        "num_characters",
        classify_members("location_type", LOCATION_TYPES).alias("location_categories"),
        dimension_group("location_dimension").alias("dimension_group"),
    )
