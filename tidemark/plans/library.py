"""Books, their authors, languages and subjects."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.aggregates import group_size
from tidemark.operators.incremental import change_plan
from tidemark.operators.shaping import explode_child, subject_rows


def load_plan(found: DataFrame, previous: DataFrame, books: DataFrame) -> DataFrame:
    """Which topics to load, from (search_term, n) counts of search, last run and table."""
    return change_plan(found, previous, group_size(books, "search_term", "n"), "search_term", "growth")


def book_records(docs: DataFrame) -> DataFrame:
    """Search results as book records with lists of authors and languages.

    ``docs``: search_term, key, title, ebook_access, first_publish_year, has_fulltext,
    author_name and language arrays.
    """
    def with_key(column: str, name: str):
        return F.transform(
            F.coalesce(F.col(column), F.array().cast("array<string>")),
            lambda x: F.struct(x.alias(name), F.col("key").alias("book_key")),
        )

    return docs.select(
        "search_term",
        "key",
        "title",
        "ebook_access",
        "first_publish_year",
        F.coalesce("has_fulltext", F.lit(False)).alias("has_fulltext"),
        with_key("author_name", "name").alias("authors"),
        with_key("language", "code").alias("languages"),
    )


def child_tables(books: DataFrame) -> tuple[DataFrame, DataFrame]:
    """books__authors and books__languages."""
    return explode_child(books, "key", "authors"), explode_child(books, "key", "languages")


def base_openlibrary_books(books: DataFrame) -> DataFrame:
    return books.select(
        "search_term", F.col("key").alias("book_key"), "title", "ebook_access", "first_publish_year", "has_fulltext"
    )


def base_openlibrary_authors(authors: DataFrame) -> DataFrame:
    return authors.select(F.col("name").alias("author_name"), "book_key")


def base_openlibrary_languages(languages: DataFrame) -> DataFrame:
    return languages.select("code", "book_key")


def subjects(works: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(work_id, subject) once each, and the works that could not be read.

    ``works``: key, subjects array and error text.
    """
    rows = subject_rows(works.where(F.col("error").isNull()), "key", "subjects")
    failed = works.where(F.col("error").isNotNull()).select("key", "error")
    return rows.distinct(), failed
