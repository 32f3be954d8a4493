"""Rule-based classification and text extraction."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.keys import any_true, as_col, last_segment


def first_match(rules: Sequence[tuple[str, Column]], default: str) -> Column:
    """Label of the first condition that holds; rule order is significant."""
    (label, condition), *rest = rules
    chain = F.when(condition, F.lit(label))
    for label, condition in rest:
        chain = chain.when(condition, F.lit(label))
    return chain.otherwise(F.lit(default))


def classify_regex(c: Column | str, rules: Sequence[tuple[str, str]], default: str = "Other") -> Column:
    """First case-insensitive pattern found anywhere in the text wins."""
    text = as_col(c)
    return first_match([(label, text.rlike(f"(?i){pattern}")) for label, pattern in rules], default)


def classify_like(c: Column | str, rules: Sequence[tuple[str, Sequence[str]]], default: str = "Other") -> Column:
    """First label with any matching case-insensitive LIKE pattern wins."""
    text = as_col(c)
    return first_match([(label, any_true([text.ilike(p) for p in patterns])) for label, patterns in rules], default)


def classify_members(c: Column | str, rules: Sequence[tuple[str, Sequence[str]]], default: str = "Unknown") -> Column:
    """First label whose lower-case word list holds the value wins."""
    text = F.lower(as_col(c))
    return first_match([(label, text.isin(*words)) for label, words in rules], default)


def to_integer(c: Column | str, to: str = "int") -> Column:
    """Whole number in a text, else NULL.

    The pattern comes first because a failed cast costs an exception per row.
    """
    text = as_col(c)
    return F.when(text.rlike(r"^\s*[+-]?\d+\s*$"), text.try_cast(to))


def numeric_tail(c: Column | str, to: str = "int") -> Column:
    """Number after the last slash, or the whole text if that is a number; else NULL."""
    text = as_col(c)
    tail = last_segment(text)
    return F.when(tail.rlike(r"^\d+$"), tail.try_cast(to)).otherwise(to_integer(text, to))


def code_part(c: Column | str, start: int, length: int) -> Column:
    """Fixed-position digits of a code such as ``S01E02`` as an integer."""
    return F.substring(as_col(c), start, length).cast("int")


def first_filled(*cols: Column | str) -> Column:
    """First value that is neither NULL nor the empty string, else the last value."""
    head = [F.nullif(as_col(c), F.lit("")) for c in cols[:-1]]
    return F.coalesce(*head, as_col(cols[-1]))


def is_filled(c: Column | str) -> Column:
    text = as_col(c)
    return text.isNotNull() & (text != "")
