"""Surrogate keys, composite keys, row ids and name clean-up."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The null marker and separator are part of every stored key.
NULL_MARKER = "_dbt_utils_surrogate_key_null_"
KEY_SEPARATOR = "-"


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(*cols: Column | str) -> Column:
    """MD5 over the text of each column, nulls marked so that they count.

    Cast floating-point columns to a decimal first: their text form differs
    between engines.
    """
    parts: list[Column] = []
    for c in cols:
        if parts:
            parts.append(F.lit(KEY_SEPARATOR))
        parts.append(F.coalesce(as_col(c).cast("string"), F.lit(NULL_MARKER)))
    return F.md5(F.concat(*parts))


def composite_key(first: Column | str, *rest: Column | str) -> Column:
    """``first|lower(a)|lower(b)``; a missing part becomes the empty string."""
    parts = [as_col(first).cast("string")]
    for c in rest:
        parts += [F.lit("|"), F.coalesce(F.lower(as_col(c)), F.lit(""))]
    return F.concat(*parts)


def child_row_id(root_id: Column | str, field: str, index: Column | str) -> Column:
    """Deterministic id of one list element, so reruns give the same rows."""
    return F.md5(F.concat_ws("|", as_col(root_id).cast("string"), F.lit(field), as_col(index).cast("string")))


def scd_row_id(keys: list[Column | str], updated_at: Column) -> Column:
    """Id of one history row: MD5 over key text and change time."""
    parts = [F.coalesce(as_col(k).cast("string"), F.lit("")) for k in keys]
    parts.append(F.coalesce(updated_at.cast("string"), F.lit("")))
    return F.md5(F.concat_ws("|", *parts))


def sanitize_name(c: Column | str) -> Column:
    """Drop white space and non-ASCII characters, then ``_`` for anything but word characters, ``-`` and ``.``."""
    kept = F.regexp_replace(as_col(c), r"[\s\x1c-\x1f]+|[^\x00-\x7F]+", "")
    return F.regexp_replace(kept, r"[^A-Za-z0-9_\-.]", "_")


def last_segment(c: Column | str, separator: str = "/") -> Column:
    return F.substring_index(as_col(c), separator, -1)


def all_true(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def any_true(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)
