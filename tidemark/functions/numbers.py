"""Rounding, distances and tolerances."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.keys import all_true, as_col

DEFAULT_TOLERANCE = 1e-6

# Doubles at and beyond 2^52 have no fraction left to round.
_WHOLE_FROM = float(2**52)


def round_ieee(c: Column | str, digits: int = 2) -> Column:
    """Round half away from zero on the binary value of a double.

    Spark's ``round`` works on the shortest decimal text instead, which gives
    another result for values such as 1.005.
    """
    x, scale = as_col(c).cast("double"), float(10**digits)
    scaled = F.abs(x) * F.lit(scale)
    whole = F.floor(scaled).cast("double")
    rounded = F.signum(x) * (whole + F.when(scaled - whole >= 0.5, 1.0).otherwise(0.0)) / F.lit(scale)
    return F.when(scaled >= _WHOLE_FROM, x).otherwise(rounded)


def distance(pairs: Sequence[tuple[Column | str, Column | str]]) -> Column:
    """Euclidean distance over (now, before) coordinate pairs; NULL if any is NULL."""
    squares = [(as_col(a) - as_col(b)) * (as_col(a) - as_col(b)) for a, b in pairs]
    total = squares[0]
    for square in squares[1:]:
        total = total + square
    return F.sqrt(total)


def vector_distance(a: Column | str, b: Column | str) -> Column:
    """Euclidean distance between two equally long arrays."""
    squares = F.zip_with(
        as_col(a),
        as_col(b),
        lambda x, y: (x.cast("double") - y.cast("double")) * (x.cast("double") - y.cast("double")),
    )
    return F.sqrt(F.aggregate(squares, F.lit(0.0), lambda total, x: total + x))


def within_tolerance(
    pairs: Sequence[tuple[Column | str, Column | str]], tolerance: float = DEFAULT_TOLERANCE
) -> Column:
    """True when every pair differs by less than ``tolerance``."""
    return all_true([F.abs(as_col(a) - as_col(b)) < tolerance for a, b in pairs])


def pages_needed(count: Column | str, page_size: int) -> Column:
    """Whole pages that hold ``count`` records."""
    return F.floor((as_col(count) + F.lit(page_size - 1)) / F.lit(page_size)).cast("bigint")
