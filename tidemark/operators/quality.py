"""Data-quality checks.

Each check returns the failing rows; none means it passes. ``run_checks`` counts
them, reading a table once for all its row-level checks.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.keys import all_true
from tidemark.operators.aggregates import has_repeats
from tidemark.operators.history import instant
from tidemark.operators.joins import lookup_join
from tidemark.operators.relations import inline_rows


def null_in(column: str) -> Column:
    return F.col(column).isNull()


def outside(column: str, low: float, high: float, strictly: bool = False) -> Column:
    """Out of range; NULL passes."""
    c = F.col(column)
    return ~((c > low) & (c < high)) if strictly else ~c.between(low, high)


def not_true(expression: Column | str) -> Column:
    """The expression is false or unknown."""
    e = F.expr(expression) if isinstance(expression, str) else expression
    return ~F.coalesce(e, F.lit(False))


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(null_in(column))


def unique(df: DataFrame, column: str) -> DataFrame:
    """Non-null values that occur more than once."""
    counts = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("unique_field"))
    return counts.agg(F.count(F.lit(1)).alias("n_records")).where(F.col("n_records") > 1)


def unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Tuples that occur more than once; NULLs are equal to each other."""
    counts = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_records"))
    return counts.where(F.col("n_records") > 1)


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Distinct values outside the list, with their row count; NULL passes."""
    bad = df.where(~F.col(column).isin(*values)).groupBy(F.col(column).alias("value_field"))
    return bad.agg(F.count(F.lit(1)).alias("n_records"))


def relationships(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Non-null child keys without a parent, one row per child row."""
    keys = child.where(F.col(column).isNotNull()).select(F.col(column).alias("from_field"))
    parents = parent.select(F.col(field).alias("to_field")).where("to_field is not null").distinct()
    return lookup_join(keys, parents, [("from_field", "to_field")], "left_anti")


def between(df: DataFrame, column: str, low: float, high: float, strictly: bool = False) -> DataFrame:
    return df.where(outside(column, low, high, strictly))


def expression_is_true(df: DataFrame, expression: Column | str) -> DataFrame:
    return df.where(not_true(expression))


def row_distinct(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows that hold one value in two of the columns."""
    return df.where(has_repeats(columns))


def freshness(df: DataFrame, loaded_at: str, now: dt.datetime, warn_days: int, error_days: int) -> DataFrame:
    """One row: newest load time, age in days and ``pass``, ``warn`` or ``error``."""
    newest = F.max(loaded_at)
    status = (
        F.when(newest.isNull() | (newest < instant(now - dt.timedelta(days=error_days))), F.lit("error"))
        .when(newest < instant(now - dt.timedelta(days=warn_days)), F.lit("warn"))
        .otherwise(F.lit("pass"))
    )
    age = F.datediff(F.lit(now.date()), newest).cast("bigint")
    return df.agg(newest.alias("max_loaded_at"), age.alias("age_days"), status.alias("status"))


def schema_contract(df: DataFrame, expected: T.StructType) -> DataFrame:
    """Columns that are missing, extra or of another type than the contract."""
    want = {f.name.lower(): f.dataType.simpleString() for f in expected.fields}
    have = {f.name.lower(): f.dataType.simpleString() for f in df.schema.fields}
    diff = [
        (name, want.get(name), have.get(name))
        for name in sorted(want.keys() | have.keys())
        if want.get(name) != have.get(name)
    ]
    return inline_rows(df.sparkSession, diff, "column_name string, expected_type string, actual_type string")


@dataclass(frozen=True)
class RowCheck:
    """A check that looks at one row at a time: ``fails`` is the failing condition."""

    name: str
    fails: Column
    severity: str = "error"


@dataclass(frozen=True)
class TableCheck:
    """A check given by its failing rows."""

    name: str
    failing: DataFrame
    severity: str = "error"


@dataclass(frozen=True)
class UniqueCheck:
    """No value or tuple of ``columns`` occurs twice. NULLs are equal to each other, or else (``ignore_nulls``) not looked at."""

    name: str
    columns: tuple[str, ...]
    severity: str = "error"
    ignore_nulls: bool = False


def repeated_keys(df: DataFrame, checks: Sequence[UniqueCheck]) -> DataFrame:
    """(check_name, severity, failures) of many uniqueness checks, from one scan and one shuffle.

    Each row is expanded once for each set of columns, equal keys are counted before the shuffle, and all sets travel together.
    """
    columns = list(dict.fromkeys(c for check in checks for c in check.columns))
    sets = list(dict.fromkeys(tuple(c for c in columns if c in check.columns) for check in checks))
    keys = df.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(columns)])
    named = {c: f"_k{i}" for i, c in enumerate(columns)}
    counts = keys.groupingSets([[F.col(named[c]) for c in one] for one in sets], *[F.col(named[c]) for c in columns])
    counts = counts.agg(F.grouping_id().alias("_set"), F.count(F.lit(1)).alias("_n")).where("_n > 1")

    def fails(check: UniqueCheck) -> Column:
        number = sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in check.columns)
        found = F.col("_set") == number
        return found & all_true([F.col(named[c]).isNotNull() for c in check.columns]) if check.ignore_nulls else found

    failures = counts.agg(*[F.count_if(fails(c)).alias(f"_c{i}") for i, c in enumerate(checks)])
    return _results(failures, checks)


def _results(counts: DataFrame, checks: Sequence) -> DataFrame:
    """One row of counts ``_c0``, ``_c1``, ... as a row for each check."""
    fields = [F.struct(F.lit(c.name).alias("check_name"), F.lit(c.severity).alias("severity"), F.col(f"_c{i}").alias("failures")) for i, c in enumerate(checks)]
    return counts.select(F.inline(F.array(*fields)))


def run_checks(
    df: DataFrame, row_checks: Sequence[RowCheck] = (), table_checks: Sequence[TableCheck] = (), unique_checks: Sequence[UniqueCheck] = ()
) -> DataFrame:
    """(check_name, severity, failures) for all checks; row checks share one scan, uniqueness checks one scan and shuffle."""
    parts = []
    if row_checks:
        counts = df.agg(
            *[F.count_if(F.coalesce(c.fails, F.lit(False))).alias(f"_c{i}") for i, c in enumerate(row_checks)]
        )
        parts.append(_results(counts, row_checks))
    if unique_checks:
        parts.append(repeated_keys(df, unique_checks))
    for check in table_checks:
        counted = check.failing.agg(F.count(F.lit(1)).alias("failures"))
        parts.append(
            counted.select(F.lit(check.name).alias("check_name"), F.lit(check.severity).alias("severity"), "failures")
        )
    return reduce(DataFrame.unionByName, parts)
