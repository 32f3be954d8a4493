"""Grouped counts, ranges, last values, distinctness and status roll-ups."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.keys import as_col

# The statuses loads report.
SUCCESS = "success"
FIRST_RUN = "firstrun"
SKIPPED = ("skipped", "skipped_no_new_data")
FAILED = "failed"


def grouped_count(
    df: DataFrame, group_cols: Sequence[str], count_col: str, alias: str = "num_records"
) -> DataFrame:
    """Non-null values of one column per group."""
    return df.groupBy(*group_cols).agg(F.count(count_col).alias(alias))


def group_size(df: DataFrame, key: str, alias: str = "count") -> DataFrame:
    """Rows per non-null key."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(alias))


def group_range(df: DataFrame, key: str, column: str, low: str, high: str) -> DataFrame:
    return df.groupBy(key).agg(F.min(column).alias(low), F.max(column).alias(high))


def dimension(df: DataFrame, *columns: str | Column) -> DataFrame:
    """The distinct combinations of some columns."""
    return df.select(*columns).distinct()


def last_values(df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The last non-null value of each column per key, found without sorting groups."""
    when = F.struct(*order)
    latest = [F.max_by(c, F.when(F.col(c).isNotNull(), when)).alias(c) for c in columns]
    return df.groupBy(*keys).agg(*latest)


def has_repeats(columns: Sequence[str | Column]) -> Column:
    """True when a row holds one non-null value in more than one of the columns.

    Of NULLs the distinct values keep one. No lambda is used, which Spark would interpret for every row with all that the columns mention.
    """
    values = F.array(*columns)
    filled = reduce(add, [F.get(values, F.lit(i)).isNotNull().cast("int") for i in range(len(columns))], F.lit(0))
    return F.size(F.array_distinct(values)) != filled + (filled < len(columns)).cast("int")


# The ways loads turn many statuses into one decision; see ``decision``.
RULES = ("any_success", "not_all_bad", "need_success")


def loaded_count(status: str | Column) -> Column:
    return F.count_if(as_col(status).isin(SUCCESS, FIRST_RUN))


def decision(status: str | Column, rule: str) -> Column:
    """Aggregate to ``load``, ``skip`` or ``error``.

    - ``any_success``: load on any success, skip when all skipped, else error;
    - ``not_all_bad``: skip when all skipped, error when all failed, else load;
    - ``need_success``: as above, but without any success skip.

    No status at all counts as skipped.
    """
    s = F.coalesce(as_col(status), F.lit(""))
    succeeded = F.coalesce(F.bool_or(s.isin(SUCCESS, FIRST_RUN)), F.lit(False))
    skipped = F.coalesce(F.bool_and(s.isin(*SKIPPED)), F.lit(True))
    failed = F.coalesce(F.bool_and(s == FAILED), F.lit(False))
    load, skip, error = F.lit("load"), F.lit("skip"), F.lit("error")
    decisions = {
        "any_success": F.when(succeeded, load).when(skipped, skip).otherwise(error),
        "not_all_bad": F.when(skipped, skip).when(failed, error).otherwise(load),
        "need_success": F.when(skipped, skip).when(failed, error).when(succeeded, load).otherwise(skip),
    }
    return decisions[rule]


def processed_total(counts: DataFrame, count: str) -> DataFrame:
    """One row: records processed over all extracts, and how many extracts had any."""
    return counts.agg(
        F.coalesce(F.sum(count), F.lit(0)).cast("bigint").alias("processed_records"),
        F.count_if(F.col(count) > 0).alias("n_extracts"),
    )
