"""Unions, unpivots, key sets and inline relations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by position, as in SQL."""
    return reduce(DataFrame.union, frames)


def union_tagged(extracts: Mapping[str, DataFrame], tag: str) -> DataFrame:
    """All extracts together, each row tagged with the value it was requested for."""
    tagged = [df.withColumn(tag, F.lit(value)) for value, df in extracts.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def combine_extracts(
    spark: SparkSession, extracts: Mapping[str, DataFrame | None], tag: str
) -> tuple[DataFrame | None, DataFrame]:
    """Union of the extracts that worked, and the names of those that failed (None)."""
    good = {name: df for name, df in extracts.items() if df is not None}
    failed = [(name,) for name, df in extracts.items() if df is None]
    return (union_tagged(good, tag) if good else None), inline_rows(spark, failed, f"{tag} string")


def columns_to_rows(df: DataFrame, keys: Sequence[str], columns: Sequence[str], name: str, value: str) -> DataFrame:
    """One row per input row and column, NULLs included."""
    return df.unpivot(list(keys), list(columns), name, value)


def union_keys(known: DataFrame, new: DataFrame) -> DataFrame:
    """Set union of two key tables with one layout."""
    return known.unionByName(new).distinct()


def inline_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A VALUES relation: part of the plan, so its size is known when joins are chosen."""
    if not rows:
        return spark.createDataFrame([], schema)
    names = T.StructType.fromDDL(schema).names
    table = pa.table({name: pa.array(column) for name, column in zip(names, zip(*rows))})
    return spark.createDataFrame(table, schema)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table_name, row_count); for Parquet files the counts come from the footers."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return union_all(counts)


def describe_columns(df: DataFrame) -> DataFrame:
    """Column name, type and position of a relation."""
    rows = [(f.name, f.dataType.simpleString(), i) for i, f in enumerate(df.schema.fields)]
    return inline_rows(df.sparkSession, rows, "column_name string, column_type string, position int")
