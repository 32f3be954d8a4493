"""University records: one extract per country, replaced as a whole."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.aggregates import processed_total
from tidemark.operators.relations import combine_extracts


def load(spark: SparkSession, extracts: Mapping[str, DataFrame | None]) -> tuple[DataFrame | None, DataFrame, DataFrame | None]:
    """(all records, failed countries, processed totals); None where every extract failed."""
    rows, failed = combine_extracts(spark, extracts, "requested_country")
    if rows is None:
        return None, failed, None
    counts = rows.groupBy("requested_country").agg(F.count(F.lit(1)).alias("n"))
    return rows.drop("requested_country"), failed, processed_total(counts, "n")
