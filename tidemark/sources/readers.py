"""Reading tables, JSON records and text records."""

from __future__ import annotations

import datetime as dt
import os
import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.shaping import element_set_columns
from tidemark.sources.layouts import BENCH_TABLES, layout, source_layout


class Tables:
    """The measured tables of one folder: ``tables("orders")``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __call__(self, name: str) -> DataFrame:
        path = os.path.join(self.folder, f"{name}.parquet")
        return self.spark.read.schema(layout(BENCH_TABLES[name])).parquet(path)

    def sql(self, text: str) -> DataFrame:
        """A query that names tables in braces: ``SELECT * FROM {orders}``."""
        used = set(re.findall(r"\{(\w+)\}", text))
        return self.spark.sql(text, **{name: self(name) for name in used})


def read_source(spark: SparkSession, root: str, source: str, table: str) -> DataFrame:
    """A declared source table stored below ``root`` as ``source/table``."""
    return spark.read.schema(source_layout(source, table)).parquet(os.path.join(root, source, table))


def read_json_records(spark: SparkSession, path: str, ddl: str, multiline: bool = False) -> DataFrame:
    """Raw JSON records with a declared nested layout; fields not declared are ignored."""
    return spark.read.schema(layout(ddl)).option("multiLine", str(multiline).lower()).json(path)


def read_numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``file, line_no, line`` of text files, numbered from 0; a large file is read by several tasks.

    Lines are counted per split of a file, and the counts of earlier splits are added up, so a line's number is
    that of its split plus its place in it. Rows of a split lie together in one task, in their order.
    """
    split = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_start")]
    lines = spark.read.text(path).select(*split, F.monotonically_increasing_id().alias("_id"), F.col("value").alias("line"))
    before = Window.partitionBy("file").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    # one row for each split
    splits = lines.groupBy("file", "_start").agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_first"))
    splits = splits.select("file", "_start", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_offset"))
    return lines.join(splits, ["file", "_start"]).select("file", (F.col("_id") + F.col("_offset")).alias("line_no"), "line")


def read_element_sets(spark: SparkSession, path: str) -> DataFrame:
    """Three-line element sets from a folder of text files, whose lines are numbered by split.

    White space around a file's text does not count: records start at its first line with text, and lines
    left over at the end form no record.
    """
    blank = F.lit(" \t\r\n\f")
    lines = read_numbered_lines(spark, path)
    filled = lines.where(F.btrim("line", blank) != "")
    ends = filled.groupBy(F.col("file").alias("_file")).agg(F.min("line_no").alias("_first"), F.max("line_no").alias("_last"))
    inside = lines.join(ends, F.col("file") == F.col("_file")).where("line_no BETWEEN _first AND _last")
    text = F.when(F.col("line_no") == F.col("_first"), F.ltrim("line", blank)).otherwise(F.col("line"))
    text = F.when(F.col("line_no") == F.col("_last"), F.rtrim(text, blank)).otherwise(text)
    placed = inside.select("file", F.expr("(line_no - _first) DIV 3").alias("record_no"), ((F.col("line_no") - F.col("_first")) % 3).alias("_k"), text.alias("line"))
    names = ["satellite_name", "tle_line1", "tle_line2"]
    records = placed.groupBy("file", "record_no").agg(F.count(F.lit(1)).alias("_n"), *[F.max(F.when(F.col("_k") == k, F.col("line"))).alias(n) for k, n in enumerate(names)])
    return element_set_columns(records.where("_n = 3").select("file", "record_no", *names))


def read_fresh_json(spark: SparkSession, path: str, ddl: str, as_of: dt.datetime, hours: int = 72) -> DataFrame:
    """Records of the files changed within the time limit before ``as_of`` (UTC)."""
    oldest = F.timestamp_seconds(F.lit((as_of.replace(tzinfo=dt.timezone.utc) - dt.timedelta(hours=hours)).timestamp()))
    records = spark.read.schema(layout(ddl)).json(path)
    return records.where(F.col("_metadata.file_modification_time") > oldest)
