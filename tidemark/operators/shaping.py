"""From nested records to flat tables and child tables."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.keys import child_row_id, last_segment
from tidemark.functions.text import to_integer

NESTING = "__"


def snake_case(name: str) -> str:
    """``strGlass`` to ``str_glass``, ``DateTime`` to ``date_time``."""
    name = re.sub(r"[^0-9A-Za-z]+", "_", name.strip())
    name = re.sub(r"(?<=[A-Z])(?=[A-Z][a-z])", "_", name)
    name = re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", name)
    return name.lower()


def snake_case_columns(df: DataFrame) -> DataFrame:
    names = [snake_case(c) for c in df.columns]
    if len(set(names)) != len(names):
        raise ValueError(f"columns collide after renaming: {sorted(names)}")
    return df.toDF(*names)


def flatten_structs(df: DataFrame) -> DataFrame:
    """Nested fields as ``parent__child`` columns, at any depth; arrays stay."""

    def leaves(schema: T.StructType, path: str, prefix: str) -> list[Column]:
        found: list[Column] = []
        for field in schema.fields:
            at, name = f"{path}`{field.name}`", f"{prefix}{field.name}"
            if isinstance(field.dataType, T.StructType):
                found += leaves(field.dataType, f"{at}.", f"{name}{NESTING}")
            else:
                found.append(F.col(at).alias(name))
        return found

    return df.select(*leaves(df.schema, "", ""))


def explode_child(df: DataFrame, root_id: str, field: str) -> DataFrame:
    """The child table of an array column.

    Scalars give ``value``, structs their fields; then ``_dlt_list_idx``, ``_dlt_id``
    and ``_dlt_root_id``. Empty and NULL arrays give no rows.
    """
    element = df.schema[field].dataType.elementType
    exploded = df.select(F.col(root_id).alias("_dlt_root_id"), F.posexplode(field).alias("_position", "_item"))
    if isinstance(element, T.StructType):
        values = [F.col(f"_item.`{f.name}`").alias(f.name) for f in element.fields]
    else:
        values = [F.col("_item").alias("value")]
    index = F.col("_position").cast("bigint")
    return exploded.select(
        *values,
        index.alias("_dlt_list_idx"),
        child_row_id("_dlt_root_id", field, index).alias("_dlt_id"),
        F.col("_dlt_root_id"),
    )


def arrays_to_rows(df: DataFrame, keep: Sequence[str], arrays: Mapping[str, str | Column]) -> DataFrame:
    """Parallel arrays as rows; ``arrays`` maps each output column to its array.

    ``position`` is the index the values share.
    """
    zipped = F.arrays_zip(*[(F.col(a) if isinstance(a, str) else a).alias(n) for n, a in arrays.items()])
    rows = df.select(*keep, F.posexplode(zipped).alias("position", "_item"))
    return rows.select(*keep, F.col("position").cast("bigint").alias("position"), "_item.*")


def pluck_records(df: DataFrame, document: str, field: str, name: str) -> DataFrame:
    """One field of every record in the first list of records of a JSON document.

    Records without the field are skipped; a field that is null gives NULL.
    """
    entries = F.map_entries(F.from_json(document, "map<string,string>"))
    lists = F.filter(entries, lambda e: e["value"].startswith("["))
    items = F.transform(lists, lambda e: F.from_json(e["value"], "array<string>"))
    records = F.get(F.filter(items, lambda a: F.forall(a, lambda x: x.startswith("{"))), F.lit(0))
    parsed = F.transform(records, lambda x: F.from_json(x, "map<string,string>"))
    return (
        df.withColumn("_record", F.explode(parsed))
        .where(F.map_contains_key("_record", F.lit(field)))
        .withColumn(name, F.col("_record").getItem(field))
        .drop("_record")
    )


def stride_records(df: DataFrame, text: str, names: Sequence[str]) -> DataFrame:
    """Every ``len(names)`` lines of a text as one record, with its ``record_no``.

    Works inside the row, so files read as whole texts scale by file. Lines left
    over at the end form no record.
    """
    stride = len(names)
    kept = [c for c in df.columns if c != text]
    trimmed = F.btrim(text, F.lit(" \t\r\n\f"))
    one_break = F.replace(F.replace(trimmed, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    # A column of its own, or the lambda below would split the text once per record.
    split = df.select(*kept, F.split(one_break, "\n").alias("_lines"))
    lines = F.col("_lines")
    starts = F.when(F.size(lines) >= stride, F.sequence(F.lit(0), F.size(lines) - stride, F.lit(stride)))
    records = F.transform(starts, lambda i: F.struct(*[F.get(lines, i + k).alias(n) for k, n in enumerate(names)]))
    rows = split.select(*kept, F.posexplode(records).alias("_no", "_record"))
    return rows.select(*kept, F.col("_no").cast("bigint").alias("record_no"), "_record.*")


def element_set_records(df: DataFrame, text: str) -> DataFrame:
    """Three-line element sets: name, two data lines and the catalogue number in the first of them."""
    return element_set_columns(stride_records(df, text, ["satellite_name", "tle_line1", "tle_line2"]))


def element_set_columns(rows: DataFrame) -> DataFrame:
    """Records of three lines with a clean name and their catalogue number."""
    number = to_integer(F.substring("tle_line1", 3, 5), "bigint")
    return rows.withColumn("satellite_name", F.trim("satellite_name")).withColumn("satellite_id", number)


def subject_rows(df: DataFrame, key: str, subjects: str, prefix: str = "/works/") -> DataFrame:
    """(work_id, subject) for keys below ``prefix``; empty subjects are dropped."""
    return (
        df.where(F.col(key).startswith(prefix))
        .select(last_segment(key).alias("work_id"), F.explode(subjects).alias("subject"))
        .where(F.col("subject") != "")
    )
