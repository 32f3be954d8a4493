"""Reading, staging and small helpers that the operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import new_shared_path, shuffle_partitions

SPACE = r"\x20\x09-\x0D"
WORD = rf"[^{SPACE}]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back, which cuts its lineage.

    A lost executor then costs only the tasks it ran: later jobs read the written files.
    """
    path = new_shared_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def parts(df: DataFrame, at_least: int = 1) -> int:
    """Shuffle partitions to use: the session's setting, which the user sizes to the input."""
    return max(at_least, shuffle_partitions(df.sparkSession))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def crc_fold(doc_id: Column, n: int = 5) -> Column:
    """crc32 of the id's text modulo ``n``; a null id falls into fold 0 of the empty text."""
    return F.pmod(F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")), F.lit(n)).cast("int")


def id_text(docs: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    """Only the id as ``doc_id`` and the text as ``text`` (null: empty), so other columns never clash."""
    return docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"), *more
    )


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most`` bytes of ``column``; one long text stands alone."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start = total = 0
        for i, n in enumerate(sizes):
            if i > start and total + n > most:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += n
        if start < batch.num_rows:
            yield batch.slice(start)


def key_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The rows of each value of the integer columns ``keys``; rows of one value must follow each other.

    Many small groups come out of one batch, which costs less than a call by Spark for each.
    """
    pending: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        values = np.stack([batch.column(k).to_numpy() for k in keys])
        cuts = np.flatnonzero((values[:, 1:] != values[:, :-1]).any(axis=0)) + 1
        if pending and any(pending[-1].column(k)[-1] != batch.column(k)[0] for k in keys):
            yield pa.Table.from_batches(pending)
            pending = []
        for start, end in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            pending.append(batch.slice(start, end - start))
            if end < batch.num_rows:
                yield pa.Table.from_batches(pending)
                pending = []
    if pending:
        yield pa.Table.from_batches(pending)
