"""File streams that run until the available input is used up.

Targets are stored tables. Each batch is one commit that carries the stream's own id and the batch number, so a batch
repeated after a failure adds nothing, and the batches of another stream are never mistaken for it. The commit also
names the input files it has used, so a stream that starts anew over an old target skips them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.joins import missing_rows
from tidemark.operators.loading import pick_per_key
from tidemark.sources.layouts import layout
from tidemark.sources.stored import StoredTable

SOURCE_FILE = "_source_file"


def file_stream(spark: SparkSession, path: str, ddl: str, pattern: str = "*.parquet", files_per_batch: int = 0) -> DataFrame:
    """Parquet files of a folder as a stream; ``pattern`` selects file names."""
    reader = spark.readStream.schema(layout(ddl)).option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def append_stream(stream: DataFrame, target: str, checkpoint: str) -> None:
    """Append every new row to the table ``target`` and stop when the input is used up."""
    commit_batches(stream, lambda batch, table: batch, target, checkpoint)


def new_keys_stream(stream: DataFrame, key: Column, name: str, order: list[str], target: str, checkpoint: str) -> None:
    """Keep the first row of each key never seen before.

    The keys seen are the stored table itself, joined in per batch, so no state
    grows in memory.
    """

    def unseen(batch: DataFrame, table: StoredTable) -> DataFrame:
        fresh = pick_per_key(batch.withColumn(name, key), [name], *[F.col(c) for c in order])
        return missing_rows(fresh, table.read(), [name]) if table.exists() else fresh

    commit_batches(stream, unseen, target, checkpoint)


def commit_batches(stream: DataFrame, rows: Callable[[DataFrame, StoredTable], DataFrame], target: str, checkpoint: str) -> None:
    """Append ``rows(batch, table)`` of each micro-batch to the table ``target``, exactly once.

    Input files are told apart by path and time of change. A stream that does not read files directly has none to tell,
    and then only its own batches are known again.
    """
    changed = F.col("_metadata.file_modification_time").cast("timestamp").cast("double").cast("string")
    try:
        stream = stream.withColumn(SOURCE_FILE, F.concat_ws("@", "_metadata.file_path", changed))
    except AnalysisException:
        stream = stream.withColumn(SOURCE_FILE, F.lit(None).cast("string"))

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        stream_id = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        table = StoredTable(spark, target)
        state = table.state()
        if state.batches.get(stream_id, -1) >= batch_id:
            return
        # one row for each input file of the batch
        used = {r[0] for r in batch.select(SOURCE_FILE).distinct().collect()} - {None}
        if known := used & state.sources:
            batch = batch.where(F.col(SOURCE_FILE).isNull() | ~F.col(SOURCE_FILE).isin(sorted(known)))
        table.append(rows(batch.drop(SOURCE_FILE), table), stream_id, batch_id, used - state.sources)

    run_batches(stream, handle, checkpoint)


def run_batches(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Apply a batch function to each micro-batch until the input is used up."""
    query = (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
