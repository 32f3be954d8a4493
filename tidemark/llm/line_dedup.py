"""Lines that repeat across documents, found by range-partitioned line hashes.

Hashes are range-partitioned with document and position as further keys, so one frequent line spreads over
as many tasks as it fills. Each task streams its sorted rows and decides every line whose rows it holds
whole; the first and last line of a task may go on next door and are settled by a grouped count. The
result is a compressed bitmap of kept lines for each document, not text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ascii_lower, id_text, parts, slices, stage

LEAST_CHARS, LEAST_DOCS = 20, 3
_STRIP = " \t\n\x0b\x0c\r"


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(_STRIP)))


def text_digest(text: Column) -> Column:
    """Tells apart documents of one id."""
    return F.xxhash64(text)


def line_rows(docs: DataFrame) -> DataFrame:
    """``h1, h2, doc_id, digest, at`` for every line long enough to count; ``at`` is the line's place."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lower = {c: c + 32 for c in range(65, 91)}
        for batch in slices(batches, "text"):
            keys, owner, at = [], [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                for k, line in enumerate(text.split("\n")):
                    line = line.strip(_STRIP)
                    if len(line) >= LEAST_CHARS:
                        keys.append(xxhash.xxh3_128_digest(line.translate(lower)))
                        owner.append(i)
                        at.append(k)
            owner = pa.array(owner, pa.int64())
            halves = np.frombuffer(b"".join(keys), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(halves[:, 0]), pa.array(halves[:, 1]), batch.column("doc_id").take(owner), batch.column("digest").take(owner), pa.array(at, pa.int32())],
                ["h1", "h2", "doc_id", "digest", "at"],
            )

    return docs.mapInArrow(rows, "h1 long, h2 long, doc_id long, digest long, at int")


def boundaries(batch: pa.RecordBatch, columns: list[str]) -> np.ndarray:
    """Where a row differs from the one before in any column; the first row counts as different."""
    new = np.zeros(batch.num_rows, bool)
    new[:1] = True
    for name in columns:
        values = batch.column(name)
        if isinstance(values, pa.ChunkedArray):
            values = values.combine_chunks()
        for x in (values.is_null().to_numpy(zero_copy_only=False), values.fill_null(0).to_numpy(zero_copy_only=False)):
            new[1:] |= x[1:] != x[:-1]
    return new


def repeats(rows: pa.Table) -> pa.Table:
    """Of whole lines in order: the rows to drop, those beyond the first document of a line with enough of them."""
    line_starts = boundaries(rows, ["h1", "h2"])
    next_doc = boundaries(rows, ["doc_id"]) & ~line_starts
    begins = np.flatnonzero(line_starts)
    line = np.cumsum(line_starts) - 1
    nth = np.cumsum(next_doc)
    nth = nth - nth[begins][line]
    most = np.maximum.reduceat(nth, begins)
    return rows.filter(pa.array((nth > 0) & (most[line] >= LEAST_DOCS - 1)))


def stream_first_occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by line, document (largest first, null last) and position: the rows to drop.

    The task's first and last line may go on in another task: their rows come out whole, marked open.
    """

    def out(rows: list[pa.RecordBatch], is_open: bool) -> list[pa.RecordBatch]:
        whole = pa.Table.from_batches(rows)
        if whole.num_rows and not is_open:
            whole = repeats(whole)
        return whole.append_column("open", pa.array(np.full(whole.num_rows, is_open))).to_batches()

    line, last_open, held = None, False, []
    for batch in batches:
        if not batch.num_rows:
            continue
        new = boundaries(batch, ["h1", "h2"])
        ends = [(batch.column("h1")[i].as_py(), batch.column("h2")[i].as_py()) for i in (0, -1)]
        new[0] = ends[0] != line
        begins = np.flatnonzero(new).tolist()
        head = batch.slice(0, begins[0] if begins else batch.num_rows)
        if head.num_rows and last_open:
            yield from out([head], True)
        elif head.num_rows:
            held.append(head)
        if begins:
            if held:
                yield from out(held, False)
            held = []
            if line is None:
                stop = begins[1] if len(begins) > 1 else batch.num_rows
                yield from out([batch.slice(0, stop)], True)
                last_open = len(begins) == 1
                begins = begins[1:]
            else:
                last_open = False
            if begins:
                yield from out([batch.slice(begins[0], begins[-1] - begins[0])], False)
                held = [batch.slice(begins[-1])]
        line = ends[1]
    if held:
        yield from out(held, True)


def keep_bitmaps(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, digest, n_dropped, bitmap`` of each document that loses lines.

    ``bitmap``: zlib-compressed bits, one per line, 1 for kept; lines beyond its end are kept. ``digest``
    (xxhash64 of the text) tells apart documents of one id; they count as one document. A null id is the
    smallest document. A line of at least 20 characters (stripped, lower-cased) found in at least 3 documents
    stays only in the largest of them. Null and empty texts have one empty line and lose nothing.
    """
    texts = id_text(docs, id_col, text_col).withColumn("digest", text_digest(F.col("text")))
    order = [F.col("h1"), F.col("h2"), F.col("doc_id").desc_nulls_last(), F.col("digest"), F.col("at")]
    rows = line_rows(texts).repartitionByRange(parts(docs), *order).sortWithinPartitions(*order)
    found = stage(rows.mapInArrow(stream_first_occurrences, "h1 long, h2 long, doc_id long, digest long, at int, open boolean"), "line-repeats")
    opened = found.where("open")
    documents = F.count_distinct(F.struct(F.col("doc_id").isNull(), F.coalesce("doc_id", F.lit(0))))
    # at most two lines for each range
    settled = opened.groupBy("h1", "h2").agg(F.max("doc_id").alias("top"), documents.alias("n")).where(F.col("n") >= LEAST_DOCS)
    late = opened.join(F.broadcast(settled), ["h1", "h2"]).where(~F.col("doc_id").eqNullSafe(F.col("top")))
    drops = found.where("NOT open").select("doc_id", "digest", "at").unionByName(late.select("doc_id", "digest", "at"))
    drops = drops.groupBy("doc_id", "digest").agg(F.collect_set("at").alias("at"))

    def packed(places: pd.Series) -> pd.Series:
        def one(at: np.ndarray) -> bytes:
            bits = np.ones((int(at.max()) // 8 + 1) * 8, np.uint8)
            bits[at] = 0
            return zlib.compress(np.packbits(bits).tobytes())

        return places.map(one)

    return drops.select("doc_id", "digest", F.size("at").cast("long").alias("n_dropped"), F.pandas_udf(packed, "binary")("at").alias("bitmap"))


def kept_text(text: str, bitmap: bytes | None) -> str:
    """The text's lines that a bitmap keeps."""
    if bitmap is None:
        return text
    lines = text.split("\n")
    bits = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8))
    return "\n".join(line for k, line in enumerate(lines) if k >= len(bits) or bits[k])


def with_bitmaps(docs: DataFrame, bitmaps: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The documents' columns as struct ``row``, their text (null: empty) and bitmap."""
    d = docs.select(F.struct("*").alias("row"))
    d = d.select("row", F.coalesce(F.col("row").getField(text_col), F.lit("")).alias("text"), F.col("row").getField(id_col).cast("long").alias("i"))
    d = d.withColumn("d", text_digest(F.col("text")))
    b = bitmaps.hint("shuffle_hash")
    return d.join(b, d["i"].eqNullSafe(b["doc_id"]) & (d["d"] == b["digest"]), "left").select(
        "row", "text", "bitmap", F.coalesce("n_dropped", F.lit(0)).alias("n_dropped")
    )


def apply_bitmap(text: str, bitmap: str) -> Column:
    def kept(texts: pd.Series, bitmaps: pd.Series) -> pd.Series:
        return pd.Series([kept_text(t, b) for t, b in zip(texts, bitmaps, strict=True)], dtype=object)

    return F.pandas_udf(kept, "string")(text, bitmap)


def drop_lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The documents, other columns as they were, with their repeated lines gone."""
    rows = with_bitmaps(docs, keep_bitmaps(docs, id_col, text_col), id_col, text_col)
    new = F.when(F.col("bitmap").isNull(), F.col("row").getField(text_col)).otherwise(apply_bitmap("text", "bitmap"))
    return rows.select(*[(new if c == text_col else F.col("row").getField(c)).alias(c) for c in docs.columns])


def line_report(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Per document ``doc_id, n_lines, n_dropped, kept_sha256``."""
    rows = with_bitmaps(docs, keep_bitmaps(docs, id_col, text_col), id_col, text_col)
    n_lines = F.octet_length("text") - F.octet_length(F.translate("text", "\n", "")) + 1
    kept = F.when(F.col("bitmap").isNull(), F.col("text")).otherwise(apply_bitmap("text", "bitmap"))
    return rows.select(
        F.col("row").getField(id_col).cast("long").alias("doc_id"),
        n_lines.cast("long").alias("n_lines"),
        "n_dropped",
        F.sha2(F.encode(kept, "UTF-8"), 256).alias("kept_sha256"),
    )
