"""Token files: a concatenated id array per file, with Elias-Fano coded document boundaries.

    ids (2 or 4 bytes each, little-endian) | document ids (Elias-Fano) | ends (Elias-Fano) | footer

The ends count ids from the file's start. The footer holds the sizes, so a file is written in one pass. A
file's documents are in ascending order, null ids first, and files follow each other in the manifest.
"""

from __future__ import annotations

import posixpath
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import id_text, parts, slices, stage
from tidemark.llm.elias_fano import EliasFano
from tidemark.llm.tokens import END_ID, encoder
from tidemark.session import new_shared_path

MAGIC = b"TMTOKEF1"
_FOOTER = "<QQQQB8s"
#: Bytes of ids read at once.
READ_BYTES = 8 << 20
#: Documents whose offsets are decoded at once.
BLOCK_DOCS = 4096


def open_folder(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path else fs.FileSystem.from_uri(path.replace("file:", "", 1))


class TokenFile:
    """Reads one token file."""

    def __init__(self, files: fs.FileSystem, path: str):
        self.source = files.open_input_file(path)
        size = self.source.size()
        self.n_tokens, n_ids, n_ends, self.n_nulls, self.width, magic = struct.unpack(
            _FOOTER, self.source.read_at(footer := struct.calcsize(_FOOTER), size - footer)
        )
        if magic != MAGIC:
            raise ValueError(f"{path} is not a token file")
        at = self.n_tokens * self.width
        self.doc_ids = EliasFano.from_bytes(self.source.read_at(n_ids, at))
        self.ends = EliasFano.from_bytes(self.source.read_at(n_ends, at + n_ids))

    def ids(self, start: int, stop: int) -> np.ndarray:
        raw = self.source.read_at((stop - start) * self.width, start * self.width)
        return np.frombuffer(raw, "<u2" if self.width == 2 else "<u4").astype(np.uint32)

    def document(self, i: int) -> np.ndarray:
        """The ids of the file's i-th document, found by select."""
        return self.ids(self.ends.value(i - 1) if i else 0, self.ends.value(i))

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """``(doc_id, start, ids)`` of every document, in order; only one block's offsets are decoded at a time."""
        k, start = 0, 0
        while k < self.ends.count:
            ends = [self.ends.value(k)]
            while k + len(ends) < self.ends.count and len(ends) < BLOCK_DOCS:
                end = self.ends.value(k + len(ends))
                if end > start + READ_BYTES // self.width:
                    break
                ends.append(end)
            block, first = self.ids(start, ends[-1]), start
            for i, end in enumerate(ends, k):
                yield None if i < self.n_nulls else self.doc_ids.value(i - self.n_nulls), start, block[start - first : end - first]
                start = end
            k += len(ends)


def write_token_files(docs: DataFrame, id_col: str, text_col: str, tokenizer: str, path: str) -> DataFrame:
    """Tokenise every text, append the end id and write the files; returns the manifest.

    The manifest has a row per file: ``shard, file, n_docs, n_tokens, start`` with ``start`` counting the ids
    of earlier files. A task that is run again writes a file of another name, and the manifest names only
    files of tasks that ended well. A null text is its end id alone; repeated ids are documents of their own.
    """
    texts = id_text(docs, id_col, text_col)
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    texts = texts.repartitionByRange(parts(docs), *order).sortWithinPartitions(*order)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, False)
        width = 2 if encode.tokenizer.get_vocab_size() <= 1 << 16 else 4
        end = np.array([END_ID], np.uint32).tobytes()
        files, folder = open_folder(path)
        shard = TaskContext.get().partitionId()
        name = f"part-{shard:05d}-{uuid.uuid4().hex}.tok"
        doc_ids, lengths, out = [], [], None
        for batch in slices(batches, "text"):
            out = out or files.open_output_stream(posixpath.join(folder, name))
            doc_ids += batch.column("doc_id").to_pylist()
            for raw in encode.ids(batch.column("text")):
                ids = np.frombuffer(raw + end, "<u4")
                out.write(ids.astype("<u2").tobytes() if width == 2 else ids.tobytes())
                lengths.append(len(ids))
        if out is None:
            return
        nulls = sum(x is None for x in doc_ids)
        known = EliasFano.encode(np.array(doc_ids[nulls:], np.int64)).to_bytes()
        ends = EliasFano.encode(np.cumsum(lengths)).to_bytes()
        out.write(known + ends + struct.pack(_FOOTER, sum(lengths), len(known), len(ends), nulls, width, MAGIC))
        out.close()
        yield pa.RecordBatch.from_pylist([{"shard": shard, "file": name, "n_docs": len(lengths), "n_tokens": sum(lengths)}])

    files, folder = open_folder(path)
    files.create_dir(folder, recursive=True)
    manifest = stage(texts.mapInArrow(write, "shard long, file string, n_docs long, n_tokens long"), "token-manifest")
    before = F.sum("n_tokens").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))  # a row per file
    return manifest.withColumn("start", F.coalesce(before, F.lit(0)))


def read_token_files(manifest: DataFrame, path: str) -> DataFrame:
    """Per document of the files: ``doc_id, start, n_tokens, ids_crc32``; ``start`` counts over all files."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, folder = open_folder(path)
        for batch in batches:
            for row in batch.to_pylist():
                rows = [
                    (doc_id, row["start"] + start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()))
                    for doc_id, start, ids in TokenFile(files, posixpath.join(folder, row["file"])).documents()
                ]
                columns = [pa.array(x, pa.int64()) for x in zip(*rows, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32"])

    spread = manifest.repartition(parts(manifest), "shard")
    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_report(docs: DataFrame, id_col: str, text_col: str, tokenizer: str) -> DataFrame:
    """Write the documents below the shared folder and read them back."""
    path = new_shared_path(docs.sparkSession, "token-files")
    return read_token_files(write_token_files(docs, id_col, text_col, tokenizer, path), path)
