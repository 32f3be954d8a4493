"""Fill-in-middle: cutting texts between tokens and moving the middle to the end.

Texts are cut into chunks where a rolling hash of the last bytes says so, so equal passages give equal chunks
wherever they stand. A chunk's summary (tokens, characters, whether it begins and ends with a letter) is kept
by its bytes, so a passage that many documents share is measured once for each worker. Two neighbours' counts
add up, less one token where a run of letters crosses their border; the running counts lead to the chunk that
holds a cut, and only that chunk is looked at again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import id_text, slices
from tidemark.llm.text import mix

#: The marks of prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN_FROM, SPM_BELOW = 90, 20
#: The rolling hash sees so many bytes; a chunk ends where its highest bits are 0, after 1 KB on average.
HASH_BYTES, HASH_BITS = 16, 10
#: Where the hash finds no end, as in one repeated character, a chunk ends here.
LONGEST = 1 << 16
#: Bytes of chunks that a worker remembers before it starts anew.
MEMO_BYTES = 32 << 20

_GEAR = (mix(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True


def rolling_hash(data: np.ndarray) -> np.ndarray:
    """At each byte a hash of it and the bytes before it; windows are doubled, not slid."""
    h, width = _GEAR[data], 1
    while width < HASH_BYTES:
        h[width:] += h[:-width] << np.uint32(width)
        width *= 2
    return h


def begins_character(data: np.ndarray) -> np.ndarray:
    return (data & 0xC0) != 0x80


def chunk_bounds(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Chunk borders in the joined UTF-8 bytes of many texts; ``offsets`` are the texts' own borders.

    No border lies inside a character, and none depends on the text before.
    """
    ends = np.flatnonzero(rolling_hash(data) >> np.uint32(32 - HASH_BITS) == 0) + 1
    ends = ends[ends < len(data)]
    ends = ends[begins_character(data[ends])]
    text = np.searchsorted(offsets, ends, side="right") - 1
    bounds = np.union1d(offsets, ends[ends - offsets[text] >= HASH_BYTES])
    more = []
    for i in np.flatnonzero(np.diff(bounds) > LONGEST):
        for at in range(int(bounds[i]) + LONGEST, int(bounds[i + 1]), LONGEST):
            while not begins_character(data[at]):
                at -= 1
            more.append(at)
    return np.union1d(bounds, np.array(more, np.int64)) if more else bounds


def token_starts(data: np.ndarray, begins: np.ndarray | None = None) -> np.ndarray:
    """Where tokens begin: at every character but a letter that follows a letter. At ``begins`` nothing is before."""
    letter = _LETTER[data]
    after = np.zeros(len(data), bool)
    after[1:] = letter[:-1]
    if begins is not None:
        after[begins] = False
    return begins_character(data) & ~(letter & after)


class ChunkMemo:
    """Summaries of chunks by their bytes: tokens, characters, and whether a letter stands first and last."""

    def __init__(self, most: int = MEMO_BYTES):
        self.most, self.held, self.known = most, 0, {}

    def summaries(self, chunks: list[bytes]) -> np.ndarray:
        if self.held > self.most:
            self.held, self.known = 0, {}
        if new := list(dict.fromkeys(c for c in chunks if c not in self.known)):
            sizes = np.fromiter(map(len, new), np.int64, len(new))
            begins = np.cumsum(sizes) - sizes
            data = np.frombuffer(b"".join(new), np.uint8)
            tokens = np.add.reduceat(token_starts(data, begins), begins, dtype=np.int64)
            characters = np.add.reduceat(begins_character(data), begins, dtype=np.int64)
            first, last = _LETTER[data[begins]], _LETTER[data[begins + sizes - 1]]
            self.known.update(zip(new, np.stack([tokens, characters, first, last], axis=1).tolist(), strict=True))
            self.held += int(sizes.sum())
        return np.array([self.known[c] for c in chunks], np.int64).reshape(-1, 4)


class ChunkedTexts:
    """Texts as chunks: counts of tokens, and the byte and character at which a token begins."""

    def __init__(self, texts: list[bytes], memo: ChunkMemo):
        raw = b"".join(texts)
        self.data = np.frombuffer(raw, np.uint8)
        self.offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        self.bounds = chunk_bounds(self.data, self.offsets)
        chunks = [raw[a:b] for a, b in zip(self.bounds[:-1].tolist(), self.bounds[1:].tolist(), strict=True)]
        tokens, characters, first, last = memo.summaries(chunks).T
        self.first_chunk = np.searchsorted(self.bounds, self.offsets)
        self.joined = np.zeros(len(chunks), bool)
        self.joined[1:] = last[:-1] & first[1:]
        self.joined[self.first_chunk[:-1][self.first_chunk[:-1] < len(chunks)]] = False
        self.tokens = np.concatenate([[0], np.cumsum(tokens - self.joined)])
        self.characters = np.concatenate([[0], np.cumsum(characters)])

    def n_tokens(self) -> np.ndarray:
        return np.diff(self.tokens[self.first_chunk])

    def cut(self, text: int, k: int) -> tuple[int, int]:
        """Bytes and characters of a text before its token ``k``."""
        a, b = int(self.first_chunk[text]), int(self.first_chunk[text + 1])
        chunk = a + int(np.searchsorted(self.tokens[a + 1 : b + 1], self.tokens[a] + k, side="right"))
        begin = int(self.bounds[chunk])
        at, inside = begin, 0
        if chunk < b:
            data = self.data[begin : int(self.bounds[chunk + 1])]
            starts = token_starts(data)
            starts[0] &= not self.joined[chunk]
            at += int(np.flatnonzero(starts)[self.tokens[a] + k - self.tokens[chunk]])
            inside = int(np.count_nonzero(begins_character(data[: at - begin])))
        return at - int(self.offsets[text]), int(self.characters[chunk] - self.characters[a]) + inside


def draws(doc_id: int | None) -> list[int]:
    """Four numbers that only the id decides."""
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[4 * k : 4 * k + 4], "big") for k in range(4)]


_MEMO = ChunkMemo()


def fill_middle(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per document: ``doc_id, n, form, prefix_chars, middle_chars, output``.

    A text of n tokens (a run of A-Z and a-z, or one other character) is cut before two of them, which the id
    decides, and written as prefix, suffix, middle (``psm``) or suffix, prefix, middle (``spm``) behind marks. It
    stays as it is (``plain``, no counts) if it is empty or null, holds a mark, or is one of the tenth that the id
    leaves plain. A null id counts as an empty one; repeated rows are treated alike. An empty table gives an empty
    result; other columns are not read. Nothing is shuffled.
    """

    def transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, s, m = (x.encode() for x in (PREFIX, SUFFIX, MIDDLE))
        for batch in slices(batches, "text"):
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            chunked = ChunkedTexts(texts, _MEMO)
            counts = chunked.n_tokens().tolist()
            forms, prefixes, middles, outputs = [], [], [], []
            for i, (text, n, doc_id) in enumerate(zip(texts, counts, batch.column("doc_id").to_pylist(), strict=True)):
                h1, h2, h3, h4 = draws(doc_id)
                if not text or h3 % 100 >= PLAIN_FROM or p in text or s in text or m in text:
                    forms.append("plain")
                    prefixes.append(None)
                    middles.append(None)
                    outputs.append(text)
                    continue
                a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
                (a, a_chars), (b, b_chars) = chunked.cut(i, a), chunked.cut(i, b)
                spm = h4 % 100 < SPM_BELOW
                forms.append("spm" if spm else "psm")
                prefixes.append(a_chars)
                middles.append(b_chars - a_chars)
                outputs.append(b"".join([s, text[b:], p, text[:a], m, text[a:b]] if spm else [p, text[:a], s, text[b:], m, text[a:b]]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(forms, pa.string()), pa.array(prefixes, pa.int64()), pa.array(middles, pa.int64()), pa.array(outputs, pa.binary()).cast(pa.string())],
                ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
            )

    schema = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"
    return id_text(docs, id_col, text_col).mapInArrow(transform, schema)


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made from; no transformed text holds a mark of its own."""

    def between(mark: str | None, end: str) -> Column:
        start = F.lit(len(PREFIX) + 1) if mark is None else F.locate(mark, output) + len(mark)
        return F.substr(output, start, F.locate(end, output) - start)

    middle = F.substr(output, F.locate(MIDDLE, output) + len(MIDDLE))
    psm = F.concat(between(None, SUFFIX), middle, between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), middle, between(None, PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def digest_report(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256`` of each document."""

    def sha256(text: Column) -> Column:
        return F.sha2(F.encode(text, "UTF-8"), 256)

    return fill_middle(docs, id_col, text_col).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        sha256(F.col("output")).alias("output_sha256"), sha256(restored(F.col("output"), F.col("form"))).alias("restored_sha256"),
    )
