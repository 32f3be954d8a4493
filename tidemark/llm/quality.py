"""A quality score by nearest-neighbour voting in a latent-semantic space.

A text's terms are its hashed words and the shapes of its words (case, first and last character, length,
digits and marks, a repeat of the word before). Weighted term vectors of a bounded sample of labelled
documents give the latent space by singular value decomposition. The labelled vectors are broadcast; every
document's cosines with all of them are computed in blocks, and the nearest vote with their similarity.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import crc_fold, id_text, slices
from tidemark.llm.text import Words

#: Labelled documents that the classifier is fitted on, at most.
LABELLED = 8192
WORD_TERMS, SHAPE_TERMS, DIMENSIONS = 1024, 1024, 64
#: Documents whose dense vectors are held at once when fitting, and the basis and steps of the search for the axes.
FITTED_AT_ONCE, BASIS, STEPS = 256, 128, 60
#: Words weigh this much against shapes.
WORD_WEIGHT = 0.25
NEIGHBOURS, SHARPNESS = 25, 4
LEAST_SCORE, FOLDS = 0.3, 5
_LETTER, _UPPER, _DIGIT, _MARK = 0, 1, 2, 3


Counts = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def byte_kinds() -> np.ndarray:
    kinds = np.full(256, _MARK, np.uint8)
    kinds[ord("a") : ord("z") + 1] = kinds[128:] = _LETTER
    kinds[ord("A") : ord("Z") + 1] = _UPPER
    kinds[ord("0") : ord("9") + 1] = _DIGIT
    return kinds


def word_shapes(words: Words, hashes: np.ndarray) -> np.ndarray:
    """Each word's shape, below ``SHAPE_TERMS``."""
    kinds = byte_kinds()[words.raw]
    totals = lambda kind: np.concatenate([[0], np.cumsum(kinds == kind)])
    inside = lambda sums, a, b: sums[b] - sums[a]
    a, b = words.starts, words.ends
    size = b - a
    first, last = kinds[a].astype(np.int64), kinds[b - 1].astype(np.int64)
    upper, marks, digits = (inside(totals(k), a, b) for k in (_UPPER, _MARK, _DIGIT))
    again = np.zeros(len(a), np.int64)
    again[1:] = hashes[1:] == hashes[:-1]
    again[words.bounds[:-1][(words.counts > 0)]] = 0
    length = np.minimum(np.log2(size).astype(np.int64), 3)
    code = first * 4 + last
    code = code * 2 + (upper > 1)
    code = code * 4 + np.minimum(marks, 3)
    code = code * 2 + again
    return (code * 4 + length).astype(np.int64)  # 16 * 2 * 4 * 2 * 4 = SHAPE_TERMS


def term_counts(texts: pa.Array) -> Counts:
    """``(text, term, count, words)``: the distinct terms of each text in order, and each text's word count."""
    words = Words(texts, lower=False)
    h = words.hashes()
    owner = np.repeat(np.arange(len(words)), words.counts)
    terms = np.concatenate([(h % np.uint64(WORD_TERMS)).astype(np.int64), WORD_TERMS + word_shapes(words, h)])
    keys, counts = np.unique(np.concatenate([owner, owner]) * (WORD_TERMS + SHAPE_TERMS) + terms, return_counts=True)
    return keys // (WORD_TERMS + SHAPE_TERMS), keys % (WORD_TERMS + SHAPE_TERMS), counts, words.counts


def weighted(counts: Counts, idf: np.ndarray) -> np.ndarray:
    """Each term's weight: words by log count and idf, shapes by the root of their share and idf; each part of
    a text's vector has a fixed length."""
    owner, term, count, n = counts
    is_word = term < WORD_TERMS
    weight = np.where(is_word, np.log1p(count) * idf[term], np.sqrt(count / np.maximum(n[owner], 1)) * idf[term])
    for part, length in ((is_word, WORD_WEIGHT), (~is_word, 1.0)):
        norm = np.sqrt(np.bincount(owner[part], weight[part] ** 2, minlength=len(n)))
        weight[part] *= length / np.maximum(norm, 1e-12)[owner[part]]
    return weight


def inverse_frequency(owner: np.ndarray, term: np.ndarray) -> np.ndarray:
    df = np.bincount(term, minlength=WORD_TERMS + SHAPE_TERMS)
    return np.log((owner.max(initial=0) + 2) / (df + 1)) + 0.1


def leading_axes(square: np.ndarray) -> np.ndarray:
    """The ``DIMENSIONS`` leading eigenvectors by subspace iteration, which needs a tenth of a full decomposition's memory."""
    basis = np.linalg.qr(np.random.default_rng(1).standard_normal((len(square), BASIS)).astype(np.float32))[0]
    for _ in range(STEPS):
        basis = np.linalg.qr(square @ basis)[0]
    _, turned = np.linalg.eigh(basis.T @ (square @ basis))
    return np.ascontiguousarray((basis @ turned)[:, ::-1][:, :DIMENSIONS])


class LatentSpace:
    """Term weights and axes from a sample's term counts, and the sample's vectors and labels."""

    def __init__(self, counts: Counts, labels: np.ndarray):
        owner, term, count, n = counts
        self.idf = inverse_frequency(owner, term)
        starts = range(0, len(n), FITTED_AT_ONCE)
        cut = np.searchsorted(owner, [*starts, len(n)])

        def dense(k: int) -> np.ndarray:
            some, first = slice(cut[k], cut[k + 1]), starts[k]
            words = n[first : first + FITTED_AT_ONCE]
            out = np.zeros((len(words), WORD_TERMS + SHAPE_TERMS), np.float32)
            out[owner[some] - first, term[some]] = weighted((owner[some] - first, term[some], count[some], words), self.idf)
            return out

        blocks = range(len(starts))
        self.mean = (sum(dense(k).sum(axis=0, dtype=np.float64) for k in blocks) / len(n)).astype(np.float32)
        square = np.zeros((len(self.mean), len(self.mean)), np.float32)
        for k in blocks:
            x = dense(k) - self.mean
            square += x.T @ x
        self.axes = leading_axes(square)
        self.labels = labels.astype(np.float32)
        self.known = self.unit(np.concatenate([(dense(k) - self.mean) @ self.axes for k in blocks]))

    @staticmethod
    def unit(x: np.ndarray) -> np.ndarray:
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)

    def vectors(self, texts: pa.Array) -> np.ndarray:
        counts = term_counts(texts)
        owner, term, weight = *counts[:2], weighted(counts, self.idf)
        out = np.zeros((len(texts), DIMENSIONS), np.float32)
        starts = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])) if len(owner) else owner
        for a in range(0, len(starts), 64):  # a few texts at once, so that little is gathered
            b = starts[a + 64] if a + 64 < len(starts) else len(owner)
            some = slice(starts[a], b)
            part = self.axes[term[some]] * weight[some, None].astype(np.float32)
            out[owner[starts[a : a + 64]]] = np.add.reduceat(part, starts[a : a + 64] - starts[a])
        return self.unit(out - self.mean @ self.axes)

    def scores(self, texts: pa.Array, block: int = 512) -> np.ndarray:
        x = self.vectors(texts)
        k = min(NEIGHBOURS, len(self.labels))
        out = np.empty(len(x))
        for a in range(0, len(x), block):
            cosine = x[a : a + block] @ self.known.T
            near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
            vote = np.maximum(np.take_along_axis(cosine, near, axis=1), 1e-6).astype(np.float64) ** SHARPNESS
            out[a : a + block] = (vote * self.labels[near]).sum(axis=1) / vote.sum(axis=1)
        return np.clip(out, 0, 1)


def fit(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> LatentSpace | None:
    """The space of at most ``LABELLED`` labelled documents, the first by hashed id, held-out ids left out.

    Labels of one id are averaged; of repeated ids one text counts. None if there are no labels. What comes to
    the driver is bounded: the counts of ``WORD_TERMS + SHAPE_TERMS`` terms for each document of the sample.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(f"`{label_col}`").cast("double").alias("label"))
    known = known.where(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & (crc_fold(F.col("doc_id"), FOLDS) != 0))
    known = known.groupBy("doc_id").agg(F.avg("label").alias("label"))
    texts = id_text(docs, id_col, text_col)
    present = known.join(texts.select("doc_id").distinct(), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(LABELLED)
    texts = texts.join(F.broadcast(present), "doc_id")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            owner, term, n, words = term_counts(batch.column("text"))
            cut = np.searchsorted(owner, np.arange(batch.num_rows + 1))
            pack = lambda x: pa.array([x[a:b].astype(np.int32).tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("label"), pa.array(words), pack(term), pack(n)], ["doc_id", "label", "words", "term", "n"]
            )

    rows = texts.mapInArrow(count, "doc_id long, label double, words long, term binary, n binary").dropDuplicates(["doc_id"]).collect()
    if not rows:
        return None
    rows.sort(key=lambda r: r.doc_id)
    terms = [np.frombuffer(r.term, np.int32) for r in rows]
    owner = np.repeat(np.arange(len(rows), dtype=np.int32), [len(t) for t in terms])
    counts = owner, np.concatenate(terms), np.concatenate([np.frombuffer(r.n, np.int32) for r in rows]), np.array([r.words for r in rows])
    return LatentSpace(counts, np.array([r.label for r in rows]))


def score(docs: DataFrame, space: LatentSpace | None, id_col: str, text_col: str) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``.

    The id decides ``held_out`` only. Null and empty texts score as a text without terms; without a fitted
    space every score is 0.5. An empty table gives an empty result. Other columns are not read.
    """
    texts = id_text(docs, id_col, text_col, crc_fold(F.col(f"`{id_col}`"), FOLDS).eqNullSafe(F.lit(0)).alias("held_out"))
    shared = docs.sparkSession.sparkContext.broadcast(space)  # at most LABELLED vectors

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            model = shared.value
            got = model.scores(batch.column("text")) if model else np.full(batch.num_rows, 0.5)
            columns = [batch.column("doc_id"), batch.column("held_out"), pa.array(got), pa.array((got >= LEAST_SCORE).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "score", "predicted"])

    return texts.mapInArrow(scored, "doc_id long, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, space: LatentSpace | None, text_col: str) -> DataFrame:
    """The documents with a score of at least ``LEAST_SCORE``, all columns as they were."""
    shared = docs.sparkSession.sparkContext.broadcast(space)  # at most LABELLED vectors

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col):
            model = shared.value
            yield batch.filter(pa.array(model.scores(batch.column(text_col)) >= LEAST_SCORE)) if model else batch

    return docs.mapInArrow(kept, docs.schema)
