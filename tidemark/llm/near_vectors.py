"""Near-duplicate vectors by a pivot-permutation index.

Every vector is described by its nearest reference vectors, in order. Inverted lists from reference to
vectors retrieve the vectors of the same label that share enough of them, and the cosine verifies each pair.
A pair is counted in the list of its first shared reference only. Long lists are cut into chunks whose pairs
of chunks are tasks of their own; a task returns counts and a spanning forest, never its pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stage
from tidemark.llm.graph import connected_components
from tidemark.llm.vectors import matrix, read_vectors, unit

LEAST_COSINE = 0.93
#: References, how many describe a vector, and how many two vectors must share.
PIVOTS, NEAREST, SHARED = 256, 8, 3
#: Rows from which references are taken, and the cosine that two of them stay below.
PIVOT_SAMPLE, PIVOT_COSINE = 4096, 0.8
CHUNK = 2048


def choose_pivots(vectors: DataFrame) -> dict[int, np.ndarray]:
    """For each dimension, unit references from a bounded sample: the first rows by hashed id, leaving out
    those close to one already taken, so that a large group of copies gives one reference."""
    sample = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(PIVOT_SAMPLE).select("v").collect()
    found = {}
    for size in sorted({len(r.v) for r in sample}):
        rows = unit(np.array([r.v for r in sample if len(r.v) == size]))
        taken = np.zeros((0, size))
        for row in rows:
            if len(taken) < PIVOTS and (taken @ row < PIVOT_COSINE).all():
                taken = np.vstack([taken, row])
        found[size] = taken
    return found


def spanning_links(linked: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what a symmetric link matrix connects: each row with the smallest id of its component."""
    root = np.full(len(ids), -1)
    for start in np.argsort(ids, kind="stable"):
        if root[start] >= 0:
            continue
        front = np.array([start])
        root[start] = start
        while len(front):
            front = np.flatnonzero(linked[front].any(axis=0) & (root < 0))
            root[front] = start
    far = np.flatnonzero(root != np.arange(len(ids)))
    return ids[far], ids[root[far]]


def compare(group: pa.Table) -> pa.Table:
    """The links of one pair of chunks of one list: ``vec_id, root, n_links``, with ``root`` null for counts."""
    pivot, i, j = (group.column(c)[0].as_py() for c in ("pivot", "i", "j"))
    ids, chunk = group.column("vec_id").to_numpy(), group.column("chunk").to_numpy()
    x = unit(matrix(group.column("v")))
    near = matrix(group.column("near")).astype(np.int64)
    has = np.zeros((len(ids), near.max() + 1), np.float32)
    np.put_along_axis(has, near, 1, axis=1)
    a, b = np.flatnonzero(chunk == i), np.flatnonzero(chunk == j)
    # the pairs that this list answers for: enough shared references, none of them before this one
    mine = (has[a] @ has[b].T >= min(SHARED, near.shape[1])) & (has[a][:, :pivot] @ has[b][:, :pivot].T == 0)
    link = np.zeros(mine.shape, bool)
    for k in np.flatnonzero(mine.any(axis=1)):
        some = np.flatnonzero(mine[k])
        link[k, some] = (x[b[some]] * x[a[k]]).sum(axis=1) >= LEAST_COSINE
    both = np.zeros((len(ids), len(ids)), bool)
    both[np.ix_(a, b)] = link
    both |= both.T
    np.fill_diagonal(both, False)
    counts = both.sum(axis=1)
    some = np.flatnonzero(counts)
    far, root = spanning_links(both[np.ix_(some, some)], ids[some])
    return pa.table(
        {
            "vec_id": pa.array(np.concatenate([ids[some], far])),
            "root": pa.concat_arrays([pa.nulls(len(some), pa.int64()), pa.array(root)]),
            "n_links": pa.array(np.concatenate([counts[some], np.zeros(len(far), np.int64)]).astype(np.int64)),
        }
    )


def near_vectors(rows: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """One row per vector id: ``vec_id, n_links, component_id, kept``.

    Vectors link when their labels are equal and not null and their cosine is at least 0.93. Vectors that are
    null, empty, zero or hold null or non-finite components, vectors without id or label, and vectors of
    different lengths link with nothing. Repeated ids are one vector, the smallest row of them. An empty table
    gives an empty result. Other columns are not read.
    """
    vectors = stage(read_vectors(rows, id_col, vector_col, F.col(f"`{label_col}`").cast("string").alias("label")), "vectors")
    usable = vectors.where("v IS NOT NULL AND vec_id IS NOT NULL AND label IS NOT NULL")
    pivots = choose_pivots(usable)

    def describe(batches):
        for batch in batches:
            sizes = np.array([len(v) for v in batch.column("v").to_pylist()], np.int64)
            for size in np.unique(sizes):
                some = batch.take(pa.array(np.flatnonzero(sizes == size)))
                refs = pivots.get(int(size))
                # a length that the sample has not met has one list, told by the length
                if refs is None:
                    near = np.zeros((some.num_rows, 1), np.int64)
                else:
                    near = np.argsort(-(unit(matrix(some.column("v"))) @ refs.T), axis=1, kind="stable")[:, :NEAREST]
                lists = pa.FixedSizeListArray.from_arrays(pa.array(near.reshape(-1).astype(np.int32)), near.shape[1]).cast(pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([*(some.column(c) for c in ("vec_id", "label", "v")), lists], ["vec_id", "label", "v", "near"])

    described = stage(usable.select("vec_id", "label", "v").mapInArrow(describe, "vec_id long, label string, v array<double>, near array<int>"), "described")
    listed = described.select("*", F.size("v").alias("size"), F.explode("near").alias("pivot"))
    lengths = listed.groupBy("label", "size", "pivot").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks"))
    listed = listed.join(lengths, ["label", "size", "pivot"]).withColumn("chunk", F.pmod(F.xxhash64("vec_id"), F.col("chunks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    tasks = listed.withColumn("other", other).withColumn("i", F.least("chunk", "other")).withColumn("j", F.greatest("chunk", "other"))
    tasks = tasks.groupBy("label", "size", "pivot", "i", "j")
    links = stage(tasks.applyInArrow(compare, "vec_id long, root long, n_links long"), "links")

    counts = links.where("root IS NULL").groupBy("vec_id").agg(F.sum("n_links").alias("n_links"))
    edges = links.where("root IS NOT NULL").select(F.col("vec_id").alias("a"), F.col("root").alias("b"))
    components = connected_components(edges).select(F.col("node").alias("vec_id"), "root")
    out = vectors.select("vec_id").join(counts, "vec_id", "left").join(components, "vec_id", "left")
    component = F.coalesce("root", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"), component.eqNullSafe(F.col("vec_id")).alias("kept"))
