"""Approximate nearest neighbours by a hash-prefix forest.

The rows are dealt into segments of bounded size. Each segment holds a forest: for every tree, the sorted
array of its rows' hash strings, one bit per random hyperplane. A query descends each tree to its longest
matching prefix, a contiguous range of the array, and all trees ascend together, one bit at a time, until
enough rows are in their ranges. Largest inner product becomes smallest angle by one more component that
brings every row to the same length.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stage
from tidemark.llm.vectors import matrix, read_vectors

NEIGHBOURS, QUERY_STEP = 20, 20
#: Trees, bits of a hash string, rows in a segment, and queries that a task answers at once.
TREES, BITS, SEGMENT, QUERIES = 48, 32, 4096, 1024
#: The ranges hold at least this many rows, and this many times a segment's rows, counted in every tree.
LEAST_FOUND, FOUND_SHARE = 1024, 0.75


def hash_strings(x: np.ndarray, trees: int = TREES, bits: int = BITS) -> np.ndarray:
    """Each row's hash string in each tree, as an unsigned integer; planes depend on the dimension only."""
    planes = np.random.default_rng(x.shape[1]).standard_normal((x.shape[1], trees * bits)).astype(np.float32)
    side = (x.astype(np.float32) @ planes > 0).reshape(len(x), trees, bits)
    return (side.astype(np.uint64) << np.arange(bits - 1, -1, -1, dtype=np.uint64)).sum(axis=2, dtype=np.uint64)


class Forest:
    def __init__(self, strings: np.ndarray):
        self.rows = len(strings)
        self.order = np.argsort(strings, axis=0, kind="stable").T
        self.sorted = np.take_along_axis(strings.T, self.order, axis=1)

    def ranges(self, strings: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
        """For each query and tree, the range of rows at the longest common prefix length, the same in all
        trees, at which the ranges hold ``wanted`` rows; the whole arrays if no length is enough."""
        low = np.zeros(strings.shape, np.int64)
        high = np.full(strings.shape, self.rows)
        waiting = np.arange(len(strings))
        for length in range(BITS, 0, -1):
            rest = np.uint64((1 << (BITS - length)) - 1)
            some = strings[waiting]
            a = np.stack([np.searchsorted(t, some[:, k] & ~rest) for k, t in enumerate(self.sorted)], axis=1)
            b = np.stack([np.searchsorted(t, some[:, k] | rest, side="right") for k, t in enumerate(self.sorted)], axis=1)
            enough = (b - a).sum(axis=1) >= wanted
            low[waiting[enough]], high[waiting[enough]] = a[enough], b[enough]
            waiting = waiting[~enough]
            if not len(waiting):
                break
        return low, high

    def candidates(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        seen = np.zeros(self.rows, bool)
        for order, a, b in zip(self.order, low, high, strict=True):
            seen[order[a:b]] = True
        return np.flatnonzero(seen)


def search_segment(longest: float, k: int):
    def search(group: pa.Table) -> pa.Table:
        asks = group.column("asks").to_numpy(zero_copy_only=False).astype(bool)
        ids, v = group.column("vec_id").to_numpy(), matrix(group.column("v"))
        rows, queries = np.flatnonzero(~asks), np.flatnonzero(asks)
        out_q, out_v, out_s = [], [], []
        if len(rows) and len(queries):
            x, q = v[rows] / longest, v[queries]
            q = q / np.abs(q).max(axis=1, keepdims=True)
            lift = np.sqrt(np.maximum(0, 1 - (x * x).sum(axis=1, keepdims=True)))
            forest = Forest(hash_strings(np.hstack([x, lift])))
            low, high = forest.ranges(hash_strings(np.hstack([q, np.zeros((len(q), 1))])), max(LEAST_FOUND, int(FOUND_SHARE * len(rows))))
            for n, query in enumerate(queries):
                found = rows[forest.candidates(low[n], high[n])]
                found = found[ids[found] != ids[query]]
                rough = v[found] @ v[query]
                if len(found) > k:
                    least = np.partition(rough, -k)[-k]
                    found = found[rough >= least - 1e-9 * max(1.0, abs(least))]
                score = (v[found] * v[query]).sum(axis=1)
                best = np.lexsort((ids[found], -score))[:k]
                out_q.append(np.full(len(best), ids[query]))
                out_v.append(ids[found][best])
                out_s.append(score[best])
        join = lambda parts, kind: pa.array(np.concatenate(parts) if parts else [], kind)
        return pa.table({"query_id": join(out_q, pa.int64()), "vec_id": join(out_v, pa.int64()), "score": join(out_s, pa.float64())})

    return search


def nearest(rows: DataFrame, id_col: str, vector_col: str, k: int = NEIGHBOURS, step: int = QUERY_STEP) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each id divisible by ``step``, the ``k`` largest inner products found.

    Vectors that are null, empty, zero or hold null or non-finite components, and vectors without id, take no
    part; vectors of different lengths do not meet. Repeated ids are one vector, the smallest row of them.
    Equal scores go to the smaller id. An empty table gives an empty result. Other columns are not read.
    """
    vectors = stage(read_vectors(rows, id_col, vector_col).where("v IS NOT NULL AND vec_id IS NOT NULL").withColumn("size", F.size("v")), "vectors")
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    queries = vectors.where(F.col("vec_id") % step == 0)
    # one row; the numbers of segments and of query blocks follow the input
    longest, n = vectors.agg(F.max(norm), F.count("*")).first()
    n_queries = queries.count()
    segments, blocks = max(1, -(-n // SEGMENT)), max(1, -(-n_queries // QUERIES))
    place = lambda many: F.pmod(F.xxhash64("vec_id"), F.lit(many)).cast("int")
    every = lambda many: F.explode(F.sequence(F.lit(0), F.lit(many - 1)))
    # the stated queries, in blocks, against all rows, in segments
    index = vectors.select("vec_id", "v", "size", F.lit(False).alias("asks"), place(segments).alias("segment"), every(blocks).alias("block"))
    asking = queries.select("vec_id", "v", "size", F.lit(True).alias("asks"), every(segments).alias("segment"), place(blocks).alias("block"))
    groups = index.unionByName(asking).groupBy("size", "segment", "block")
    found = groups.applyInArrow(search_segment(longest or 1.0, k), "query_id long, vec_id long, score double")
    best = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", best).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
