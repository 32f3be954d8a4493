"""Reading vectors: one row per id, in double precision, with those that take no part marked."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def read_vectors(rows: DataFrame, id_col: str, vector_col: str, *more: Column) -> DataFrame:
    """``vec_id, v`` and ``more``. ``v`` is null for vectors that take no part: null, empty, zero, or with null
    or non-finite components. Repeated ids are one vector, the smallest row of them."""
    v = F.col(f"`{vector_col}`").cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    usable = finite & F.exists(v, lambda x: x != 0)
    read = rows.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.when(usable, v).alias("v"), *more)
    names = [c for c in read.columns if c != "vec_id"]
    one = read.groupBy("vec_id").agg(F.min(F.struct(*names)).alias("row"))
    return one.select("vec_id", *[F.col("row").getField(c).alias(c) for c in names])


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Lists of one length as the rows of a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; first by their largest component, so that no square over- or underflows."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)
