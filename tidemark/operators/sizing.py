"""Size checks that decide whether a join may broadcast its lookup side."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def broadcast_limit(df: DataFrame) -> int:
    """``spark.sql.autoBroadcastJoinThreshold`` in bytes; negative when switched off."""
    return df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def _plan(df: DataFrame):
    return df._jdf.queryExecution().optimizedPlan()


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's estimate of the result."""
    return int(str(_plan(df).stats().sizeInBytes()))


def scanned_bytes(df: DataFrame) -> int:
    """Estimated bytes of the tables a plan reads, which is what computing it costs."""
    leaves = _plan(df).collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def row_width(df: DataFrame) -> int | None:
    """Bytes of a row whose columns all have a fixed size, else None."""
    fixed = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)
    return 8 + 16 * len(df.schema) if all(isinstance(f.dataType, fixed) for f in df.schema.fields) else None


#: Relative error of the sketch of keys, and the room left for it.
SKETCH_ERROR, SKETCH_ROOM = 0.02, 1.2


def groups_fit_broadcast(df: DataFrame, keys: Sequence[str], grouped: DataFrame) -> bool:
    """True when the groups of ``df`` by ``keys`` are surely few enough to be broadcast as ``grouped``.

    A HyperLogLog sketch of the keys is filled by every task and merged, so nothing but sketches is shuffled; text keys count with
    the length of the longest. Aggregates of no fixed size are not judged.
    """
    limit = broadcast_limit(df)
    texts = [k for k in keys if isinstance(df.schema[k].dataType, (T.StringType, T.BinaryType))]
    width = row_width(grouped.drop(*[c for c, k in zip(grouped.columns, keys) if k in texts]))
    if limit <= 0 or width is None:
        return False
    longest = [F.coalesce(F.max(F.octet_length(k)), F.lit(0)) for k in texts]
    n, *lengths = df.agg(F.approx_count_distinct(F.struct(*keys), SKETCH_ERROR), *longest).first()
    return n * SKETCH_ROOM * (width + sum(24 + length for length in lengths)) <= limit


def measured_bytes(df: DataFrame) -> int:
    """Bytes of the rows of ``df``, found by computing it once."""
    width = F.lit(8)  # row header
    for field in df.schema.fields:
        kind = field.dataType
        if isinstance(kind, (T.StringType, T.BinaryType)):
            width = width + F.lit(16) + F.coalesce(F.octet_length(field.name), F.lit(0))
        elif isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
            width = width + F.lit(16) + F.coalesce(F.octet_length(F.to_json(F.struct(field.name))), F.lit(0))
        else:
            width = width + F.lit(16)
    return df.agg(F.sum(width.cast("bigint"))).first()[0] or 0


def one_task_reads(df: DataFrame) -> bool:
    """True when the plan reads no more than one scan task does.

    Splitting the keys of such an input would cost more than it saves. Plans over
    checkpoints or RDDs have no size and count as large.
    """
    limit = df.sparkSession._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    return scanned_bytes(df) <= limit


def fits_broadcast(lookup: DataFrame, rows: DataFrame) -> bool:
    """True when ``lookup`` is known to stay within the broadcast limit.

    Estimates multiply over joins and ignore filters, so a lookup that reads far less
    than ``rows`` is measured. One that reads as much is taken as too large.
    """
    limit = broadcast_limit(lookup)
    if estimated_bytes(lookup) <= limit:
        return True
    if limit <= 0 or scanned_bytes(lookup) * 4 > scanned_bytes(rows):
        return False
    return measured_bytes(lookup) <= limit
