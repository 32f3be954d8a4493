"""Packing documents into token windows by minimum bin slack.

Documents are cut into full windows and one remainder each. Only the counts of remainder lengths (at most one
for each length) reach the planner: a bitset subset-sum over the lengths still to place finds the multiset
that comes closest to the capacity, which is used as often as the counts allow. Pieces take their place in
the plan by their rank among pieces of the same length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import id_text, parts, slices, stage
from tidemark.llm.tokens import END_ID, encoder

WINDOW = 2048
#: Pieces of one length that one task ranks; ranks do not depend on it.
RANKED_AT_ONCE = 1_000_000


def closest_multiset(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The multiset of the counted lengths with the largest sum within ``capacity`` that holds the longest one.

    Subset sums are the set bits of an integer. Counts are split into powers of two, so each length needs a
    logarithm of its count in steps; walking the steps back gives how often each length is used.
    """
    longest = max(counts)
    room = capacity - longest
    sums, steps, full = 1, [], (1 << (room + 1)) - 1
    for length in sorted(counts, reverse=True):
        left = min(counts[length] - (length == longest), room // length)
        many = 1
        while left > 0 and not sums >> room & 1:
            many = min(many, left)
            steps.append((length, many, sums))
            sums |= (sums << (length * many)) & full
            left -= many
            many *= 2
        if sums >> room & 1:
            break
    target, used = sums.bit_length() - 1, {longest: 1}
    for length, many, before in reversed(steps):
        if not before >> target & 1:
            target -= length * many
            used[length] = used.get(length, 0) + many
    return used


def plan_windows(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """``(length, first rank, ranks, copies, first window, offset)`` for each length in each window pattern."""
    left, taken, plan, window = {k: n for k, n in counts.items() if n > 0}, dict.fromkeys(counts, 0), [], 0
    while left:
        used = closest_multiset(left, capacity)
        times = min(left[k] // n for k, n in used.items())
        offset = 0
        for length, n in sorted(used.items(), reverse=True):
            plan.append((length, taken[length], n * times, n, window, offset))
            offset += n * length
            taken[length] += n * times
            left[length] -= n * times
            if not left[length]:
                del left[length]
        window += times
    return plan


def pieces(docs: DataFrame, id_col: str, text_col: str, tokenizer: str, window: int = WINDOW, with_ids: bool = False) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens`` (and ``ids``): each document's full windows and remainder."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, True)
        end = np.array([END_ID], np.uint32).tobytes()
        for batch in slices(batches, "text"):
            owner, start, length, crc, total, ids = [], [], [], [], [], []
            for i, raw in enumerate(encode.ids(batch.column("text"))):
                raw += end
                for a in range(0, len(raw), 4 * window):
                    piece = raw[a : a + 4 * window]
                    owner.append(i)
                    start.append(a // 4)
                    length.append(len(piece) // 4)
                    crc.append(zlib.crc32(piece))
                    total.append(len(raw) // 4)
                    if with_ids:
                        ids.append(piece)
            columns = [batch.column("doc_id").take(pa.array(owner, pa.int64())), *(pa.array(x, pa.int64()) for x in (start, length, crc, total))]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            if with_ids:
                columns.append(pa.array(ids, pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids binary" * with_ids
    return id_text(docs, id_col, text_col).mapInArrow(cut, schema)


def pack(docs: DataFrame, id_col: str, text_col: str, tokenizer: str, window: int = WINDOW, with_ids: bool = False) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` (and ``ids``).

    A null or empty text is its end id alone. Repeated ids and rows are packed each on its own. An empty table
    gives an empty result. Other columns are not read.
    """
    cut = stage(pieces(docs, id_col, text_col, tokenizer, window, with_ids), "pieces")
    # at most one count for each length up to the window
    counts = dict(cut.groupBy("length").count().collect())
    plan = sorted(plan_windows(counts, window))
    spread = max(1, min(RANKED_AT_ONCE, sum(counts.values()) // (4 * parts(docs)) + 1))
    spans = {k: -(-n // spread) for k, n in counts.items()}

    unit = F.shiftright(F.xxhash64("doc_id", "start", "ids_crc32"), 33) + F.lit(1 << 30)  # 31 bits, in the order of h
    many = F.element_at(F.create_map(*[F.lit(x) for kv in (spans or {0: 1}).items() for x in kv]), F.col("length"))
    keyed = cut.withColumn("unit", unit).withColumn("span", F.shiftright(F.col("unit") * many, 31))
    before = Window.partitionBy("length").orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    # at most as many rows as lengths, and one more for each `spread` pieces
    starts = keyed.groupBy("length", "span").agg(F.count("*").alias("n"))
    starts = starts.select(F.col("length").alias("l"), F.col("span").alias("s"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = F.row_number().over(Window.partitionBy("length", "span").orderBy("unit", "doc_id", "start", "ids_crc32"))
    ranked = keyed.withColumn("n", inside).join(starts, (F.col("length") == F.col("l")) & (F.col("span") == F.col("s")))
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", *["ids"] * with_ids]
    ranked = ranked.select(*names, (F.col("first") + F.col("n") - 1).alias("rank"))

    table = np.array(plan, np.int64).reshape(-1, 6)
    by_rank = table[:, 0] << 48 | table[:, 1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            row = table[np.searchsorted(by_rank, length << 48 | rank, side="right") - 1]
            nth = rank - row[:, 1]
            sequence, offset = row[:, 4] + nth // row[:, 3], row[:, 5] + nth % row[:, 3] * length
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"])

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids binary" * with_ids
    return ranked.mapInArrow(place, f"{schema}, sequence_id long, offset long")


def sequences(packed: DataFrame, window: int = WINDOW, pad_id: int = 0) -> DataFrame:
    """``sequence_id, n_tokens, ids``: the packed ids as little-endian 32-bit integers, padded to the window.

    A sequence whose length is a power of two is not padded. ``packed`` must carry ``ids``.
    """
    rows = packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("p"))
    joined = F.aggregate("p", F.lit(b"").cast("binary"), lambda acc, x: F.concat(acc, x["ids"]))
    pad = F.repeat(F.lit(f"{pad_id:08x}"[6:8] + f"{pad_id:08x}"[4:6] + f"{pad_id:08x}"[2:4] + f"{pad_id:08x}"[:2]), (F.lit(window) - F.col("n_tokens")).cast("int"))
    whole = F.bit_count("n_tokens") == 1
    return rows.select("sequence_id", "n_tokens", F.when(whole, joined).otherwise(F.concat(joined, F.unhex(pad))).alias("ids"))
