"""Repairing the structure of conversations at least cost.

A conversation must be an optional system row and then pairs of user and assistant. Its rows become symbols
(role, fault), equal neighbours collapse to runs, and a run of any length is passed by the binary powers of its
symbol's min-plus transition between four states. That gives the least cost from every run's start; the edits
are then unrolled from the front, a run being cut at powers of two, always taking the least letter among the
cheapest.

Rows travel without their texts: equal rows are counted first, then range-partitioned by conversation and
turn, so a conversation of a third of all rows spreads over tasks, each of which hands on its runs only. The texts
are joined with the edits in one sorted stream per conversation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import parts, stage
from tidemark.llm.line_dedup import boundaries

#: Costs of the edits.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
NEVER = 1 << 60
SPACES = " \t\n\x0b\x0c\r"
#: States: nothing yet, after the system row, after a user row, after an assistant row; the first and last may end.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
TO_END = (0, 2 * INSERT, INSERT, 0)
#: The state that an inserted or rerolled row leads to, and so its role.
PUT = (USER, USER, ASSISTANT, USER)
ROLE_OF = {USER: "user", ASSISTANT: "assistant"}
#: Symbols: 2 * role + truncated, roles s u a and any other; the last must be deleted.
ROLES = "sua"
MUST_DELETE = 8
#: Runs shorter than this are unrolled row by row.
SHORT = 64
#: Runs of fewer bytes are remembered with their repair, as many conversations look alike.
ALIKE_BYTES = 512

Matrix = tuple[tuple[int, ...], ...]


def kept_state(symbol: int, state: int) -> int | None:
    """Where keeping a row leads, if it may be kept."""
    role = symbol >> 1
    if symbol == MUST_DELETE or role == 3:
        return None
    if role == 0:
        return SYSTEM if state == START else None
    return (USER, ASSISTANT)[role - 1] if PUT[state] == (USER, ASSISTANT)[role - 1] else None


def times(a: Matrix, b: Matrix) -> Matrix:
    """The min-plus product: ``a``, then ``b``."""
    return tuple(tuple(min(a[i][k] + b[k][j] for k in STATES) for j in STATES) for i in STATES)


def onward(matrix: Matrix, costs: tuple[int, ...]) -> tuple[int, ...]:
    """The least cost to go from each state, given that after the matrix."""
    return tuple(min(m + c for m, c in zip(row, costs, strict=True)) for row in matrix)


@lru_cache
def power(symbol: int, exponent: int) -> Matrix:
    """The transition of ``2 ** exponent`` rows of a symbol: rows inserted before each, and what is done with it."""
    if exponent:
        half = power(symbol, exponent - 1)
        return times(half, half)
    one = [[NEVER] * 4 for _ in STATES]
    for state in STATES:
        spent, at = 0, state
        for _ in range(3):  # two insertions reach every state that any number reaches
            extra = 0 if symbol == MUST_DELETE else TRUNCATED * (symbol & 1)
            moves = [(DELETE, at)]
            if symbol != MUST_DELETE:
                moves.append((REROLE + extra, PUT[at]))
            if (to := kept_state(symbol, at)) is not None:
                moves.append((extra, to))
            for cost, to in moves:
                one[state][to] = min(one[state][to], spent + cost)
            spent, at = spent + INSERT, PUT[at]
    return tuple(map(tuple, one))


def before_run(symbol: int, length: int, costs: tuple[int, ...]) -> tuple[int, ...]:
    """The least cost to go before a run, given that after it."""
    exponent = 0
    while length:
        if length & 1:
            costs = onward(power(symbol, exponent), costs)
        length >>= 1
        exponent += 1
    return costs


def unroll(symbol: int, length: int, state: int, after: tuple[int, ...], out: list[str]) -> int:
    """Append the edits of a run's rows, and return the state behind it.

    A long run is cut at a power of two, whose cached transition gives the costs at the cut.
    """
    while length > SHORT:
        half = (length - 1).bit_length() - 1
        state = unroll(symbol, length - (1 << half), state, onward(power(symbol, half), after), out)
        length = 1 << half
    to_go = [after]
    for _ in range(length):
        to_go.append(onward(power(symbol, 0), to_go[-1]))
    extra = 0 if symbol == MUST_DELETE else TRUNCATED * (symbol & 1)
    for left in range(length, 0, -1):
        here, then = to_go[left], to_go[left - 1]
        while True:  # letters in their order: D, I, K, R
            if here[state] == DELETE + then[state]:
                out.append("D")
                break
            if here[state] == INSERT + here[PUT[state]]:
                out.append("I")
                state = PUT[state]
                continue
            to = kept_state(symbol, state)
            if to is not None and here[state] == extra + then[to]:
                out.append("K")
            else:
                to = PUT[state]
                out.append("R")
            state = to
            break
    return state


def solve(symbols: np.ndarray, lengths: np.ndarray) -> tuple[int, str]:
    """The least cost of a conversation given as runs, and its edits."""
    runs = list(zip(symbols.tolist(), lengths.tolist(), strict=True))
    to_go = [TO_END]
    for symbol, length in reversed(runs):
        to_go.append(before_run(symbol, length, to_go[-1]))
    cost, state, out = to_go[-1][START], START, []
    for k, (symbol, length) in enumerate(runs):
        state = unroll(symbol, length, state, to_go[len(runs) - 1 - k], out)
    out.extend("I" * (TO_END[state] // INSERT))
    return cost, "".join(out)


@lru_cache(1 << 16)
def solve_alike(runs: bytes) -> tuple[int, str]:
    return solve(*unpack_runs(runs))


def joined_runs(symbols: np.ndarray, lengths: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of one symbol as one integer each, and whose they are; neighbours of one owner and symbol are joined."""
    if not len(symbols):
        return np.zeros(0, "<i8"), owner
    first = np.flatnonzero(np.append(True, (symbols[1:] != symbols[:-1]) | (owner[1:] != owner[:-1])))
    return (np.add.reduceat(lengths, first) * 16 + symbols[first]).astype("<i8"), owner[first]


def unpack_runs(runs: bytes) -> tuple[np.ndarray, np.ndarray]:
    packed = np.frombuffer(runs, "<i8")
    return packed & 15, packed >> 4


def repair_runs(runs: bytes) -> tuple[int, str]:
    return solve_alike(runs) if len(runs) < ALIKE_BYTES else solve(*unpack_runs(runs))


def damaged(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """``conv_id, turn, role, text, copies``: rows damaged as crc32 of ``conv_id:turn`` says.

    A twentieth each: left out (``copies`` 0, role and text empty, no turn), text emptied, full stops removed, repeated
    (``copies`` 2), or given to the user. A null is one space, in that key as in role and text.
    """
    conv, turn, role, text = (F.col(f"`{c}`") for c in (conv_col, turn_col, role_col, text_col))
    key = F.concat(F.coalesce(conv.cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(turn.cast("string"), F.lit(" ")))
    kind = F.crc32(F.encode(key, "UTF-8")) % 20
    role, text = F.coalesce(role, F.lit(" ")), F.coalesce(text, F.lit(" "))
    return rows.select(
        conv.cast("long").alias("conv_id"),
        F.when(kind != 0, turn.cast("long")).alias("turn"),
        F.when(kind == 0, "").when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind.isin(0, 1), "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def row_key(role: Column, text: Column) -> Column:
    """Tells rows of one conversation apart by role and text."""
    return F.unhex(F.md5(F.encode(F.concat(role, F.lit("\0"), text), "UTF-8")))


def with_faults(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, key, symbol, blank, truncated, first, copies`` for each group of equal rows.

    ``first``: no earlier turn of the conversation has the same role and text. Equal rows are counted before they
    are shuffled. The first turns are joined back with the turn in the key, so no text is a hot key.
    """
    last = F.substring(F.btrim("text", F.lit(SPACES)), -1, 1)
    initial = F.when(F.col("role") == "", "?").otherwise(F.substring("role", 1, 1))
    narrow = rows.select(
        "conv_id", "turn", initial.alias("initial"), F.col("role"), row_key(F.col("role"), F.col("text")).alias("key"),
        (last == "").alias("blank"), (~last.isin(".", "!", "?", "")).alias("truncated"), "copies",
    )
    keys = ["conv_id", "turn", "role", "initial", "key", "blank", "truncated"]
    counted = narrow.groupBy(*keys).agg(F.sum("copies").alias("copies"))
    present = narrow.where("copies > 0 AND NOT blank").groupBy("conv_id", "key")
    earliest = present.agg(F.min(F.struct(F.col("turn").isNotNull(), "turn"))["turn"].alias("t")).select(F.col("conv_id").alias("c"), F.col("key").alias("k"), "t", F.lit(True).alias("first"))
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("key") == F.col("k")) & F.col("turn").eqNullSafe(F.col("t"))
    role = F.instr(F.lit(ROLES), F.col("initial"))
    symbol = F.when(role > 0, role - 1).otherwise(3) * 2 + F.col("truncated").cast("int")
    joined = counted.join(earliest.hint("shuffle_hash"), same, "left")
    return joined.select("conv_id", "turn", "role", "key", symbol.alias("symbol"), "blank", "truncated", F.coalesce("first", F.lit(False)).alias("first"), "copies")


FRAGMENT = "conv_id long, part int, turn_from long, turn_to long, turns long, first_role int, last_role int, blank long, duplicate long, truncated long, illegal long, runs binary"
REPAIR = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_LEGAL = np.zeros((4, 4), bool)
_LEGAL[[0, 1, 2], [1, 2, 1]] = True


def fragments_of(rows: pa.Table) -> pa.RecordBatch:
    """One row for each conversation among the rows in order: its counts and runs."""
    part = rows.schema.metadata[b"part"]
    turn = rows.column("turn").combine_chunks()
    new = boundaries(rows, ["conv_id"])
    begins = np.flatnonzero(new)
    there = rows.column("copies").to_numpy() > 0
    symbol, blank, truncated, first, copies = (rows.column(c).to_numpy()[there] for c in ("symbol", "blank", "truncated", "first", "copies"))
    conv, n = (np.cumsum(new) - 1)[there], len(begins)
    role, fresh = symbol >> 1, first & ~blank

    def count(amount: np.ndarray, where: np.ndarray) -> pa.Array:
        return pa.array(np.bincount(where, amount, minlength=n).astype(np.int64))

    def ends(values: np.ndarray, where: np.ndarray, kind: pa.DataType) -> list[pa.Array]:
        """The first and last value of each conversation, null if it has none."""
        last = np.searchsorted(where, np.arange(n), side="right")
        starts, none = np.searchsorted(where, np.arange(n)), ~np.isin(np.arange(n), where)
        padded = np.append(values, 0)
        return [pa.array(padded[np.minimum(at, len(values))], kind, mask=none) for at in (starts, np.maximum(last - 1, 0))]

    known = turn.is_valid().to_numpy(zero_copy_only=False)[there]
    turns, turn_conv = turn.fill_null(0).to_numpy()[there][known], conv[known]
    fresh_turn = np.ones(len(turns), np.int64)
    fresh_turn[1:] = (turns[1:] != turns[:-1]) | (turn_conv[1:] != turn_conv[:-1])

    odd_pair = ~_LEGAL[role[:-1], role[1:]] & (conv[:-1] == conv[1:])
    illegal = copies - 1
    illegal[1:] += odd_pair

    # a fresh row is followed by its copies, which repeat it
    symbols = np.stack([np.where(fresh, symbol, MUST_DELETE), np.full(len(symbol), MUST_DELETE)], axis=1).ravel()
    lengths, owner = np.stack([np.ones(len(symbol), np.int64), copies - 1], axis=1).ravel(), np.repeat(conv, 2)
    packed, owner = joined_runs(symbols[lengths > 0], lengths[lengths > 0], owner[lengths > 0])
    raw, cut = packed.tobytes(), (8 * np.searchsorted(owner, np.arange(n + 1))).tolist()
    columns = [
        rows.column("conv_id").combine_chunks().take(pa.array(begins)), pa.array(np.full(n, int(part)), pa.int32()),
        *ends(turns, turn_conv, pa.int64()), count(fresh_turn, turn_conv), *ends(role, conv, pa.int32()),
        count(copies * blank, conv), count((copies - fresh) * ~blank, conv), count(fresh & truncated, conv), count(illegal, conv),
        pa.array([raw[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, names_of(FRAGMENT))


def names_of(schema: str) -> list[str]:
    return [x.split()[0] for x in schema.split(", ")]


def fragments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``FRAGMENT`` rows, one for each conversation of a task, from its rows in order."""
    from pyspark import TaskContext

    part = {"part": str(TaskContext.get().partitionId())}
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        begins = np.flatnonzero(boundaries(batch, ["conv_id"]))
        if held and len(begins) == 1 and held[-1].column("conv_id")[-1] == batch.column("conv_id")[0]:
            held.append(batch)  # the last conversation goes on
            continue
        yield_to = int(begins[-1])
        whole = pa.Table.from_batches([*held, batch.slice(0, yield_to)])
        if whole.num_rows:
            yield fragments_of(whole.replace_schema_metadata(part))
        held = [batch.slice(yield_to)]
    if held:
        yield fragments_of(pa.Table.from_batches(held).replace_schema_metadata(part))


def joined_fragments(pieces: list[tuple]) -> tuple:
    """One conversation's gaps, counts, cost and audit, from its tasks' fragments in order."""
    low = high = last_role = None
    turns = blank = duplicate = truncated = illegal = 0
    runs = []
    for a, b, n, first, last, *counts, own in pieces:
        if n:
            turns += n - (high == a)
            low, high = a if low is None else low, b
        if first is not None:
            illegal += last_role is not None and not _LEGAL[last_role, first]
            last_role = last
        blank, duplicate, truncated, illegal = (x + y for x, y in zip((blank, duplicate, truncated, illegal), counts, strict=True))
        runs.append(own)
    if len(runs) > 1:
        symbols, lengths = unpack_runs(b"".join(runs))
        runs = [joined_runs(symbols, lengths, np.zeros(len(symbols)))[0].tobytes()]
    gaps = high - low + 1 - turns if turns else 0
    return gaps, blank, duplicate, truncated, int(illegal), *repair_runs(runs[0])


def audits(rows: DataFrame) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit`` of damaged rows, one row per conversation.

    A conversation in one task comes from there as one fragment; only those across a border of tasks have several.
    A group gathers the runs of one conversation, eight bytes each, and returns an audit of a letter for each row.
    """
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("key")]
    narrow = with_faults(rows).repartitionByRange(parts(rows), *order).sortWithinPartitions(*order)
    found = stage(narrow.mapInArrow(fragments, FRAGMENT), "conversation-runs")
    names = names_of(FRAGMENT)[1:]
    kinds = [*[pa.int64()] * 6, pa.string()]
    whole = found.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(*names))).alias("pieces"))

    def repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [joined_fragments([tuple(p.values())[1:] for p in own]) for own in batch.column("pieces").to_pylist()]
            columns = [pa.array([x[k] for x in made], kind) for k, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), *columns], names_of(REPAIR))

    return whole.mapInArrow(repaired, REPAIR)


REPAIRED = "conv_id long, place long, role string, text string"


def apply_audits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From each conversation's audit and then its rows in order: the repaired rows, numbered from 0."""
    conv, audit, at, state, place = None, "", 0, START, 0
    out: list[tuple] = []
    size = 0

    def flush() -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], kind) for k, kind in enumerate(kinds)], names_of(REPAIRED))

    def put(role: str, text: str) -> None:
        nonlocal place, size
        out.append((conv, place, role, text))
        place += 1
        size += len(text) + 64

    def insertions() -> None:
        nonlocal at, state
        while at < len(audit) and audit[at] == "I":
            state, at = PUT[state], at + 1
            put(ROLE_OF[state], "")

    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "audit", "role", "text", "copies")), strict=True):
            if row[1] is not None:
                insertions()
                conv, audit, at, state, place = row[0], row[1], 0, START, 0
                continue
            for _ in range(row[4]):
                insertions()
                edit, at = audit[at], at + 1
                if edit == "K":
                    state = SYSTEM if row[2][0] == "s" else PUT[state]
                    put(row[2], row[3])
                elif edit == "R":
                    state = PUT[state]
                    put(ROLE_OF[state], row[3])
            if size > 4 << 20:
                yield flush()
                out, size = [], 0
    insertions()
    if out:
        yield flush()


def repaired_rows(rows: DataFrame, found: DataFrame) -> DataFrame:
    """``conv_id, place, role, text`` of the repaired conversations, each in order within one partition.

    A conversation's rows stream through one task after its audit; nothing but that audit is held.
    """
    texts = rows.where("copies > 0").select(
        "conv_id", F.lit(1).alias("kind"), "turn", "role", row_key(F.col("role"), F.col("text")).alias("key"), F.lit(None).cast("string").alias("audit"), "text", "copies"
    )
    none = F.lit(None)
    edits = found.where("audit <> ''").select(
        "conv_id", F.lit(0).alias("kind"), none.cast("long").alias("turn"), none.cast("string").alias("role"), none.cast("binary").alias("key"), "audit", none.cast("string").alias("text"), F.lit(0).cast("long").alias("copies")
    )
    order = [F.col("conv_id").asc_nulls_first(), F.col("kind"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("key")]
    together = edits.unionByName(texts).repartition(parts(rows), "conv_id").sortWithinPartitions(*order)
    return together.mapInArrow(apply_audits, REPAIRED)


def row_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``conv_id, repaired_sha256`` from repaired rows in order; a digest grows row by row."""
    conv, digest = None, None
    for batch in batches:
        done: list[tuple] = []
        for c, place, role, text in zip(*(batch.column(x).to_pylist() for x in ("conv_id", "place", "role", "text")), strict=True):
            if place == 0:
                if digest is not None:
                    done.append((conv, digest.hexdigest()))
                conv, digest = c, hashlib.sha256()
            else:
                digest.update(b"\n")
            digest.update(f"{role}:{text}".encode())
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in done], pa.int64()), pa.array([x[1] for x in done], pa.string())], ["d_conv", "digest"])
    if digest is not None:
        yield pa.RecordBatch.from_arrays([pa.array([conv], pa.int64()), pa.array([digest.hexdigest()])], ["d_conv", "digest"])


def repair_report(conversations: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """One row per conversation of the undamaged table, repaired after the damage.

    ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``. Rows are taken by turn (null
    first), rows of one turn by role and md5 of role and text, so equal rows are neighbours. A null
    role or text is one space; a role that begins with none of s, u, a must be changed or deleted. Null conversation ids are one
    conversation. Without rows after the damage all counts are 0 and the audit is empty. An empty table gives
    an empty result; other columns are not read.
    """
    rows = damaged(conversations, conv_col, turn_col, role_col, text_col)
    found = stage(audits(rows), "conversation-audits")
    digests = repaired_rows(rows, found).mapInArrow(row_digests, "d_conv long, digest string")
    joined = found.join(digests, F.col("conv_id").eqNullSafe(F.col("d_conv")), "left")
    empty = hashlib.sha256().hexdigest()
    return joined.select(*found.columns, F.coalesce("digest", F.lit(empty)).alias("repaired_sha256"))
