"""Orderings and combinations of a key's values, numbered and decoded from their numbers.

A group's values are gathered once in an array, which is never longer than the rows it gives. Its results are
numbered from 0, the numbers are dealt out in ranges, and each is decoded by arithmetic: digits of the factorial number system
for orderings, of a mixed radix for combinations. No join multiplies rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.skew import hot_keys, mark_hot
from tidemark.session import shuffle_partitions

#: Results that one range of numbers gives; a group with more is worked on by several tasks.
RANKS_AT_ONCE = 50_000
BLOCK = "_block"


def product(factors: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a * b, factors, F.lit(1).cast("bigint"))


def rank_ranges(rows: DataFrame, total: Column, first: Column | int = 0) -> DataFrame:
    """A row for each range of the numbers from ``first`` to ``total`` - 1, as ``_from`` and ``_to``."""
    starts = F.sequence((F.lit(first) if isinstance(first, int) else first).cast("bigint"), total - 1, F.lit(RANKS_AT_ONCE).cast("bigint"))
    return rows.withColumn("_last", total - 1).withColumn("_from", F.explode(starts)).withColumn("_to", F.least(F.col("_from") + (RANKS_AT_ONCE - 1), F.col("_last")))


def explode_ranks(ranges: DataFrame) -> DataFrame:
    return ranges.withColumn("_rank", F.explode(F.sequence("_from", "_to"))).drop("_from", "_to", "_last")


def digits(sizes: Sequence[str]) -> list[Column]:
    """The mixed-radix digits of ``_rank``, the last running fastest; sizes are columns of whole numbers from 1."""
    below = [" * ".join(["1L", *sizes[i + 1 :]]) for i in range(len(sizes))]
    return [F.expr(f"CAST((_rank DIV ({b})) % {size} AS INT)") for b, size in zip(below, sizes, strict=True)]


def unranked_orderings(rows: DataFrame, values: str, names: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """The ``_rank``-th ordering of an array's distinct values as columns ``names``, NULL where none is left.

    The rank's factorial digits say which of the values not yet used comes next. From the last level to the first
    each digit is raised past the places before it, which turns it into a place in the array. Places beyond the
    array's end, and those of a NULL rank, are NULL.

    The names are a generator's columns, below which Spark moves no filter on them. Moved down, it would hold a copy of all
    arithmetic for every mention of a name, and as places mention places, twice as much for each level.
    """
    places, sizes = [f"_p{i}" for i in range(len(names))], [f"_s{i}" for i in range(len(names))]
    counted = rows.withColumns({s: F.greatest(F.size(values) - i, F.lit(1)).cast("bigint") for i, s in enumerate(sizes)})
    out = counted.select(*keep, values, *[d.alias(p) for p, d in zip(places, digits(sizes), strict=True)])
    for level in range(len(names) - 2, -1, -1):
        raised = [(F.col(p) + (F.col(p) >= F.col(places[level])).cast("int")).alias(p) for p in places[level + 1 :]]
        out = out.select(*keep, values, *places[: level + 1], *raised)
    ordering = F.struct(*[F.get(values, F.col(p)).alias(n) for p, n in zip(places, names, strict=True)])
    return out.select(*keep, F.inline(F.array(ordering)))


def hierarchy(df: DataFrame, group: str, value: str, depth: int = 7, carry: Sequence[str] = ()) -> DataFrame:
    """Every ordering of a group's distinct values, ``depth`` columns wide.

    Column ``value`` is followed by ``value2``, ``value3`` and so on. A level is NULL
    once the group has no unused value left, and stays NULL from there on. A group
    of k values gives k!/(k-depth)! rows, or k! when k is not above the depth. A NULL value, or one of the NULL group,
    stands alone. ``carry`` names columns to take along from the row of the first value.

    One aggregate gathers the values; ranges of ranks are then dealt out, so a group with many orderings
    is decoded by many tasks.
    """
    names = [value, *[f"{value}{i}" for i in range(2, depth + 1)]]
    parts = shuffle_partitions(df.sparkSession)
    rows = df.select(F.col(group).alias("_group"), F.col(value).alias("_value"), *carry)
    gathered = F.sort_array(F.collect_set("_value")).alias("_values")
    if not carry:
        # without a group every value is a group of its own
        alone = F.when(F.col("_group").isNull(), F.col("_value"))
        pools = rows.groupBy("_group", alone.alias("_alone")).agg(gathered, F.bool_or(F.col("_value").isNull()).alias("_null"))
        left, levels, keep = pools.drop("_alone"), names, ["_group"]
        first = F.when(F.col("_null") & (F.size("_values") > 0), -1).otherwise(0)  # rank -1 is the NULL value's row
    else:
        from tidemark.operators.joins import lookup_join

        starts = rows.distinct()
        pools = rows.where("_group IS NOT NULL").groupBy(F.col("_group").alias("_pool")).agg(gathered)
        rest = F.when(F.col("_value").isNotNull(), F.array_remove("_values", F.col("_value")))
        left = lookup_join(starts, pools, [("_group", "_pool")]).withColumn("_values", F.coalesce(rest, F.array().cast(pools.schema["_values"].dataType)))
        levels, keep, first = names[1:], ["_group", "_value", *carry], 0
    total = product([F.greatest(F.size("_values") - i, F.lit(1)) for i in range(len(levels))])
    ranges = rank_ranges(left, total, first)
    # A fixed partition count keeps AQE from merging partitions whose rows are about to multiply.
    ranked = explode_ranks(ranges.repartition(parts, *keep, "_from")).withColumn("_rank", F.when(F.col("_rank") >= 0, F.col("_rank")))
    out = unranked_orderings(ranked, "_values", levels, keep)
    return out.select(F.col("_group").alias(group), *carry, *([F.col("_value").alias(value)] if carry else []), *levels)


def star_fanout(spine: DataFrame, key: str, children: Mapping[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """All combinations of each spine key's child values.

    ``children`` maps an output column to (child, key column, value column). A spine
    key without rows in a child gets NULL there. Spine keys are unique and not NULL.

    Spine and children meet in one shuffle, where each key gathers its children's values and numbers their
    combinations. A key whose combinations exceed an average partition has its largest child cut into blocks,
    equal rows too, wherever they lie in the input; the other values are repeated for each block.
    """
    names = list(children)
    values = [f"_v{i}" for i in range(len(names))]
    kinds = [child.schema[value].dataType for child, _, value in children.values()]

    def side(df: DataFrame, key: str, number: int, value: str | None) -> DataFrame:
        own = [(F.col(value) if i == number else F.lit(None).cast(kind)).alias(v) for i, (v, kind) in enumerate(zip(values, kinds, strict=True))]
        return df.select(F.col(key).alias("_key"), F.lit(number).alias("_side"), *own).where("_key IS NOT NULL")

    sides = [side(child, child_key, i, value) for i, (child, child_key, value) in enumerate(children.values())]
    counted = reduce(DataFrame.union, [s.select("_key", "_side") for s in sides])
    counted = counted.groupBy("_key").agg(*[F.count_if(F.col("_side") == i).alias(f"_n{i}") for i in range(len(sides))])
    sizes = [F.greatest(F.col(f"_n{i}"), F.lit(1)) for i in range(len(sides))]
    split_at = F.coalesce(*[F.when(F.col(f"_n{i}") == F.greatest(*sizes, F.lit(1)), F.lit(i)) for i in range(len(sides))])
    hot = hot_keys(counted, ["_key"], F.max(split_at).alias("_split"), weight=reduce(lambda a, b: a * b, [s.cast("double") for s in sizes]))

    every = reduce(DataFrame.union, [side(spine, key, -1, None), *sides])
    if hot is None:
        every = every.select("*", F.lit(0).alias(BLOCK), F.lit(1).cast("bigint").alias("_copies"), F.lit(None).cast("int").alias("_split"))
    else:
        every = in_blocks(every, hot, values)
    # A fixed partition count keeps AQE from merging partitions whose rows are about to multiply.
    parts = shuffle_partitions(spine.sparkSession)
    lists = [F.collect_list(F.when(F.col("_side") == i, F.struct(F.col(v).alias("v"), F.col("_copies").cast("int").alias("n")))).alias(v) for i, v in enumerate(values)]
    gathered = every.repartition(parts, "_key", BLOCK).groupBy("_key", BLOCK).agg(F.bool_or(F.col("_side") == -1).alias("_root"), F.max("_split").alias("_split"), *lists)
    copied = gathered.where("_root").select("_key", "_split", *[F.flatten(F.transform(v, lambda x: F.array_repeat(x["v"], x["n"]))).alias(v) for v in values])
    if hot is not None:  # the split child has rows for its keys, so a block without any adds no row
        copied = copied.where(F.col("_split").isNull() | (F.get(F.array(*[F.size(v) for v in values]), F.col("_split")) > 0))
    counts = [f"_c{i}" for i in range(len(names))]
    numbered = copied.select("_key", *values, *[F.greatest(F.size(v), F.lit(1)).cast("bigint").alias(c) for v, c in zip(values, counts, strict=True)])
    ranked = explode_ranks(rank_ranges(numbered, product([F.col(c) for c in counts])))
    return ranked.select(F.col("_key").alias(key), *[F.get(v, d).alias(n) for v, d, n in zip(values, digits(counts), names, strict=True)])


def in_blocks(every: DataFrame, hot: DataFrame, values: Sequence[str]) -> DataFrame:
    """Rows with ``_copies`` and ``_block``: a hot key's largest child in blocks, all else of it in every block.

    Equal rows are counted first; those of the split child are cut into as many pieces as there are blocks, which start at
    a block that the row's content decides. So neither a row's place in the input nor its copies gather in one block.
    """
    counted = every.groupBy("_key", "_side", *values).agg(F.count(F.lit(1)).alias("_n"))
    marked = mark_hot(counted, hot, ["_key"])
    is_split = F.col("_split").isNotNull() & (F.col("_side") == F.col("_split"))
    piece = F.greatest(F.ceil(F.col("_n") / F.col("_salts")), F.lit(1)).cast("bigint")
    starts = F.when(is_split, F.sequence(F.lit(0).cast("bigint"), F.col("_n") - 1, piece)).otherwise(F.array(F.lit(0).cast("bigint")))
    pieces = marked.withColumn("_piece", F.when(is_split, piece).otherwise(F.col("_n"))).withColumn("_at", F.explode(starts))
    own = F.pmod(F.xxhash64(*values) + F.expr("_at DIV _piece"), F.col("_salts").cast("bigint")).cast("int")
    blocks = F.when(is_split, F.array(own)).otherwise(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))
    copies = F.least(F.col("_piece"), F.col("_n") - F.col("_at"))
    return pieces.select("_key", "_side", *values, copies.alias("_copies"), "_split", F.explode(blocks).alias(BLOCK))
