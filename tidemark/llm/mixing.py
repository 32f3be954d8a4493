"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in shuffled order, repeated up to ``MAX_PASSES`` times. A copy's
virtual finish time is its source's cumulative words divided by the source's target. All queues are served
in the order of finish times until the budget is spent, so each source gets words in proportion to its
target up to about one document.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, stage

WEIGHTS, MAX_PASSES = 3, 3
#: Hex digits that cut a source's shuffled order into ranges, parts of virtual time measured at once, and
#: copies that one task may order; results do not depend on them.
SOURCE_SPANS_HEX, TIME_SPANS, CUT_ROWS = 3, 1024, 10_000


def word_count(text_col: str) -> Column:
    return F.regexp_count(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), F.lit(WORD)).cast("long")


def source_targets(sized: DataFrame) -> DataFrame:
    """``source, source_size, target``: weights 1, 2, 3 in the order of sources (null last) share all
    words; no target exceeds ``MAX_PASSES`` times its source, and the excess goes to the others by weight.

    Sorted by limit over weight, the limited sources are a prefix: each is limited if what the ones before
    it leave would give it more than its limit. One row per source goes through the windows.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    rows = totals.withColumn("place", rank).withColumn("weight", ((F.col("place") - 1) % WEIGHTS + 1).cast("long"))
    rows = rows.withColumn("limit", F.col("source_size") * MAX_PASSES)
    by_limit = Window.orderBy(F.col("limit") / F.col("weight"), "place")
    before, whole = by_limit.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    rows = rows.withColumn("words_left", F.sum("source_size").over(whole) - F.coalesce(F.sum("limit").over(before), F.lit(0)))
    rows = rows.withColumn("weight_left", F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    rows = rows.withColumn("limited", F.col("limit") * F.col("weight_left") <= F.col("weight") * F.col("words_left"))
    rest = F.when(~F.col("limited"), F.col("words_left"))
    shares = F.max(rest).over(whole), F.max(F.when(~F.col("limited"), F.col("weight_left"))).over(whole)
    target = F.when(F.col("limited"), F.col("limit").cast("double")).otherwise((F.col("weight") * shares[0]).cast("double") / shares[1])
    return rows.select("source", "source_size", target.alias("target"))


def finish_time(turn: int | Column) -> Column:
    """Virtual finish time of a row's copy in pass ``turn``; null for rows without words."""
    served = (F.lit(turn) - 1 if isinstance(turn, int) else turn - 1) * F.col("source_size") + F.col("upto")
    return F.when(F.col("size") > 0, served.cast("double") / F.col("target"))


def cut_time(rows: DataFrame, budget: int) -> tuple[float, float, int]:
    """``(from, to, served)``: the span of virtual time in which the budget ends, and the words served before.

    The span is narrowed, ``TIME_SPANS`` parts at a time, until few copies finish in it.
    """
    low, high, served = 0.0, float(MAX_PASSES + 1), 0
    for _ in range(5):
        width = (high - low) / TIME_SPANS
        if width <= 0:
            break
        copies = rows.select("size", F.explode(F.array(*[finish_time(p) for p in range(1, MAX_PASSES + 1)])).alias("finish"))
        copies = copies.where((F.col("finish") > low) & (F.col("finish") <= high))
        span = F.least(F.ceil((F.col("finish") - low) / width), F.lit(TIME_SPANS))
        # at most TIME_SPANS rows come to the driver
        spans = copies.groupBy(span.alias("span")).agg(F.sum("size").alias("words"), F.count("*").alias("n"), F.min("finish"), F.max("finish")).collect()
        for k, words, n, first, last in sorted(spans):
            if served + words > budget:
                break
            served += words
        else:
            return high, float("inf"), served
        if n <= CUT_ROWS or first == last:
            return first, last, served
        low, high = max(low, low + (k - 1) * width), min(high, low + k * width)
        low = min(low, math.nextafter(first, 0))
        high = max(high, last)
    return first, last, served


def served_passes(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target, passes``.

    ``passes``, 0 to 3, counts the copies that the mix takes. The shuffle is the md5 of the id, so
    reruns agree; a null id hashes as the empty text, and copies of one id are told apart by size only.
    Null and empty texts have size 0 and are never taken; a null source is a source of its own. With no
    words at all every target is 0. An empty table gives an empty result. Other columns are not read.
    """
    sized = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.col(f"`{source_col}`").cast("string").alias("source"),
        word_count(text_col).alias("size"),
    )
    sized = stage(sized.withColumn("h", F.md5(F.encode(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "UTF-8"))), "mix-sizes")
    targets = source_targets(sized)
    spans = sized.groupBy("source", F.substring("h", 1, SOURCE_SPANS_HEX).alias("span")).agg(F.sum("size").alias("words"))
    start = F.sum("words").over(Window.partitionBy("source").orderBy("span").rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.select(F.col("source").alias("s"), F.col("span").alias("p"), F.coalesce(start, F.lit(0)).alias("start"))
    targets = targets.withColumnRenamed("source", "t")
    order = Window.partitionBy("source", "span").orderBy("h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    rows = sized.withColumn("span", F.substring("h", 1, SOURCE_SPANS_HEX)).withColumn("inside", F.sum("size").over(order))
    rows = rows.join(spans, F.col("source").eqNullSafe(F.col("s")) & (F.col("span") == F.col("p")))
    rows = rows.join(targets, F.col("source").eqNullSafe(F.col("t")))
    rows = rows.select("doc_id", "source", "h", "size", "source_size", "target", (F.col("start") + F.col("inside")).alias("upto"))
    rows = stage(rows, "mix-order")

    budget = sized.agg(F.sum("size")).first()[0] or 0
    first, last, served = cut_time(rows, budget)
    # a row with words is known by its source and its place in it
    at_cut = rows.select("*", F.explode(F.array(*[finish_time(p) for p in range(1, MAX_PASSES + 1)])).alias("finish"))
    at_cut = at_cut.where((F.col("finish") >= first) & (F.col("finish") <= last))
    # few copies finish in the cut span, unless that many finish at one instant
    serve = Window.orderBy("finish", "source", "upto").rowsBetween(Window.unboundedPreceding, 0)
    in_budget = at_cut.withColumn("after", F.sum("size").over(serve) + served).where(F.col("after") <= budget)
    more = in_budget.groupBy(F.col("source").alias("s"), F.col("upto").alias("u")).agg(F.count("*").alias("more"))
    sure = sum((F.when(finish_time(p) < first, 1).otherwise(0) for p in range(1, MAX_PASSES + 1)), F.lit(0))
    rows = rows.join(more, F.col("source").eqNullSafe(F.col("s")) & (F.col("upto") == F.col("u")) & (F.col("size") > 0), "left")
    return rows.select("doc_id", "source", "size", "source_size", "target", (sure + F.coalesce("more", F.lit(0))).cast("int").alias("passes"))


def mix(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """One row per document: ``doc_id, size, source_size, target, taken``, see :func:`served_passes`.

    ``taken``: the words that the mix takes of it, a whole multiple of ``size``.
    """
    rows = served_passes(docs, id_col, text_col, source_col)
    return rows.select("doc_id", "size", "source_size", "target", (F.col("passes") * F.col("size")).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """The documents that the mix takes, each as often as it takes them, all columns as they were.

    Of rows alike in id, source and size the first by text get the copies that do not divide evenly.
    """
    alike = ("i", "s", "n")
    passes = served_passes(docs, id_col, text_col, source_col).groupBy("doc_id", "source", "size")
    passes = passes.agg(F.sum("passes").alias("total"), F.count("*").alias("rows")).hint("shuffle_hash")
    rows = docs.select(
        F.struct("*").alias("row"),
        F.col(f"`{id_col}`").cast("long").alias("i"),
        F.col(f"`{source_col}`").cast("string").alias("s"),
        word_count(text_col).alias("n"),
    )
    same = rows["i"].eqNullSafe(passes["doc_id"]) & rows["s"].eqNullSafe(passes["source"]) & (rows["n"] == passes["size"])
    rows = rows.join(passes, same).where("total > 0")
    one = rows.where("rows = 1").select("row", F.col("total").alias("copies"))
    nth = F.row_number().over(Window.partitionBy(*alike).orderBy(F.col("row").getField(text_col)))
    share = F.floor(F.col("total") / F.col("rows")) + (nth <= F.col("total") % F.col("rows")).cast("int")
    several = rows.where("rows > 1").withColumn("copies", share).where("copies > 0").select("row", F.col("copies").cast("long"))
    both = one.unionByName(several)
    return both.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")
