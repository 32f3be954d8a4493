"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import stage


def flat(parents: DataFrame) -> DataFrame:
    """Follow ``node, root`` links until every root has no link of its own; roots are smaller than nodes."""
    while True:
        up = parents.select(F.col("node").alias("root"), F.col("root").alias("higher"))
        parents = stage(parents.join(up, "root", "left").select("node", F.coalesce("higher", "root").alias("root"), F.col("higher").isNotNull().alias("moved")), "roots")
        if not parents.where("moved").head(1):
            return parents.select("node", "root")
        parents = parents.select("node", "root")


def connected_components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node with an edge in ``a, b`` that is not the smallest of its component.

    Each round hooks every node to its smallest smaller neighbour, follows the links to their roots and
    keeps the edges between different roots, so the number of nodes at least halves. Grouping combines
    before the shuffle, and all state is tables.
    """
    pair = lambda a, b: (F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
    left = edges.where("a <> b").select(*pair("a", "b")).distinct()
    found = None
    while True:
        hooked = flat(stage(left.groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("root")), "hooks"))
        hi = hooked.select(F.col("node").alias("hi"), F.col("root").alias("hi_root"))
        lo = hooked.select(F.col("node").alias("lo"), F.col("root").alias("lo_root"))
        moved = left.join(hi, "hi").join(lo, "lo", "left").select(F.col("hi_root").alias("a"), F.coalesce("lo_root", "lo").alias("b"))
        left = stage(moved.where("a <> b").select(*pair("a", "b")).distinct(), "edges")
        if found is None:
            found = hooked
        else:
            up = hooked.select(F.col("node").alias("root"), F.col("root").alias("higher"))
            found = stage(found.join(up, "root", "left").select("node", F.coalesce("higher", "root").alias("root")).unionByName(hooked), "roots")
        if not left.head(1):
            return found
