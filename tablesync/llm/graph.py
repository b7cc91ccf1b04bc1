"""Connected components of a large graph as joins over its edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.llm.common import stage


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node that an edge (a, b) touches, root the smallest node reachable.

    Alternates two steps until nothing changes: every node's larger neighbours
    are tied to its smallest one, then every node's smaller neighbours are. The
    number of rounds grows with the logarithm of the longest path. Edges with a
    null end and loops are left out; repeated edges count once. No edges give
    no rows.
    """
    high, low = F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low")
    current = stage(
        edges.where("a <> b").select(high, low).distinct(), "edges"
    )
    before = None
    while (now := _mark(current)) != before:
        before = now
        near = (
            current.select(F.col("low").alias("node"), F.col("high").alias("other"))
            .unionByName(current.select(F.col("high").alias("node"), F.col("low").alias("other")))
            .groupBy("node").agg(F.min("other").alias("other"))
            .select(F.col("node").alias("low"), F.least("node", "other").alias("least"))
        )
        # Sums are written before they are joined: both sides are then dealt out for the join,
        # and the edges of a hub can be split over tasks.
        near = stage(near, "near")
        large = stage(
            current.join(near, "low").select("high", F.col("least").alias("low")).distinct(), "large"
        )
        least = stage(large.groupBy("high").agg(F.min("low").alias("least")), "least")
        small = large.join(least, "high")
        tied = small.where("low <> least").select(F.col("low").alias("high"), F.col("least").alias("low"))
        own = least.select("high", F.col("least").alias("low"))
        current = stage(tied.unionByName(own).distinct(), "edges")
    return current.select(F.col("high").alias("node"), F.col("low").alias("root")).unionByName(
        current.select(F.col("low").alias("node"), F.col("low").alias("root")).distinct()
    )


def _mark(edges: DataFrame):
    """Tells two sets of edges apart."""
    seen = F.xxhash64("high", "low")
    return tuple(edges.agg(
        F.count(F.lit(1)), F.bit_xor(seen), F.sum(F.shiftright(seen, 20))
    ).first())
