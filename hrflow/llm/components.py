"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hrflow.llm.common import Scratch


def connected_components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """``node`` and ``root``, the smallest node that is reachable, for every node of ``edges`` (columns a, b, long).

    Each round links every node's larger neighbours to its smallest one, then its smaller neighbours to the
    smallest (alternating stars). Rounds run as joins and aggregates over tables in the shared folder; their
    number grows with the logarithm of the longest path. Nothing is collected but one checksum a round.
    """
    pairs = scratch.save(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct(), "edges-0")
    step, seen = 0, None
    while True:
        both = pairs.union(pairs.select("b", "a"))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        # Joined on a struct, so that adaptive execution may split a node with very many neighbours.
        low = low.select(F.struct("a").alias("k"), "m")
        large = (
            both.filter("b > a").select(F.struct("a").alias("k"), "b").join(low, "k").select(F.col("m").alias("a"), "b").filter("a < b").distinct()
        )
        large = scratch.save(large, f"large-{step}")
        lows = large.groupBy("b").agg(F.min("a").alias("m"))
        near = lows.select(F.struct("b").alias("k"), "m")
        small = (
            large.select(F.struct("b").alias("k"), "a")
            .join(near, "k")
            .select(F.col("m").alias("a"), F.col("a").alias("b"))
            .filter("a < b")
            .union(lows.select(F.col("m").alias("a"), "b"))
            .distinct()
        )
        after = scratch.save(small, f"edges-{step + 1}")
        scratch.drop(pairs, large)
        pairs = after
        mark = pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(mark) == seen:
            break
        seen, step = tuple(mark), step + 1
    roots = pairs.groupBy("b").agg(F.min("a").alias("root")).select(F.col("b").alias("node"), "root")
    return roots.union(pairs.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
