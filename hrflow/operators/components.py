"""Connected components of a graph given as links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hrflow.operators.storage import Rounds


def _smallest(links: DataFrame) -> DataFrame:
    """The smallest node that each node reaches in one step, itself included."""
    return links.groupBy("src").agg(F.min("dst").alias("low")).select("src", F.least("src", "low").alias("low"))


def _onto_smallest(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the node's smallest neighbour instead."""
    both = links.union(links.select("dst", "src"))
    moved = both.join(_smallest(both), "src").where(F.col("dst") > F.col("src"))
    return moved.select(F.col("dst").alias("src"), F.col("low").alias("dst")).distinct()


def _downwards(links: DataFrame) -> DataFrame:
    """The smaller neighbours of a node, and the node, are linked to the smallest of them. ``links`` lead from large to small."""
    low = _smallest(links)
    moved = links.join(low, "src").select(F.col("dst").alias("src"), F.col("low").alias("dst"))
    return moved.union(low.withColumnRenamed("low", "dst")).where("src <> dst").distinct()


def components(links: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(node, component) for every node that is not the smallest of its component; ``component`` is the smallest node.

    ``links`` has two columns of one type; direction and repeats do not matter, nulls and loops are no links. A node in no
    link, and the smallest node of a component, have no row: they name themselves.

    Alternating stars: links are moved onto the smallest neighbour, first from the larger side, then from the smaller one, until
    every component is a star. Rounds grow with the logarithm of the component sizes, links never grow in number beyond nodes plus
    links, and the smallest neighbour is an aggregate with map-side combining, so a node that a third of all rows link
    to costs one row a task. Each round is written to the shared folder, in place of the one before, and survives lost executors.
    """
    src, dst = links.columns
    named = links.where(F.col(src) != F.col(dst))  # neither is null then
    start = named.select(F.greatest(src, dst).alias("src"), F.least(src, dst).alias("dst"))
    rounds = Rounds("links")
    stars, seen = rounds.save(start.distinct()), None
    for _ in range(max_rounds):
        stars = rounds.save(_downwards(_onto_smallest(stars)))
        rows = F.struct("src", "dst")
        state = stars.agg(F.count(rows), F.sum(F.xxhash64(rows).cast("decimal(38,0)"))).first()
        if state == seen:
            return stars.select(F.col("src").alias("node"), F.col("dst").alias("component"))
        seen = state
    raise ValueError(f"components are not settled after {max_rounds} rounds")
