"""Connected components of a table of links, by contraction to the smaller end."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import saved


def components(links: DataFrame) -> DataFrame:
    """``id``, ``root`` for every id in ``links`` (``a``, ``b``, both long): root is the smallest id reachable.

    Each round points every node to its smallest neighbour or itself, contracts the links along these
    pointers, and follows the pointers for the nodes seen so far. Rounds grow with the logarithm of the
    longest path. Every step is an aggregate or an equi-join; nothing but a count reaches the driver.
    """
    edges = saved(links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    both = edges.select(F.col("a").alias("id"), F.col("b").alias("other")).union(edges.select(F.col("b").alias("id"), F.col("a").alias("other")))
    roots = None
    while not edges.isEmpty():
        step = saved(both.groupBy("id").agg(F.least("id", F.min("other")).alias("to")), "steps")
        if roots is None:
            roots = step.select("id", F.col("to").alias("root"))
        else:
            moved = step.select(F.col("id").alias("root"), "to")
            roots = saved(roots.join(moved, "root", "left").select("id", F.coalesce("to", "root").alias("root")), "roots")
        ends = edges.join(step.select(F.col("id").alias("a"), F.col("to").alias("x")), "a").join(step.select(F.col("id").alias("b"), F.col("to").alias("y")), "b")
        edges = saved(ends.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "links")
        both = edges.select(F.col("a").alias("id"), F.col("b").alias("other")).union(edges.select(F.col("b").alias("id"), F.col("a").alias("other")))
    return roots if roots is not None else edges.select(F.col("a").alias("id"), F.col("b").alias("root"))
