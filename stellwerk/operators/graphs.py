"""Connected components by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stellwerk.session import written


def components(edges: DataFrame) -> DataFrame:
    """(node, root): one node of each component stands for all that edges (a, b) connect with it.

    Every round a node gives way to the neighbour that comes first in an order by hash, unless it
    comes before them all; edges between those that are left go to the next round.  A round leaves at most
    three quarters of the nodes, half of those of a path, whatever their order, so all rounds
    together cost a few times what the first one does.  Only minima are kept per node; a node
    with very many edges is no large group.
    """
    left = written(edges.select("a", "b").filter("a <> b"))
    steps: list[DataFrame] = []
    while not left.isEmpty():
        place = lambda node: F.xxhash64(F.lit(len(steps)), node)  # noqa: E731, B023
        both = left.unionAll(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = both.groupBy("a").agg(F.min(F.struct(place("b").alias("place"), F.col("b").alias("node"))).alias("near"))
        own = F.struct(place("a").alias("place"), F.col("a").alias("node"))
        steps.append(written(near.select(F.col("a").alias("node"), F.least(own, "near")["node"].alias("root"))))
        to = lambda of, name: steps[-1].select(F.col("node").alias(of), F.col("root").alias(name))
        moved = left.join(to("a", "c"), "a").select("b", "c").join(to("b", "d"), "b").filter("c <> d")
        left = written(moved.select(F.least("c", "d").alias("a"), F.greatest("c", "d").alias("b")).distinct())
    if not steps:
        return left.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = steps.pop()
    while steps:
        end = roots.select(F.col("node").alias("root"), F.col("root").alias("end"))
        roots = steps.pop().join(end, "root", "left").select("node", F.coalesce("end", "root").alias("root"))
    return roots
