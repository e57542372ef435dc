"""Connected components of a graph that is given by its links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import finished, stored


@finished
def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of `links` (a, b); a component is named by its smallest node.

    Each round every node joins the node that comes first by a hash of the round within two links of it, itself included,
    and the graph shrinks to what is left of it: with a new order each round a constant share of the nodes goes whatever its
    shape, and nodes around one centre go in one round.
    Neighbours are reduced to a minimum before the shuffle, so a node with very many links needs no task of its own.
    Links of a node to itself name it. The empty graph has no nodes.
    """
    names = stored(links.select("a", "b").union(links.select("b", "a")).groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node")))
    member = names.select("node", F.col("node").alias("at"))
    # many small joins one after another: sent to all workers, their tables would pile up on the driver
    shuffled = lambda frame: frame.hint("merge")
    edges = stored(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct())
    turn = 0
    while not edges.isEmpty():
        turn += 1
        first = lambda c: F.struct(F.xxhash64(c, F.lit(turn)).alias("h"), F.col(c).alias("n"))  # noqa: E731, B023
        both = edges.union(edges.select("b", "a")).toDF("a", "b")
        near = stored(both.groupBy("a").agg(F.min(F.least(first("a"), first("b"))).alias("near")))
        # a node is a neighbour of its neighbours, so what is near it counts as well
        to = both.join(shuffled(near.toDF("b", "near")), "b").groupBy("a").agg(F.min("near").getField("n").alias("to"))
        to = stored(to)
        member = member.join(shuffled(to), F.col("at") == F.col("a"), "left").select("node", F.coalesce("to", "at").alias("at"))
        member = stored(member)
        left, right = to.toDF("a", "x"), to.toDF("b", "y")
        edges = stored(
            edges.join(shuffled(left), "a")
            .join(shuffled(right), "b")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
            .filter("a < b")
            .distinct()
        )
    least = member.groupBy("at").agg(F.min("node").alias("component"))
    return member.join(shuffled(least), "at").select("node", "component")
