"""Connected components of an undirected graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, keep, looked_up

MOST_ROUNDS = 60


def components(links: DataFrame) -> DataFrame:
    """(node, root): for each node of a link (a, b) the smallest node that it can reach.

    Every round each node takes the least node among its own neighbours, and all of its neighbours are
    linked to that one; stars and chains both shrink fast this way. Each round ends in a table in the
    shared folder, so that a lost executor costs a part of one round. No node's neighbours are gathered:
    the least one is joined back to them, by a broadcast where a node has very many.
    """
    print_of = lambda t: t.agg(F.count("*"), F.bit_xor(F.xxhash64("hi", "lo"))).first()
    edges = keep(links.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")).where("hi != lo").distinct(), "links")
    seen = print_of(edges)
    for _ in range(MOST_ROUNDS):
        # Large star: every larger neighbour of u is linked to the least of u and its neighbours.
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(edges.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("_m")).select("u", F.least("u", "m").alias("m"), "_m")
        large = looked_up(both.where("v > u"), least, "u", 2 * seen[0]).select(F.col("v").alias("hi"), F.col("m").alias("lo"))
        large = keep(large.where("hi != lo").distinct(), "large")
        # Small star: u and its smaller neighbours are linked to the least of them.
        down = large.groupBy("hi").agg(F.min("lo").alias("m"), F.count("*").alias("_m"))
        small = looked_up(large, down, "hi", seen[0])
        new = small.select(F.col("lo").alias("hi"), F.col("m").alias("lo")).union(down.select("hi", F.col("m").alias("lo"))).where("hi != lo").distinct()
        new = keep(new, "links")
        forget(edges, large)
        edges, before = new, seen
        seen = print_of(edges)
        if seen == before:
            break
    else:
        raise RuntimeError(f"components haven't settled in {MOST_ROUNDS} rounds")
    stars = edges.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
    out = stars.union(edges.select(F.col("lo").alias("node"), F.col("lo").alias("root")).distinct())
    out._tallyline_path = edges._tallyline_path
    return out
