"""Connected components of a table of links, by large and small stars."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .texts import stored


# Links that one task writes.
TASK_LINKS = 250_000


def _tasks(links: int) -> int:
    return max(1, math.ceil(links / TASK_LINKS))


def _kept(edges: DataFrame, most: int) -> tuple[DataFrame, tuple]:
    """The distinct edges, written, with their number and a checksum seen on the way.

    There are at most ``most``; a few are not spread over as many files as a
    shuffle has partitions.
    """
    seen = Observation()
    code = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    edges = edges.distinct().coalesce(_tasks(most)).observe(seen, F.count("*").alias("n"), code.alias("code"))
    edges = stored(edges, "links")
    return edges, (seen.get["n"], seen.get["code"])


def components(links: DataFrame) -> DataFrame:
    """(node, root) for each node ``a`` or ``b`` of a link; the root is the least node.

    Each round links every node to the least node it sees, first among its larger
    neighbours, then among its smaller ones. The rounds, a few more than the
    logarithm of the longest chain, each store their links; nothing of them goes
    to the driver but a count and a checksum.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges, state = _kept(edges, links.count())
    while state[0]:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        roots = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("root"))
        # Equal rows come from neighbours with one root: no more than there are links.
        large = both.join(roots, "a").where("b > a").select(F.col("b").alias("a"), F.col("root").alias("b"))
        least = large.groupBy("a").agg(F.min("b").alias("root"))
        small = large.join(least, "a").select(
            F.explode(
                F.array(
                    F.struct(F.col("a"), F.col("root").alias("b")),
                    F.struct(F.col("b").alias("a"), F.col("root").alias("b")),
                )
            ).alias("e")
        )
        before = state
        edges, state = _kept(small.select("e.*").where("a <> b"), 2 * state[0])
        if state == before:
            break
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return nodes.unionByName(roots.coalesce(_tasks(state[0])))
