"""Connected components of a table of links."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightlake.session import materialize


# A round is written as one file for so many links: executors may start a process for
# each file (Hadoop's local file system does), which does not pay for a handful of rows.
LINKS_PER_FILE = 100_000


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (u, v); the root is the smallest node.

    Alternates two steps until nothing changes: every node hands its larger
    neighbours, then its smaller ones, to the smallest it knows.  A node's
    neighbours are never gathered: the smallest is an aggregate, and the rest is a
    join that Spark can split.  The number of rounds grows with the logarithm of
    the longest chain.  Each round is written, so lost executors cost no more
    than the round at hand.
    """
    edges = links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    edges = materialize(edges.distinct(), "links")
    state = _state(edges)
    files = max(1, math.ceil(state[0] / LINKS_PER_FILE))  # rounds do not add links
    while state[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        after = small.union(least.select("u", F.col("m").alias("v"))).distinct()
        after = materialize(after.coalesce(files), "links")
        now = _state(after)
        edges = after
        if now == state:
            break
        state = now
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct().coalesce(files))
