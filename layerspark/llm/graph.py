"""Connected components of a distributed list of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from layerspark.session import materialize_observed

MAX_ROUNDS = 100


def _large_star(edges: DataFrame) -> DataFrame:
    """Tie each larger neighbour of a node to the node's smallest neighbour, or itself."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    tied = both.filter("v > u").join(least, "u")
    return tied.select(F.col("m").alias("a"), F.col("v").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Tie each node and its smaller neighbours to the smallest of them; ``a < b`` in ``edges``."""
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    tied = edges.join(least, "b").filter("a > m").select(F.col("m").alias("a"), F.col("a").alias("b"))
    own = least.select(F.col("m").alias("a"), "b")
    return tied.union(own).distinct()


def _written(edges: DataFrame) -> tuple[DataFrame, dict]:
    """The edges, written once, with their count and a checksum."""
    checksum = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    return materialize_observed(edges, "components", rows=F.count(F.lit(1)), checksum=checksum)


def components(links: DataFrame) -> DataFrame:
    """``node, root`` of every node in ``links`` (``a``, ``b``): root is the smallest node reachable.

    Alternates large and small stars until nothing changes: every component has then
    become a star around its smallest node. Hubs meet combining aggregates and joins
    that Spark can split. Each round is written to the shared folder, so a lost
    executor costs at most a round; only a count and a checksum reach the driver.
    """
    edges = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct()
    edges, state = _written(edges)
    for _ in range(MAX_ROUNDS):
        if not state["rows"]:
            break
        before = state
        edges, state = _written(_small_star(_large_star(edges)))
        if before == state:
            break
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    roots = edges.select(F.col("a").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(roots)
