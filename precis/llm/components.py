"""Connected components of a graph of links, by rounds of star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from precis.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    """Ties each node's larger neighbours to the least node among itself and its neighbours."""
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("m").alias("a"), "b")


def _small_star(edges: DataFrame) -> DataFrame:
    """Ties each node and its smaller neighbours to the least of those."""
    down = edges.select(F.col("b").alias("n"), F.col("a").alias("low"))
    least = down.groupBy("n").agg(F.min("low").alias("a"))
    moved = down.join(least, "n").select("a", F.col("low").alias("b"))
    return moved.unionAll(least.select("a", F.col("n").alias("b")))


def _all_stars(edges: DataFrame) -> bool:
    """No node is a centre and a ray, or a ray of two centres."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("centre")).unionAll(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("centre")))
    seen = ends.groupBy("node").agg(F.max("centre").alias("centre"), F.sum(1 - F.col("centre")).alias("rays"))
    return seen.where("rays > 1 or (rays > 0 and centre = 1)").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """node, root for every node of ``links`` (a, b); the root is the least node it is linked with.

    Each round writes the edges to the checkpoint folder; the number of rounds grows
    with the logarithm of the longest chain. Nodes without links are not returned.
    """
    edges = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()
    edges = stored(edges)
    while not _all_stars(edges):
        edges = stored(_small_star(_large_star(edges)).where("a <> b").distinct())
    roots = edges.select("a").distinct().select(F.col("a").alias("node"), F.col("a").alias("root"))
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root")).unionAll(roots)
