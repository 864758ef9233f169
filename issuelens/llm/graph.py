"""Connected components of a link table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from issuelens.llm.common import stored


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("m").alias("a"), F.col("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges (a, b) with a < b: every a and b go to the smallest neighbour of b."""
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    moved = edges.join(least, "b").select("m", "a", "b")
    pairs = moved.select("m", F.explode(F.array("a", "b")).alias("n"))
    return pairs.where("m <> n").select(F.col("m").alias("a"), F.col("n").alias("b")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of `links` (a, b); the component is its smallest node.

    Each round is stored, a few rounds suffice (logarithmic in the size of a component), and only two
    sums per round reach the driver. A hub's rows are spread by the skew-join of the engine, since the
    star of a node is joined and never collected. Null ends and self-links are ignored.
    """
    clean = links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    edges = stored(clean.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    mark = None
    while True:
        edges = stored(_small_star(_large_star(edges)), "edges")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    nodes = edges.select(F.col("b").alias("node"), F.col("a").alias("component"))
    return nodes.unionByName(edges.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct())
