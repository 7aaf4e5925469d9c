"""Connected components of an undirected graph, as repeated Spark joins.

Alternating large-star and small-star steps (Kiveris et al., 2014): every
step replaces edges by edges to a smaller node until each node points at the
smallest node of its component.  The edge list never grows, a step is one
aggregate (pre-aggregated in each task) and one join, and every round is
written to the shared folder, so nothing is gathered in one place.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbanlens.llm.common import cut, join_unique


def _large_star(edges: DataFrame, n: int) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"), F.count(F.lit(1)).alias("w"))
    return (join_unique(both.where(F.col("b") > F.col("a")), least, "a", "w", 2 * n)
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .where(F.col("a") != F.col("b")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    # After the large star a node has few smaller neighbours: no hot keys here.
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    kept = least.select("a", F.col("m").alias("b"))
    return moved.unionByName(kept).where(F.col("a") != F.col("b")).distinct()


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) for every node of ``links`` that is linked with another.

    ``component`` is the smallest id reachable.  Links with a null end and
    links of a node with itself are left out; repeated links count once.  An
    empty input gives an empty table.
    """
    edges = cut(links.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b"))
                .where(F.col("a") != F.col("b"))
                .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "cc-edges")

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    seen = mark(edges)
    while seen[0]:
        edges = cut(_small_star(cut(_large_star(edges, seen[0]), "cc-large")), "cc-small")
        now = mark(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())
