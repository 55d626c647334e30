"""Connected components of a link table by alternating stars, all in joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievetally.session import cut_lineage


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.unionByName(edges.selectExpr("b AS a", "a AS b"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node hangs its larger neighbours on its smallest neighbour. Of each edge, a is the larger node."""
    least = _both_ways(edges).groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("root"))
    return edges.join(least.withColumnRenamed("a", "b"), "b").selectExpr("a", "root AS b")


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node hangs its smaller neighbours and itself on the smallest of them."""
    least = edges.groupBy("a").agg(F.min("b").alias("root"))
    moved = edges.join(least, "a").where("b > root").selectExpr("b AS a", "root AS b")
    return moved.unionByName(least.selectExpr("a", "root AS b"))


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of links (a, b), where component is the smallest node reachable.

    links has non-null longs in any direction; repeated rows and loops change nothing. A node
    without a link to another one has no row. Each round is one large and one small star, written
    to the shared folder; rounds end when the edges no longer change, O(log^2 n) of them at most.
    A hub's rows meet in a join whose large partitions Spark splits, and its minimum is reduced
    before the shuffle.
    """
    edges = links.selectExpr("greatest(a, b) AS a", "least(a, b) AS b").where("a > b").distinct()
    edges, state = cut_lineage(edges, "links"), None
    while True:
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if now == state or now[0] == 0:
            return edges.selectExpr("a AS node", "b AS component").unionByName(edges.selectExpr("b AS node", "b AS component").distinct())
        state = now
        edges = cut_lineage(_small_star(_large_star(edges).distinct()).distinct(), "links")
